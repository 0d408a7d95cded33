"""Text-corpus preparation, retrieval and evaluation as Spark DataFrame functions."""
