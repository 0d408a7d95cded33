"""Training-data operators: each module holds one operator, ``queries`` registers their queries."""
