"""Pure ``Column`` functions."""
