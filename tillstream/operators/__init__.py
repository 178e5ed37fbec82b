"""Dataset operators built from joins, grouping and windows."""
