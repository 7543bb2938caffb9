"""Jobs that keep long-running tables in shape."""
