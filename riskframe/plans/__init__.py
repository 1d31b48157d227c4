"""Jobs that compose several operators."""
