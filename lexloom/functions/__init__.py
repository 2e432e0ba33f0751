"""Column builders for URLs and texts."""
