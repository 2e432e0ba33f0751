"""Live monitoring of a run with Structured Streaming."""
