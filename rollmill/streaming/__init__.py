"""The real-time job on Structured Streaming."""
