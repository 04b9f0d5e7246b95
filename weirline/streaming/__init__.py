"""Log streams with Structured Streaming."""
