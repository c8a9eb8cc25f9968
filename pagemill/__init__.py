"""Document-understanding analytics as DataFrame, SQL and Structured Streaming plans."""
