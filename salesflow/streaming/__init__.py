"""The same rules on Structured Streaming, and incremental refresh of the curated zone."""
