"""Structured Streaming: sources, sinks, the job runner and stateful
operators.  Every transformation is the batch operator itself; only the
edges (read, write, keyed state) are stream specific."""
