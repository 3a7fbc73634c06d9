"""Table sinks."""
