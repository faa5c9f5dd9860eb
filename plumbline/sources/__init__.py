"""Sources, batch state and sinks."""
