"""Sources, target catalogue, stores and sinks."""
