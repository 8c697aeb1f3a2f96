"""wideflow.sinks."""
