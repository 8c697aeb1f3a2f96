"""wideflow.streaming."""
