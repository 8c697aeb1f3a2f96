"""wideflow.sources."""
