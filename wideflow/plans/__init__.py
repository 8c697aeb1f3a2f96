"""wideflow.plans."""
