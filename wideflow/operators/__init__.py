"""wideflow.operators."""
