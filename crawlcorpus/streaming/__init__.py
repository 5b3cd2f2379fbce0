"""Incremental forms: state and progress that outlive a run."""
