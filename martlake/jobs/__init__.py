"""jobs."""
