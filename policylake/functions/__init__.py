"""Column-to-column functions. Nothing here starts a job."""
