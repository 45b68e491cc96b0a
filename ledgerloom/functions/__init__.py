"""Column in, Column out. Nothing here starts a job."""
