"""Column functions. None of them starts a job."""
