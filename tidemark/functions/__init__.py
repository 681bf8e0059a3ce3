"""Column helpers: they build expressions and never start a job."""
