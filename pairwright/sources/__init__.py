"""Reading and writing tables of the jobs."""
