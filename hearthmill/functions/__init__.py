"""Pure column expressions: no job, no Python worker."""
