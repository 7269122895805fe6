"""Column helpers and worker set-up."""
