"""One registered query for each operator, with its SQL."""
