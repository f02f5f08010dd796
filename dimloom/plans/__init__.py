"""Table definitions, the model build, reporting queries and whole runs."""
