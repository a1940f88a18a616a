"""The warehouse jobs: each is a function from input tables and run parameters to a result."""
