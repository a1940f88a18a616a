"""The registered queries: the jobs of the library on the driver tables, and their oracle SQL."""
