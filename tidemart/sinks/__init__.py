"""Writers: partition overwrite, replace by key, CSV and JSON exports, relational append."""
