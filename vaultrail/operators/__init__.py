"""Table-level jobs: each takes DataFrames and returns DataFrames."""
