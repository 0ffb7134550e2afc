"""Table-to-table operators. Every function takes and returns DataFrames and runs no action."""
