"""Sources: raw files to DataFrames. Parsers with a Python body run per file in Arrow batches on the executors."""
