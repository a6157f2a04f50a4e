"""End-to-end jobs: DataFrames in, a dict of route -> DataFrame out."""
