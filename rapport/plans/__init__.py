"""The composed reports: DataFrames in, DataFrame out, nothing is executed here."""
