"""The mart's tables as plans: DataFrames in, DataFrames out."""
