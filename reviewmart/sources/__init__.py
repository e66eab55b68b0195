"""Readers: a path or a table name in, a DataFrame with a declared schema out."""
