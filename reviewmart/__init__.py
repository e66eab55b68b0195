"""reviewmart: a review-and-purchase analytics mart built from Spark DataFrames.

Three raw inputs (purchases, reviews, review logs) become staged tables, five
dimension tables and two fact tables.  Plan functions take and return
DataFrames; only ``sources``, ``sinks`` and ``jobs`` know about paths.
"""
