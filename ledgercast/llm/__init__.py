"""Operators for preparing training data: filters, duplicates, mixing, sharding, scoring, token files.

Every operator takes any DataFrame with the columns it names and ignores the rest. Rows are never
identified by their id alone: ids may be null or repeated.
"""
