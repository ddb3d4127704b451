"""Training-data operators: extraction, scans, search, rules, dedup, packing, mixing.

One module per operator; each has a general interface on DataFrames and states
its defined results for nulls, empty tables and ties.  ``queries`` holds the
thin registered queries.  Nothing else in the library imports this package.
"""
