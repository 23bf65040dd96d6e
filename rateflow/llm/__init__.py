"""Operators for large training-data corpora: scans, de-duplication, scoring, encoding.

Each module ``opN_*`` holds one operator with a general interface and the thin
query that derives the digest columns from it; ``queries.py`` lists the
queries. Nothing outside this package imports it.
"""
