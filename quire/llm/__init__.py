"""Training-data operators: deduplication, filtering, extraction, search, encoding.

Nothing else in the library imports this subpackage.  Every operator is a
function ``DataFrame -> DataFrame``; ``queries.py`` holds the thin registered
queries and ``oracles.py`` their SQL.
"""
