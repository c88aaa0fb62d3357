"""Training-data operators: near-duplicates, sharding, scans, mixing, language ID.

Nothing else in the library imports this subpackage. Every operator is a
``DataFrame -> DataFrame`` function; the registered queries are in
``queries.py``.
"""
