"""Training-data operators: extraction, filtering, deduplication, tokens, packing, archives.

Nothing else in the library imports this subpackage. Every operator takes a
DataFrame and column names and returns a DataFrame; ``queries.py`` holds the thin
registered queries over the shared tables.
"""
