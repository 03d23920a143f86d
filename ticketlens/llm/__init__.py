"""Training-data operators (near-duplicates, tokens, language, mixing, ...).

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries and ``oracle`` their DuckDB SQL where SQL can express them.
"""
