"""Training-data pipeline operators: deduplication, scans, language, mixing, tokens, archives.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries and their DuckDB SQL; each other module is one operator or a
helper shared by several.
"""
