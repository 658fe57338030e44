"""Training-data pipeline operators (language id, dedup, mixing, tokenising, archives, search, scans).

Nothing else in the library imports this subpackage.
"""
