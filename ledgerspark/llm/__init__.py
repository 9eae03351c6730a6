"""Operators for large training corpora: dedup, filtering, mixing, sharding, archives.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
