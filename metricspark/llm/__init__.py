"""Training-data operators for large text corpora.

Nothing outside this subpackage imports it; the entry module registers its
queries only when the import succeeds.
"""
