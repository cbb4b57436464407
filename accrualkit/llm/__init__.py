"""Training-data operators: mixing, quality, chat formatting, language id,
decontamination, near and exact deduplication, toxicity, sharding, vector search.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own general interface; ``queries.py`` derives the registered queries.
"""
