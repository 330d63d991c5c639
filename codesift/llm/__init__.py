"""Training-data operators: formatting, filtering, deduplication, packing and sharding of text corpora.

Nothing else in the library imports this subpackage.  Each module is one operator with its own
general interface; ``queries`` applies them to the test tables.
"""
