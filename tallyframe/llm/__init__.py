"""Training-data operators: sharding, search, dedup, filters, models, packing, PII.

Optional subpackage: nothing else in the library imports it.
"""
