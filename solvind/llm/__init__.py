"""Training-data operators on Spark: sharding, filtering, extraction, dedup, packing, scoring, mixing.

Nothing outside this subpackage imports it. Queries are registered in `queries`.
"""
