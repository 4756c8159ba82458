"""Training-data operators: dedup, fingerprints, quality, packing, licences,
similarity join, token shards, chat formatting, top-k search and mixing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when it is present.
"""
