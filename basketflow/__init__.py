"""basketflow: purchase, rating, text and event-stream analytics on Spark.

Subpackages
    sources     driver tables and the logical views (ratings, orders, order
                lines, sentences, messages)
    operators   collaborative filtering, features, labels, model, text,
                running totals, range join, hot-key salting
    functions   column functions (tokens, segments, LCS, casts)
    streaming   stream sources, windows, keyed state, sinks, offsets
    sinks       batch sinks (text pairs, tables, compaction, keyed upsert)
    plans       the registry of named queries and their SQL oracle
"""

__version__ = "0.1.0"
