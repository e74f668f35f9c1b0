"""gleanspark: captured web data -> clean, deduplicated, scored tables on Spark.

Everything is expressed as DataFrame / Column transformations so Catalyst sees the
whole plan: extraction from captured HTML, cleaning functions, keep-first dedup,
listing x detail enrichment, scores, view suites and incremental loads.
"""

from gleanspark.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
