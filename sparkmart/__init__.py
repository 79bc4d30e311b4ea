"""sparkmart: retail transaction analytics expressed as Spark DataFrame / SQL / ML plans.

Sub-packages
------------
sources    readers, writers, model store, the generated-table fact mapping
functions  reusable Column-expression builders (rounding, casts, rules)
operators  the analytics operators (ingestion, cleaning, RFM, segmentation, ...)
plans      the query registry used by ``__spark_entry__.py`` and ``bench.py``
streaming  the Structured Streaming variant of config-driven ingestion
"""

__version__ = "0.1.0"
