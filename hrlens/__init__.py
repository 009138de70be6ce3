"""hrlens — people-analytics jobs on Apache Spark.

Sub-packages
------------
sources     table scans, stand-in views, payload parsing, sinks
functions   column expressions (cleaning, pay estimate, vectors)
operators   reusable DataFrame operators (top-k, turnover, statistics, ML)
plans       the analyses as query plans, one function per query key
streaming   incremental ingestion of payload files with Structured Streaming
"""

__version__ = "0.1.0"
