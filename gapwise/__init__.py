"""gapwise: care-gap quality measures as Spark DataFrame / SQL / Structured Streaming jobs.

Layout
------
``session``      SparkSession builder and checkpoint-root lookup.
``functions``    column expressions (safe casts, look-back windows, code tests, ids).
``operators``    DataFrame operators: latest version, gap upsert, serving reads,
                 ingest transforms, issue documents, constraint checks.
``sources``      readers / writers: bundle files, object events, resource tables,
                 fixture tables derived from the star schema, sinks.
``plans``        measure specs, the DataFrame measure builder and the SQL-file path.
``streaming``    file-stream ingest and run-request streams (``foreachBatch``).
"""

__version__ = "0.1.0"
