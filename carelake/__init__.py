"""carelake: change events to query-ready analytics tables, on Spark.

Layers (each a plain DataFrame function, so batch and streaming share them):

* ``sources``   - change envelopes, lake files, raw variant tables, fixtures
* ``functions`` - column-level helpers (typing, classes, labels)
* ``operators`` - CDC classification, latest-per-key, staging, SCD2, marts,
                  keyed batch writes, aggregates and top-k
* ``sinks``     - partitioned lake writes, versioned tables, fact appends
* ``streaming`` - Structured Streaming jobs built from the same operators
* ``plans``     - composed jobs: snapshot runs, the dashboard, the pipeline
"""

__version__ = "0.1.0"
