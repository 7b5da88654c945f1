"""gigframe: concert and album analytics as Spark DataFrame plans.

Layers, bottom to top:

* ``gigframe.functions``  Column -> Column helpers (parsing, buckets, keys).
* ``gigframe.sources``    raw table schemas, CSV / JSON readers, sinks and
                          the adapters that shape the driver's test tables.
* ``gigframe.operators``  reusable relational building blocks (keep-first
                          dedup, shares of a parent total, bounded broadcast,
                          per-group statistics, key checks).
* ``gigframe.plans``      staging models, marts, dashboard tiles, ingest
                          selection, data quality and the full build run.
* ``gigframe.streaming``  resumable file ingest with Structured Streaming.

Every function returns a lazy DataFrame; nothing is collected to the driver.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
