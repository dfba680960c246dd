"""starloom: a Spark-native retail warehouse engine.

Every operator takes and returns DataFrames; nothing is collected to the
driver except bounded metadata (one-row aggregates, per-partition counts).
Package layout:

* ``sources``   - typed readers, driver-table adapters, incremental filters
* ``functions`` - Column-level helpers (cleaning, money, calendar, null-safe)
* ``operators`` - staging, surrogate keys, dimensions, SCD1/SCD2, point-in-time
                  join, fact, marts, data-quality and reconciliation checks
* ``sinks``     - staged publish with backup/rollback, watermark state table
* ``plans``     - end-to-end compositions (full refresh, incremental run) and
                  the named query registry used by ``__spark_entry__``
* ``streaming`` - Structured Streaming change-feed variant (availableNow)
"""

from starloom.session import get_session  # noqa: F401

__version__ = "0.1.0"
