"""plotwise: location-aware property valuation operators on Spark DataFrames.

Every public operator takes and returns DataFrames, so stages compose with
``df.transform``. Sub-packages:

* ``sources``   – table scans, proxy views over the driver tables, file sinks
* ``functions`` – column expressions (geodesy, rounding, text)
* ``operators`` – cleaning, validation, spatial joins, graph, clustering, ML
* ``plans``     – the registered queries and their SQL oracles
* ``streaming`` – Structured Streaming variants
"""

from plotwise.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
