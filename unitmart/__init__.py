"""unitmart: multi-tenant lakehouse analytics on Spark DataFrames.

Layers: ``sources`` (scans, binding, landing, extraction), ``functions``
(column expressions), ``operators`` (CDC, quality, scope, marts, enterprise,
governance), ``streaming`` (bronze/staging/silver streams) and ``plans``
(composed queries and their SQL oracles).
"""

__version__ = "0.1.0"
