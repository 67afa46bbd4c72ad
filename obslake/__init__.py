"""obslake: hourly observation feeds as plain Spark DataFrame operators.

Raw API responses land as partitioned JSON envelopes; the silver side parses
them against explicit schemas, keeps a place dimension, builds deduplicated
current and forecast fact tables and loads them incrementally by anti-joining
on business keys.  Every operator is a ``DataFrame -> DataFrame`` function
driven by a declarative spec (see :mod:`obslake.specs`).
"""

__version__ = "0.1.0"
