"""towerlens: mobile-network telemetry analytics on Spark.

Measurement records are parsed, cleaned and typed with DataFrame operators,
turned into per-batch KPIs (mean signal and GPS precision per operator, status
counts per postal code), written as hour-partitioned Parquet, and rolled up by
serving queries. Everything is built from DataFrame / SQL / Structured
Streaming primitives; there are no Python UDFs on the data path.
"""

__version__ = "0.1.0"
