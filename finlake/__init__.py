"""finlake: a Spark-native personal-finance lakehouse.

Layers (each one a set of DataFrame -> DataFrame operators):

* ``sources``   – file ingest (batch + stream), audit columns, payload flattening,
                  the finance views over the driver's test tables.
* ``functions`` – column expressions (month keys, money, instalments, ratios).
* ``operators`` – change data (SCD-1, snapshots), spines, windows, conditional sums.
* ``plans``     – the gold dimensions/facts and the analytics marts.
* ``streaming`` – Structured Streaming bronze ingest and the SCD-1 stream.
"""

__version__ = "0.1.0"
