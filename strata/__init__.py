"""strata: a Spark-native medallion lakehouse for retail analytics.

Layers: ``sources`` (JDBC / frame extracts, control table, watermarks,
bronze scans, review feed), ``sinks`` (landing, archive, audit, logs,
batch-versioned tables), ``operators`` (quarantine, SCD2 merge, skew-safe
joins), ``plans`` (silver, gold marts, the daily pipeline), ``functions``
(column expressions), ``fixtures`` (star schema -> retail rows for tests),
``oracle`` (DuckDB twins of every registered query).
"""
