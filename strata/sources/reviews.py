"""Review records feed -> dated landing Parquet snapshot (A7 + B2).

The feed's records are read from storage (the HTTP fetch itself is outside
Spark's remit). Every field is read as text first, so numbers arrive the
same whether the feed quotes them or not, then cast to the bronze types;
a bad number fails the cast, as the typed external table would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import BRONZE
from strata.sinks.landing import land_reviews

RAW_REVIEW = StructType([StructField(f.name, StringType()) for f in BRONZE["customer_reviews"]])


def ingest_reviews(spark: SparkSession, records_path: str, landing_root: str,
                   day: dt.date, multi_line: bool = False) -> int:
    """Land one day's review records; returns the number of rows landed.

    ``multi_line=True`` reads files holding one JSON array of records (the
    feed's response body); otherwise one record per line.
    """
    raw = spark.read.schema(RAW_REVIEW).option("multiLine", multi_line).json(records_path)
    typed = raw.select([F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in BRONZE["customer_reviews"].fields])
    return land_reviews(typed, landing_root, day)
