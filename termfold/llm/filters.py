"""Bounded prefilters for joins on large rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most rows that a prefilter broadcasts.
BUCKETS = 1 << 20


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def split_by(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have a partner in ``wanted`` and rows that have none.

    Compares hash buckets of the keys, of which there are at most :data:`BUCKETS`, so the broadcast is bounded. It only
    spares rows a shuffle: a join by the keys has to follow for the first part.
    """
    buckets = F.broadcast(wanted.select(bucket(F.col(wanted_key)).alias("_bucket")).distinct())
    dealt = df.withColumn("_bucket", F.coalesce(bucket(key), F.lit(-1)))
    maybe = dealt.join(buckets, "_bucket", "left_semi").drop("_bucket")
    without = dealt.join(buckets, "_bucket", "left_anti").drop("_bucket")
    return maybe, without
