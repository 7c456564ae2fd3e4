"""Bounded samples that are the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def smallest_hashes(rows: DataFrame, most: int, labels: int = 2000) -> DataFrame:
    """Of each label (__y) the ``most`` rows of the smallest hashes of __id, as __id, __y, __h and __n (rank).

    Labels are counted first, and only hashes small enough to give about four times ``most``
    rows of a label are ranked, so what meets in one task does not grow with the table.  Only the
    ``labels`` most frequent labels are sampled, which bounds what is broadcast."""
    counts = rows.groupBy("__y").agg(F.count("*").alias("__all")).orderBy(F.desc("__all"), "__y").limit(labels)
    hashed = rows.withColumn("__h", F.xxhash64("__id", F.lit(2))).join(F.broadcast(counts), "__y")
    share = F.pmod("__h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    small = hashed.filter(share * F.col("__all") < 4.0 * most + 64)
    rank = F.row_number().over(Window.partitionBy("__y").orderBy(F.pmod("__h", F.lit(1 << 40)), "__id"))
    return small.withColumn("__n", rank).filter(F.col("__n") <= most).select("__id", "__y", "__h", "__n")


def one_text_each(rows: DataFrame, *by: str) -> DataFrame:
    """Of the rows that share ``by`` the one with the smallest hash of __t (then the smallest __t)."""
    others = [c for c in rows.columns if c not in by and c != "__t"]
    least = F.min(F.struct(F.xxhash64("__t").alias("__first"), "__t", *others)).alias("__least")
    return rows.groupBy(*by).agg(least).select(*by, "__least.__t", *(f"__least.{c}" for c in others))
