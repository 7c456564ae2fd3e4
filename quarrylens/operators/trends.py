"""Gaps, percentiles, coverage, samples and alerts over groups and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_gap(df: DataFrame, key: str, position: Column) -> DataFrame:
    """The most positions (months, days) in a row without a row, by key."""
    seen = df.select(key, position.alias("p")).filter("p is not null").distinct()
    gap = F.col("p") - F.lag("p").over(Window.partitionBy(key).orderBy("p")) - 1
    return seen.withColumn("gap", gap).groupBy(key).agg(F.coalesce(F.max("gap"), F.lit(0)).cast("long").alias("longest_gap"), F.count("*").alias("active"))


def exact_percentiles(df: DataFrame, keys: list[str], column: str, shares: list[float], floor: bool = False) -> DataFrame:
    """Percentiles of each group by rank: the nearest rank, or with ``floor`` the value at index
    floor((n - 1) * share).  Nulls don't count.

    Equal values are counted before they are shuffled and ranks are running sums over sorted
    counts, which spill: no task holds a group's values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("__n"))
    whole = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    upto = F.sum("__n").over(Window.partitionBy(*keys).orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("__upto", upto).join(whole, keys)
    rank = (lambda p: F.floor((F.col("__all") - 1) * F.lit(p)) + 1) if floor else (lambda p: F.greatest(F.ceil(F.col("__all") * F.lit(p)), F.lit(1)))
    return ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("__upto") >= rank(p), F.col(column))).alias(f"p{round(p * 100)}") for p in shares])


def nearest_rank(column: str, *shares: float) -> list[Column]:
    """Exact nearest-rank percentiles: the smallest value with at least that share at or below.

    As an aggregate it holds a group's distinct values; exact_percentiles() does not."""
    return [F.expr(f"percentile_disc({p}) within group (order by {column})").alias(f"p{round(p * 100)}") for p in shares]


def approximate_percentiles(column: str, *shares: float, accuracy: int = 1000) -> list[Column]:
    """Percentiles within a relative error of 1 / accuracy, by a sketch that merges across tasks."""
    return [F.percentile_approx(column, p, accuracy).alias(f"p{round(p * 100)}") for p in shares]


def floor_percentile(column: str, share: float) -> Column:
    """The value at index floor((n - 1) * share): not the nearest rank.

    Collects a group's values; for groups of bounded size.  For others see exact_percentiles()."""
    values = F.sort_array(F.collect_list(column))
    return F.element_at(values, (F.floor((F.size(values) - 1) * F.lit(share)) + 1).cast("int"))


def threshold_coverage(df: DataFrame, column: str, thresholds: list[float], strict: bool = False) -> DataFrame:
    """(threshold, rows, above, share): rows at or above (strict: above) each threshold, in one pass."""
    test = (lambda t: F.col(column) > t) if strict else (lambda t: F.col(column) >= t)
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(test(t)).alias(f"__{i}") for i, t in enumerate(thresholds)])
    each = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"__{i}").alias("above")) for i, t in enumerate(thresholds)]))
    return counts.select("rows", each.alias("c")).select("c.threshold", "rows", "c.above", (F.col("c.above") / F.nullif("rows", F.lit(0))).alias("share"))


def count_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(key).agg(F.count("*").alias("group_size")).groupBy("group_size").agg(F.count("*").alias("groups"))


def top_values(df: DataFrame, keys: list[str], value: str, most: int) -> DataFrame:
    """The most frequent values of each key, ties to the smaller value."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= most)


def hash_sample(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """The rows of the smallest id hashes: a sample that stays the same."""
    return df.orderBy(F.xxhash64(id_col), id_col).limit(size)


def audit_strata(clusters: DataFrame, category_col: str, id_col: str, size_col: str, most: int, seed: int) -> DataFrame:
    """For people to check: the largest merged clusters, the largest singletons by id and singletons in a seeded order."""
    merged = F.col(size_col) > 1
    def pick(name: str, rows: DataFrame, *order) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(category_col).orderBy(*order))
        return rows.withColumn("stratum", F.lit(name)).withColumn("rank", rank).filter(F.col("rank") <= most)

    singles = clusters.filter(~merged)
    return (
        pick("merged", clusters.filter(merged), F.desc(size_col), id_col)
        .unionByName(pick("singleton_first", singles, id_col))
        .unionByName(pick("singleton_random", singles, F.sha2(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")), 256)))
    )


def month_grid(series: DataFrame, keys: list[str], month_col: str, value_col: str) -> DataFrame:
    """Every key with every month that occurs anywhere; months without a value are null."""
    months = series.select(month_col).distinct()
    grid = series.select(*keys).distinct().crossJoin(F.broadcast(months))
    return grid.join(series.select(*keys, month_col, value_col), [*keys, month_col], "left")


def word_sizes(themes: DataFrame, key: str, name_col: str, count_col: str, most: int = 12) -> DataFrame:
    """The largest themes of a key with display sizes 18 to 42."""
    order = Window.partitionBy(key).orderBy(F.desc(count_col), name_col)
    top = themes.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    high = F.max(count_col).over(Window.partitionBy(key))
    return top.withColumn("size", (F.lit(18) + F.floor(F.lit(24) * F.col(count_col) / F.nullif(high, F.lit(0)) + 0.5)).cast("int"))


def rate_alerts(series: DataFrame, keys: list[str], position: str, count_col: str, total_col: str, recent: int = 3, baseline: int = 12, rise: float = 0.10, least: int = 30) -> DataFrame:
    """An extension: keys whose rate over the last positions exceeds that of the positions before by ``rise``.

    A missing position is not a zero: rates are sums over the rows that are there."""
    last = series.agg(F.max(position).alias("__last"))
    joined = series.crossJoin(F.broadcast(last))
    age = F.col("__last") - F.col(position)
    part = lambda c, low, high: F.coalesce(F.sum(F.when((age >= low) & (age < high), F.col(c))), F.lit(0))
    sums = joined.groupBy(*keys).agg(
        part(count_col, 0, recent).alias("recent_count"), part(total_col, 0, recent).alias("recent_total"),
        part(count_col, recent, recent + baseline).alias("baseline_count"), part(total_col, recent, recent + baseline).alias("baseline_total"),
    )
    rate = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(b).cast("double"), F.lit(0.0))
    out = sums.withColumn("recent_rate", rate("recent_count", "recent_total")).withColumn("baseline_rate", rate("baseline_count", "baseline_total"))
    enough = (F.col("recent_total") >= least) & (F.col("baseline_total") >= least)
    return out.withColumn("alert", F.coalesce(enough & (F.col("recent_rate") - F.col("baseline_rate") >= rise), F.lit(False)))
