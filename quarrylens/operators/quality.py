"""Data quality: checks that are collected before they fail, replay comparison, fingerprints, profiles."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Checks:
    """Named checks; each counts its offending rows.  All run before anything fails."""

    found: dict[str, int] = field(default_factory=dict)

    def none(self, name: str, offending: DataFrame) -> None:
        self.found[name] = offending.count()

    def unique(self, name: str, df: DataFrame, *keys: str) -> None:
        self.none(name, df.groupBy(*keys).count().filter("count > 1"))

    def references(self, name: str, child: DataFrame, parent: DataFrame, key: str) -> None:
        self.none(name, child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti"))

    def within(self, name: str, df: DataFrame, column: str, low: float, high: float) -> None:
        self.none(name, df.filter(~F.col(column).between(low, high)))

    def among(self, name: str, df: DataFrame, column: str, *allowed: str) -> None:
        self.none(name, df.filter(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))))

    def conserved(self, name: str, whole: int, *parts: int) -> None:
        self.found[name] = abs(whole - sum(parts))

    def expected(self, name: str, now: int, want: int) -> None:
        self.found[name] = abs(now - want)

    def report(self) -> dict:
        return {"status": "failed" if any(self.found.values()) else "passed", "checks": dict(self.found)}

    def finish(self, write: Callable[[dict], None] | None = None) -> dict:
        """Writes the report, then fails if a check did."""
        out = self.report()
        if write:
            write(out)
        if out["status"] == "failed":
            raise ValueError(f"checks failed: {[k for k, v in out['checks'].items() if v]}")
        return out


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows, violations) in one pass; a null outcome counts as a violation."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]))
    return counts.select("rows", each.alias("r")).select("r.rule", "rows", "r.violations")


def comparable(df: DataFrame) -> DataFrame:
    """Maps as sorted entries, so that rows can be compared, grouped and hashed."""
    return df.select(*[F.array_sort(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields])


def row_digest(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    plain = [F.array_sort(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name) if f.name not in without]
    return F.sha2(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}), 256)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (as a multiset) of only one side, with the side."""
    a, b = comparable(a), comparable(b)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def replay_differences(first: DataFrame, again: DataFrame, key: str, without: tuple[str, ...] = (), subset: bool = False) -> DataFrame:
    """(key, difference): rows missing in the second run, added by it (unless it is a subset run), or changed."""
    a = first.select(key, row_digest(first, without).alias("da"))
    b = again.select(key, row_digest(again, without).alias("db"))
    missing = a.join(b, key, "left_anti").select(key, F.lit("missing").alias("difference"))
    added = b.join(a, key, "left_anti").select(key, F.lit("added").alias("difference"))
    changed = a.join(b, key).filter(~F.col("da").eqNullSafe(F.col("db"))).select(key, F.lit("changed").alias("difference"))
    return (added if subset else missing.unionByName(added)).unionByName(changed)


def fingerprint(df: DataFrame, key: str) -> DataFrame:
    """One row that does not depend on order: rows, distinct keys, sum of row hashes, least and greatest key."""
    hashed = F.xxhash64(row_digest(df)).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), F.sum(hashed).alias("hash_sum"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def group_profile(df: DataFrame, *keys: str, most: int = 1000) -> list[dict]:
    """Group counts for a report; more than ``most`` groups are refused, not cut."""
    rows = df.groupBy(*keys).count().orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} groups")
    return [r.asDict() for r in rows]


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, filled, distinct, fill_ratio) of each column, in one pass."""
    aggregates = [F.count("*").alias("rows")]
    for c in columns:
        aggregates += [F.count(c).alias(f"{c}__filled"), F.countDistinct(c).alias(f"{c}__distinct")]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__filled").alias("filled"), F.col(f"{c}__distinct").alias("distinct")) for c in columns]))
    return df.agg(*aggregates).select("rows", each.alias("c")).select("c.column", "rows", "c.filled", "c.distinct", (F.col("c.filled") / F.nullif("rows", F.lit(0))).alias("fill_ratio"))


def admission_errors(df: DataFrame, key: str, triggered: Column) -> DataFrame:
    """Rows that must not enter a stage: no key, a key twice, nothing that triggers the work."""
    missing = df.filter(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "").select(F.lit("missing_key").alias("error"), F.col(key).cast("string").alias("key"))
    twice = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_key").alias("error"), F.col(key).cast("string").alias("key"))
    idle = df.filter(~F.coalesce(triggered, F.lit(False))).select(F.lit("not_triggered").alias("error"), F.col(key).cast("string").alias("key"))
    return missing.unionByName(twice).unionByName(idle)


def span_violations(df: DataFrame, text_col: str, start_col: str, end_col: str, piece_col: str) -> DataFrame:
    """Rows whose piece is not what stands at their place in the text."""
    start, end = F.col(start_col), F.col(end_col)
    own = F.substring(F.col(text_col), start + 1, end - start)
    return df.filter(~F.coalesce((start >= 0) & (end > start) & (end <= F.length(text_col)) & (own == F.col(piece_col)), F.lit(False)))


def run_record(code: dict[str, str], inputs: dict[str, str], command: list[str], versions: dict[str, str]) -> dict:
    """Provenance of a run: SHA-256 of code and inputs (by path), command and versions."""
    def digest(path: str) -> str:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()

    return {"code": {n: digest(p) for n, p in code.items()}, "inputs": {n: digest(p) for n, p in inputs.items()}, "command": command, "versions": versions}
