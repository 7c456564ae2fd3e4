"""Read-only queries over the aggregates, with the overlay of corrected sentiments.

The overlay has product_id, taxonomy_id and to_sentiment; it only changes rows whose own
sentiment is negative, and a corrected row gives way to a positive row of the same theme.
Corrected rows keep their theme_id.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.sources.readers import read_improvements, read_manifest, read_overlay

FACET_ORDER = {"positive_evaluation": 1, "negative_evaluation": 2, "improvement": 3}


def categories(products: DataFrame) -> DataFrame:
    return products.filter("category is not null").select("category").distinct().orderBy("category")


def search_products(products: DataFrame, needle: str | None = None, category: str | None = None, status: str | None = None) -> DataFrame:
    """Products whose title or id holds the text (no wildcards), by reviews, then id."""
    found = products
    if needle:
        low = needle.lower()
        found = found.filter(F.lower("title").contains(low) | F.lower(F.col("product_id").cast("string")).contains(low))
    if category is not None:
        found = found.filter(F.col("category") == category)
    if status is not None:
        found = found.filter(F.col("analysis_status") == status)
    return found.orderBy(F.desc("review_count"), "product_id")


def page(ordered: DataFrame, number: int, size: int) -> DataFrame:
    return ordered.offset((number - 1) * size).limit(size)


def envelope(ordered: DataFrame, number: int, size: int) -> dict:
    """A page of rows with the totals that an API reply carries."""
    total = ordered.count()
    rows = [r.asDict(recursive=True) for r in page(ordered, number, size).collect()]
    return {"data": rows, "page": {"number": number, "size": size, "total": total, "pages": -(-total // size)}}


def error_envelope(code: str, message: str) -> dict:
    return {"error": {"code": code, "message": message}}


def valid_overlay(corrections: DataFrame) -> DataFrame:
    keys = F.col("product_id").isNotNull() & F.col("taxonomy_id").isNotNull()
    return corrections.filter(keys & F.col("to_sentiment").isin("positive", "negative")).groupBy("product_id", "taxonomy_id").agg(F.max("to_sentiment").alias("to_sentiment"))


def effective_themes(themes: DataFrame, overlay: DataFrame) -> DataFrame:
    """``themes`` with effective_sentiment, without rows that a correction makes superfluous."""
    corrected = overlay.select("product_id", "taxonomy_id", F.col("to_sentiment").alias("__to"))
    joined = themes.join(corrected, ["product_id", "taxonomy_id"], "left")
    changed = (F.col("sentiment") == "negative") & F.coalesce(F.col("__to") != "negative", F.lit(False))
    joined = joined.withColumn("effective_sentiment", F.when(F.col("sentiment") == "negative", F.coalesce("__to", "sentiment")).otherwise(F.col("sentiment"))).withColumn("corrected", changed)
    positives = themes.filter("sentiment = 'positive'").select("product_id", "taxonomy_id").withColumn("__has", F.lit(True))
    joined = joined.join(positives, ["product_id", "taxonomy_id"], "left")
    return joined.filter(~(F.col("corrected") & F.coalesce("__has", F.lit(False)))).drop("__to", "__has")


def product_themes(themes: DataFrame, overlay: DataFrame, sentiment: str) -> DataFrame:
    return effective_themes(themes, overlay).filter(F.col("effective_sentiment") == sentiment).orderBy(F.desc("review_count"), "name")


def improvements(items: DataFrame, themes: DataFrame, overlay: DataFrame) -> DataFrame:
    """Improvement groups that no correction takes back, with their negative theme's figures or their own."""
    negative = themes.filter("sentiment = 'negative'").select("product_id", "taxonomy_id", "theme_id", F.col("review_count").alias("theme_review_count"), "ratio_value")
    kept = items.join(overlay.select("product_id", "taxonomy_id"), ["product_id", "taxonomy_id"], "left_anti")
    return kept.join(negative, ["product_id", "taxonomy_id"], "left").withColumn("review_count", F.coalesce("theme_review_count", "support_review_count", F.lit(0))).drop("theme_review_count")


def overview(products: DataFrame, themes: DataFrame, items: DataFrame, overlay: DataFrame) -> DataFrame:
    """Each product's three facets, refreshed from what the lists would show."""
    shown = effective_themes(themes, overlay).groupBy("product_id", F.concat("effective_sentiment", F.lit("_evaluation")).alias("facet")).agg(F.count("*").alias("n"))
    open_items = items.join(overlay.select("product_id", "taxonomy_id"), ["product_id", "taxonomy_id"], "left_anti")
    shown = shown.unionByName(open_items.groupBy("product_id").agg(F.count("*").alias("n")).withColumn("facet", F.lit("improvement")))
    grid = products.select("product_id", "title", "category", F.explode(F.array(*[F.lit(f) for f in FACET_ORDER])).alias("facet"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(shown, ["product_id", "facet"], "left").select(
        "product_id", "title", "category", "facet", n.alias("theme_count"), F.when(n > 0, "ready").otherwise("empty").alias("status"), F.when(n == 0, "no_items").alias("empty_reason")
    )


def theme_trend(themes: DataFrame, series: DataFrame) -> DataFrame:
    """Themes with their months as an ordered array of structs."""
    keys = ["product_id", "taxonomy_id", "sentiment"]
    trend = series.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("review_month", "review_count", "eligible_review_count", "ratio_value"))).alias("trend"))
    return themes.join(trend, keys, "left")


def evidence_page(evidence: DataFrame, product_id, taxonomy_id: str, sentiment: str, number: int, size: int) -> DataFrame:
    """A theme's reviews, newest month first (no month last), then by review."""
    found = evidence.filter((F.col("product_id") == product_id) & (F.col("taxonomy_id") == taxonomy_id) & (F.col("sentiment") == sentiment))
    return page(found.orderBy(F.desc_nulls_last("review_month"), "review_id"), number, size)


@dataclass
class InsightRepository:
    """The nine read queries over one set of tables; a missing product is None, not an error."""

    products: DataFrame
    facets: DataFrame
    themes: DataFrame
    series: DataFrame
    evidence: DataFrame
    improvement_items: DataFrame
    overlay: DataFrame
    batch: dict

    def __post_init__(self):
        if self.batch.get("status") != "ready":
            raise ValueError("the batch is not ready")
        self.overlay = valid_overlay(self.overlay)

    @classmethod
    def open(cls, spark, folder: str, overlay_path: str, improvements_path: str, improvement_schema: str) -> InsightRepository:
        """From a published folder: Parquet tables and validation.json; a missing file or a batch that is not ready fails."""
        root = Path(folder)
        needed = [root / f"{n}.parquet" for n in ("products", "product_facets", "themes", "theme_timeseries", "theme_reviews")] + [root / "validation.json", Path(overlay_path), Path(improvements_path)]
        missing = [p.name for p in needed if not p.exists()]
        if missing:
            raise FileNotFoundError(f"missing: {missing}")
        tables = [spark.read.parquet(str(p)) for p in needed[:5]]
        return cls(*tables, read_improvements(spark, improvements_path, improvement_schema), read_overlay(spark, overlay_path), read_manifest(str(needed[5])))

    def _known(self, product_id) -> bool:
        return not self.products.filter(F.col("product_id") == product_id).isEmpty()

    def categories(self) -> list[str]:
        return [r[0] for r in categories(self.products).collect()]

    def search(self, needle: str | None = None, category: str | None = None, number: int = 1, size: int = 20) -> dict:
        return envelope(search_products(self.products, needle, category), number, size)

    def overview(self, product_id) -> dict | None:
        found = overview(self.products.filter(F.col("product_id") == product_id), self.themes, self.improvement_items, self.overlay).collect()
        rows = sorted((r.asDict() for r in found), key=lambda r: FACET_ORDER[r["facet"]])
        return {"product": {k: rows[0][k] for k in ("product_id", "title", "category")}, "facets": rows} if rows else None

    def themes_of(self, product_id, sentiment: str) -> list[dict] | None:
        if not self._known(product_id):
            return None
        own = self.themes.filter(F.col("product_id") == product_id)
        return [r.asDict() for r in product_themes(own, self.overlay, sentiment).collect()]

    def improvements_of(self, product_id) -> list[dict] | None:
        if not self._known(product_id):
            return None
        own = self.improvement_items.filter(F.col("product_id") == product_id)
        return [r.asDict(recursive=True) for r in improvements(own, self.themes, self.overlay).orderBy(F.desc("review_count"), "taxonomy_id").collect()]

    def theme(self, theme_id: str) -> dict | None:
        row = theme_trend(effective_themes(self.themes, self.overlay).filter(F.col("theme_id") == theme_id), self.series).first()
        return row.asDict(recursive=True) if row else None

    def evidence_of(self, product_id, taxonomy_id: str, sentiment: str, number: int = 1, size: int = 20) -> list[dict]:
        return [r.asDict() for r in evidence_page(self.evidence, product_id, taxonomy_id, sentiment, number, size).collect()]

    def health(self) -> dict:
        return {"status": "ok", "batch_id": self.batch.get("batch_id"), "products": self.products.count()}
