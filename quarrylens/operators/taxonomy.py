"""Taxonomies from reviewed decisions, and the mapping of candidates through clusters to themes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.scalars import percent, sha256
from quarrylens.operators.gold import MAPPED


def decision_rows(decisions: DataFrame) -> DataFrame:
    """Decisions (category, themes array of name, definition, member_cluster_ids) as a row for each cluster."""
    themes = decisions.select("category", F.explode("themes").alias("t")).select("category", F.col("t.name").alias("theme_name"), F.col("t.definition").alias("definition"), F.col("t.member_cluster_ids").alias("ids"))
    return themes.select("category", "theme_name", "definition", F.explode_outer("ids").alias("cluster_id"))


def decision_errors(decisions: DataFrame, clusters: DataFrame) -> DataFrame:
    """What is wrong with decisions: (error, category, cluster_id).

    Unknown clusters, clusters named twice or missing, themes without a name, clusters of another category."""
    rows = decision_rows(decisions)
    blank = rows.filter(F.coalesce(F.trim("theme_name"), F.lit("")) == "").select(F.lit("empty_name").alias("error"), "category", "cluster_id")
    named = rows.filter("cluster_id is not null")
    known = clusters.select("cluster_id", F.col("category").alias("own_category"))
    joined = named.join(known, "cluster_id", "left")
    unknown = joined.filter("own_category is null").select(F.lit("unknown_cluster").alias("error"), "category", "cluster_id")
    other = joined.filter("own_category <> category").select(F.lit("category_mismatch").alias("error"), "category", "cluster_id")
    twice = named.groupBy("category", "cluster_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_cluster").alias("error"), "category", "cluster_id")
    missing = clusters.join(decisions.select("category").distinct(), "category", "left_semi").join(named.select("cluster_id"), "cluster_id", "left_anti").select(F.lit("missing_cluster").alias("error"), "category", "cluster_id")
    return blank.unionByName(unknown).unionByName(other).unionByName(twice).unionByName(missing)


def taxonomy(decisions: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(taxonomy with sizes, cluster map); clusters need cluster_id, category, review_count and product_count."""
    named = decision_rows(decisions).filter("cluster_id is not null").withColumn("taxonomy_id", sha256(F.col("category"), F.lower("theme_name"), length=24))
    cluster_map = named.select("category", "cluster_id", "taxonomy_id", "theme_name")
    sizes = named.join(clusters.select("cluster_id", "review_count", "product_count"), "cluster_id").groupBy("category", "taxonomy_id").agg(
        F.min("theme_name").alias("theme_name"), F.count("*").alias("cluster_count"), F.sum("review_count").alias("review_count"), F.sum("product_count").alias("product_count")
    )
    return sizes, cluster_map


def local_catalog(local: DataFrame) -> DataFrame:
    """Block decisions (category, block_id, themes) as a row for each local theme."""
    themes = local.select("category", "block_id", F.posexplode("themes").alias("n", "t"))
    return themes.select("category", "block_id", F.concat(F.col("block_id").cast("string"), F.lit(":"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("local_theme_id"), F.col("t.name").alias("local_name"), F.col("t.member_cluster_ids").alias("cluster_ids"))


def expand_global(catalog: DataFrame, decisions: DataFrame) -> DataFrame:
    """Clusters of global themes: theme -> local themes -> clusters.

    Decisions: category, theme_name, local_theme_ids."""
    chosen = decisions.select("category", "theme_name", F.explode("local_theme_ids").alias("local_theme_id"))
    joined = chosen.join(catalog.select("category", "local_theme_id", "cluster_ids"), ["category", "local_theme_id"])
    return joined.select("category", "theme_name", "local_theme_id", F.explode("cluster_ids").alias("cluster_id")).withColumn("taxonomy_id", sha256(F.col("category"), F.lower("theme_name"), length=24))


def map_candidates(candidates: DataFrame, members: DataFrame, cluster_map: DataFrame, themes: DataFrame, small: int = 200_000) -> DataFrame:
    """Candidates with cluster, taxonomy and theme name, unmapped ones kept.

    The cluster map and the themes are sent to all tasks if they have at most ``small`` rows."""
    side = lambda df: F.broadcast(df) if df.limit(small + 1).count() <= small else df
    joined = (
        candidates.join(members.select("candidate_id", "cluster_id", "center_similarity"), "candidate_id", "left")
        .join(side(cluster_map.select("cluster_id", "taxonomy_id")), "cluster_id", "left")
        .join(side(themes.select("taxonomy_id", F.col("theme_name").alias("canonical_theme_name"))), "taxonomy_id", "left")
    )
    return joined.withColumn("mapping_status", F.when(F.col("taxonomy_id").isNotNull(), MAPPED).otherwise("unmapped"))


def mapping_errors(candidates: DataFrame, members: DataFrame, fields: tuple[str, ...] = ("review_id", "product_id")) -> DataFrame:
    """Members without a candidate, candidates in two clusters, members whose fields differ from the candidate's."""
    orphans = members.join(candidates.select("candidate_id"), "candidate_id", "left_anti").select(F.lit("orphan_member").alias("error"), "candidate_id")
    twice = members.groupBy("candidate_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_member").alias("error"), "candidate_id")
    both = members.alias("m").join(candidates.alias("c"), "candidate_id")
    differ = None
    for f in fields:
        d = ~F.col(f"m.{f}").eqNullSafe(F.col(f"c.{f}"))
        differ = d if differ is None else differ | d
    return orphans.unionByName(twice).unionByName(both.filter(differ).select(F.lit("identity_mismatch").alias("error"), "candidate_id"))


def mapping_coverage(mapped: DataFrame, *keys: str) -> DataFrame:
    hit = F.count_if(F.col("mapping_status") == MAPPED)
    return mapped.groupBy(*keys).agg(F.count("*").alias("total"), hit.alias("mapped"), (F.count("*") - hit).alias("unmapped"), percent(hit, F.count("*")).alias("coverage_pct"))
