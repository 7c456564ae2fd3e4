"""Structured insights: contract checks, grounding of evidence in the text, candidates.

A response is a JSON object with one array ``insights``; each insight has a topic, a polarity,
an evidence quote and a target scope.  Evidence must occur once in the review, exactly or up
to white space and quote marks, and is written back as it stands there with its place.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.scalars import sha256, slug, squeeze

# Fixed values of the contract.
POLARITIES = ("positive", "negative", "neutral", "mixed")
TARGET_SCOPES = ("current_product", "other_product", "service_logistics", "usage_context", "unclear")
FIELDS = ("topic_raw", "polarity", "evidence", "target_scope")
MOST_INSIGHTS, LONGEST_EVIDENCE = 20, 300
QUOTES = "\"'“”‘’"


class Rejected(ValueError):
    """An insight or a response that breaks the contract."""


def response_schema() -> dict:
    """The JSON schema that a generator is held to."""
    text = {"type": "string", "minLength": 1}
    item = {
        "type": "object", "additionalProperties": False, "required": list(FIELDS),
        "properties": {"topic_raw": text, "polarity": {"enum": sorted(POLARITIES)}, "evidence": text | {"maxLength": LONGEST_EVIDENCE}, "target_scope": {"enum": sorted(TARGET_SCOPES)}},
    }
    return {"type": "object", "additionalProperties": False, "required": ["insights"], "properties": {"insights": {"type": "array", "maxItems": MOST_INSIGHTS, "items": item}}}


def ground(text: str, evidence: str) -> tuple[int, int]:
    """The one place of a quote in a text."""
    places = occurrences(text, evidence)
    if len(places) == 1:
        return places[0]
    if places:
        raise Rejected("evidence has multiple exact matches")
    words = evidence.split()
    if not words:
        raise Rejected("evidence is blank")
    loose = r"\s+".join("".join(f"[{QUOTES}]" if c in QUOTES else re.escape(c) for c in w) for w in words)
    found = [m.span() for m in re.finditer(loose, text)]
    if len(found) == 1:
        return found[0]
    raise Rejected("evidence has multiple loose matches" if found else "evidence not found")


def occurrences(text: str, evidence: str) -> list[tuple[int, int]]:
    """All exact places of a quote in a text, overlapping ones too."""
    return [(m.start(), m.start() + len(evidence)) for m in re.finditer(f"(?={re.escape(evidence)})", text)] if evidence else []


def ground_at(text: str, evidence: str, occurrence: int | None) -> tuple[int, int]:
    """The place of a quote that stands several times in a text, by its number from 0; without one as ground()."""
    if occurrence is None:
        return ground(text, evidence)
    places = occurrences(text, evidence)
    if not 0 <= occurrence < len(places):
        raise Rejected("evidence has no such occurrence")
    return places[occurrence]


def ambiguity(df: DataFrame, text_col: str, evidence_col: str) -> DataFrame:
    """One row: quotes, those that stand exactly once, several times or not at all in their texts, and the share of several."""
    text, quote = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(evidence_col), F.lit(""))
    # places are counted by trying each offset: overlapping ones count
    places = F.when(quote == "", 0).otherwise(F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.length(quote)) == quote)))
    counted = df.select(places.alias("n")).agg(F.count("*").alias("quotes"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") > 1).alias("several"), F.count_if(F.col("n") == 0).alias("absent"))
    return counted.withColumn("ambiguity_rate", F.col("several") / F.nullif(F.col("quotes"), F.lit(0)))


def _one_of(value, allowed) -> bool:
    return isinstance(value, str) and value in allowed


#: What an insight must meet, in this order, and what is said where it doesn't.
RULES = (
    (lambda raw: isinstance(raw, dict) and set(raw) == set(FIELDS), "fields are missing or unknown"),
    (lambda raw: isinstance(raw["topic_raw"], str) and raw["topic_raw"].strip(), "topic is empty"),
    (lambda raw: isinstance(raw["evidence"], str) and raw["evidence"], "evidence is empty"),
    (lambda raw: _one_of(raw["polarity"], POLARITIES), "polarity is not allowed"),
    (lambda raw: _one_of(raw["target_scope"], TARGET_SCOPES), "target_scope is not allowed"),
)


def check_insight(text: str, raw) -> dict:
    broken = next((problem for holds, problem in RULES if not holds(raw)), None)
    if broken:
        raise Rejected(broken)
    a, b = ground(text, raw["evidence"])
    return raw | {"topic_raw": raw["topic_raw"].strip(), "evidence": text[a:b], "evidence_char_start": a, "evidence_char_end": b}


def accept(text: str, response: str | None) -> dict:
    """Good insights (the first of equal topic, evidence and scope), rejected ones with their reasons, and a status."""
    try:
        value = json.loads(response or "")
        items = value["insights"] if isinstance(value, dict) and set(value) == {"insights"} else None
    except ValueError:
        items = None
    if not isinstance(items, list):
        return {"processing_status": "failed", "insights": [], "rejected_insights": [], "error_message": "the response is no object with only an insights array"}
    good, bad, seen = [], [], set()
    for index, raw in enumerate(items):
        try:
            found = check_insight(text, raw)
        except Rejected as error:
            bad.append({"index": index, "error_message": str(error), "raw_insight": json.dumps(raw, ensure_ascii=False)})
            continue
        key = (found["topic_raw"].casefold(), found["evidence"], found["target_scope"])
        if key not in seen:
            seen.add(key)
            good.append(found)
    status = "partial_success" if good and bad else "success" if good else "failed" if bad else "success_no_insight"
    return {"processing_status": status, "insights": good, "rejected_insights": bad, "error_message": "all insights were rejected" if status == "failed" else None}


RECORD = (
    "processing_status string, error_message string, "
    "insights array<struct<topic_raw:string,polarity:string,evidence:string,evidence_char_start:int,evidence_char_end:int,target_scope:string>>, "
    "rejected_insights array<struct<index:int,error_message:string,raw_insight:string>>"
)


def validate_responses(df: DataFrame, id_col: str, text_col: str, response_col: str) -> DataFrame:
    """A record for each response."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{id_col: i} | accept(t or "", r) for i, t, r in zip(pdf[id_col], pdf[text_col], pdf[response_col], strict=True)]
            yield pd.DataFrame(rows, columns=[id_col, "processing_status", "error_message", "insights", "rejected_insights"])

    return df.select(id_col, text_col, response_col).mapInPandas(run, f"{id_col} {kind}, {RECORD}")


def candidates(records: DataFrame, products: DataFrame, polarities: tuple[str, ...] = POLARITIES, scopes: tuple[str, ...] = ("current_product",)) -> DataFrame:
    """Insights as rows with a stable id and a text to embed; records need review_id and product_id.

    Insights of products without metadata are left out."""
    rows = records.select("review_id", "product_id", F.col("processing_status"), F.posexplode("insights").alias("insight_index", "i")).select("review_id", "product_id", "processing_status", "insight_index", "i.*")
    kept = rows.filter(F.col("polarity").isin(*polarities) & F.col("target_scope").isin(*scopes))
    named = kept.join(products.select("product_id", "title", "category"), "product_id")
    return (
        named.withColumn("candidate_id", sha256("review_id", "product_id", "insight_index", "topic_raw", "evidence", "target_scope", "polarity", length=24))
        .withColumn("category_slug", slug(F.col("category")))
        .withColumn("candidate_text", F.concat(squeeze(F.col("topic_raw")), F.lit(": "), squeeze(F.col("evidence"))))
    )


def candidate_counters(records: DataFrame, products: DataFrame, polarities: tuple[str, ...] = POLARITIES, scopes: tuple[str, ...] = ("current_product",)) -> DataFrame:
    """One row of counts: what the candidates were made of and why others were left out."""
    rows = records.select("product_id", "processing_status", F.explode_outer("insights").alias("i")).join(products.select("product_id").distinct().withColumn("known", F.lit(True)), "product_id", "left")
    there = F.col("i").isNotNull()
    wrong_scope, wrong_polarity = there & ~F.col("i.target_scope").isin(*scopes), there & F.col("i.target_scope").isin(*scopes) & ~F.col("i.polarity").isin(*polarities)
    right = there & F.col("i.target_scope").isin(*scopes) & F.col("i.polarity").isin(*polarities)
    return rows.agg(F.count_if(there).alias("insights"), F.count_if(wrong_scope).alias("other_scope"), F.count_if(wrong_polarity).alias("other_polarity"), F.count_if(right & F.col("known").isNull()).alias("unknown_product"), F.count_if(right & F.col("known")).alias("candidates"))
