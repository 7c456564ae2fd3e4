"""Column functions: identities, text normalisation, dates, ratios, scores."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256(*parts: Column | str, sep: str = "|", length: int = 64) -> Column:
    """Hex SHA-256 of the joined parts (null if a part is null), cut to its first digits."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = cols[0].cast("string")
    for c in cols[1:]:
        joined = F.concat(joined, F.lit(sep), c.cast("string"))
    return F.left(F.sha2(joined, 256), F.lit(length))


def keyed(*parts: Column | str) -> Column:
    """Parts joined by ``::``; null if one is null."""
    cols = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    out = cols[0]
    for c in cols[1:]:
        out = F.concat(out, F.lit("::"), c)
    return out


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def slug(c: Column, most: int = 80, fallback: str = "unknown") -> Column:
    made = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    made = F.left(made, F.lit(most))
    return F.when(F.coalesce(made, F.lit("")) == "", fallback).otherwise(made)


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode normal form C; Spark has no built-in."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """ASCII letters of the compatibility decomposition."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def month_index(month: Column) -> Column:
    """yyyy-MM as a running number of months; null where it is no month."""
    return F.substring(month, 1, 4).try_cast("int") * 12 + F.substring(month, 6, 2).try_cast("int")


def millis_month(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM")


def iso_utc(ms: Column) -> Column:
    """ISO 8601 with an offset; fractions only where there are some."""
    stamp = F.timestamp_millis(ms)
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(ms % 1000 != 0, F.date_format(stamp, ".SSSSSS")).otherwise("")
    return F.concat(whole, fraction, F.lit("+00:00"))


def ratio(part: Column, whole: Column) -> Column:
    """A quotient that is null, not an error, where the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def tfidf(group_frequency: Column, document_frequency: Column, documents: Column) -> Column:
    return group_frequency * (F.log((documents + 1) / (document_frequency + 1)) + 1.0)


def round_even(x: Column, digits: int = 2) -> Column:
    """Rounded as the binary number that it is, ties to the even digit."""
    return F.regexp_replace(F.format_number(x, digits), ",", "").cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_even(ratio(part, whole) * 100, digits)


def timestamp(text: Column) -> Column:
    """A timestamp from ISO 8601 text, null where it is none."""
    return F.try_to_timestamp(text)


def canonical_map(m: Column) -> Column:
    """A map's entries in the order of their keys, which can be compared and hashed."""
    return F.array_sort(F.map_entries(m))


def short_title(title: Column, most: int = 58) -> Column:
    """The first comma clause, cut with an ellipsis."""
    clause = strip(F.substring_index(title, ",", 1))
    return F.when(F.length(clause) > most, F.concat(F.rtrim(F.left(clause, F.lit(most))), F.lit("…"))).otherwise(clause)


def phrase(text: Column, words: int = 12) -> Column:
    """The first words, without punctuation at the ends."""
    return F.regexp_replace(F.array_join(F.slice(F.split(squeeze(text), " "), 1, words), " "), r"^[\s\p{Punct}]+|[\s\p{Punct}]+$", "")


def theme_title(sentiment: Column, name: Column) -> Column:
    return F.concat(F.when(sentiment == "positive", "Praise: ").when(sentiment == "negative", "Concern: ").otherwise("Improve: "), name)


def sentiment_label(compound: Column, edge: float = 0.05) -> Column:
    """A score in [-1, 1] as a label; another score fails."""
    checked = F.when(compound.isNull() | compound.between(-1, 1), compound).otherwise(F.raise_error(F.lit("score out of range")))
    return F.when(checked >= edge, "positive").when(checked <= -edge, "negative").when(checked.isNotNull(), "neutral")


def entails(entailment: Column, neutral: Column, contradiction: Column) -> Column:
    return (entailment > neutral) & (entailment > contradiction)
