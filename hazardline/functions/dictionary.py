"""The data dictionary: choice texts as lookup rows, decoding and column labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.operators.scans import broadcast_small

# --- fixed values -----------------------------------------------------------------------------
FIELD = "field_name"
LABEL = "field_label"
CHOICES = "choices_calculations_or_slider_labels"
ALWAYS_MAPPED = {"nd": "Not done"}
MAP_CODES = 100
# ----------------------------------------------------------------------------------------------


def dictionary_codes(dd: DataFrame, order: str | None = None) -> DataFrame:
    """One row per field and code: ``field_name, code, label``.

    Choices read ``code, label | code, label``; the first comma splits. When a field is listed
    more than once its first row is used (by ``order``, else by a ``row_seq`` column, else by its text),
    and so is the first of repeated codes. Every mapped field also knows ``nd``.
    """
    order = order or ("row_seq" if "row_seq" in dd.columns else None)
    pick = F.min_by(CHOICES, order) if order else F.min(CHOICES)
    texts = dd.where(F.col(FIELD).isNotNull()).groupBy(FIELD).agg(pick.alias("_text")).where(F.col("_text").isNotNull())
    pairs = texts.select(FIELD, F.posexplode(F.split("_text", r"\s*\|\s*")).alias("_pos", "_pair"))
    parsed = pairs.select(
        FIELD,
        "_pos",
        F.regexp_extract("_pair", r"^\s*(.+?),\s*(.+?)\s*$", 1).alias("code"),
        F.regexp_extract("_pair", r"^\s*(.+?),\s*(.+?)\s*$", 2).alias("label"),
    ).where(F.col("code") != "")
    extra = texts.select(
        FIELD,
        F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.lit(t).alias("label")) for c, t in ALWAYS_MAPPED.items()])).alias("x"),
    ).select(FIELD, F.lit(1 << 30).alias("_pos"), "x.code", "x.label")
    return parsed.unionByName(extra).groupBy(FIELD, "code").agg(F.min_by("label", "_pos").alias("label"))


def decode(df: DataFrame, dd: DataFrame, columns: str | Sequence[str], order: str | None = None) -> DataFrame:
    """Replace coded values by their labels; unmapped codes become null.

    The dictionary is parsed once for all columns. Fields of at most ``MAP_CODES`` codes become map
    literals, so decoding adds no join; longer lists are joined, map-side while they stay small. A
    column without a choice text is an error.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    codes = dictionary_codes(dd.where(F.col(FIELD).isin(columns)), order).persist()
    sizes = {r[FIELD]: r["count"] for r in codes.groupBy(FIELD).count().collect()}  # at most one row per column
    missing = [c for c in columns if c not in sizes]
    if missing:
        raise ValueError(f"no choice text for: {', '.join(missing)}")
    short = [c for c in columns if sizes[c] <= MAP_CODES]
    maps: dict[str, list[Column]] = {c: [] for c in short}
    for r in codes.where(F.col(FIELD).isin(short)).collect() if short else []:
        maps[r[FIELD]] += [F.lit(r["code"]), F.lit(r["label"])]
    out = df.withColumns({c: F.try_element_at(F.create_map(*pairs), F.col(c).cast("string")) for c, pairs in maps.items()})
    names = df.columns
    for c in columns:
        if c in maps:
            continue
        lookup = codes.where(F.col(FIELD) == c).select(F.col("code").alias("_code"), F.col("label").alias("_label"))
        out = out.join(broadcast_small(lookup), F.col(c).cast("string") == F.col("_code"), "left").select(
            *[F.col("_label").alias(n) if n == c else F.col(n) for n in names]
        )
    return out


def clean_html(x: Column | str) -> Column:
    """Tags removed from a label."""
    return F.regexp_replace(F.col(x) if isinstance(x, str) else x, "<[^>]+>", "")


def add_labels(df: DataFrame, dd: DataFrame) -> DataFrame:
    """Attach the cleaned dictionary label of each column as metadata."""
    rows = (
        dd.where(F.col(FIELD).isin(df.columns))
        .groupBy(FIELD)
        .agg(F.first(clean_html(LABEL), ignorenulls=True).alias("label"))
        .collect()  # at most one row per column of df
    )
    for r in rows:
        if r["label"] is not None:
            df = df.withMetadata(r[FIELD], {"label": r["label"]})
    return df


def var_label(df: DataFrame, column: str) -> str | None:
    return df.schema[column].metadata.get("label")
