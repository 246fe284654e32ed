"""Line deduplication over overlapping windows of three lines.

Every three consecutive lines are hashed; windows that occur more than once anywhere keep their first occurrence, and
the lines that later ones cover are removed. Only hashes and positions are shuffled to find them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines of a window.
WIDTH = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def covered_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, t1 (the text's hash), starts: sorted positions from 0 where later occurrences start, for rows that have
    any. The first occurrence is the one of the smallest doc_id (null first), text hash and position."""
    lines = F.transform(_lines(F.col("text").cast("string")), _trimmed)
    source = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("t1"), lines.alias("lines")).where(F.size("lines") >= width)
    window = lambda i: F.array_join(F.slice(F.col("lines"), i + 1, width), "\n")
    blank = "\n" * (width - 1)

    def hashed(i: Column) -> Column:
        joined = window(i)
        return F.when(joined != blank, F.struct(F.xxhash64(joined).alias("h1"), F.xxhash64(F.lit(1), joined).alias("h2")))

    windows = source.select(
        "doc_id", "t1", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("lines") - width), hashed)).alias("pos", "h")
    ).where("h is not null").select("doc_id", "t1", "pos", "h.h1", "h.h2")
    place = F.struct("doc_id", "t1", "pos")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    later = windows.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "t1").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def _kept(lines: Column, starts: Column, width: int) -> Column:
    """The lines outside the windows at ``starts``: slices between one window's end and the next one's start, so the cost
    is that of the lines, however many are covered."""
    ends = F.concat(F.array(F.lit(0)), F.transform(starts, lambda p: p + width))
    gaps = F.arrays_zip(ends.alias("low"), F.concat(starts, F.array(F.size(lines))).alias("high"))
    open_gaps = F.filter(gaps, lambda g: g["high"] > g["low"])
    return F.flatten(F.transform(open_gaps, lambda g: F.slice(lines, g["low"] + 1, g["high"] - g["low"])))


def _joined(docs: DataFrame, width: int) -> tuple[DataFrame, Column, Column]:
    """``docs`` with the starts of covered windows joined on, the text without their lines, and how many lines go."""
    gone = covered_lines(docs, width).select(F.col("doc_id").alias("id_"), F.col("t1").alias("t1_"), F.col("starts").alias("starts_"))
    same = docs["doc_id"].eqNullSafe(gone["id_"]) & (F.xxhash64(docs["text"].cast("string")) == gone["t1_"])
    starts = gone["starts_"]  # bound to its table: ``docs`` may have a column of this name
    # the lines are made once, as the element of an array
    kept = F.transform(F.array(_lines(docs["text"].cast("string"))), lambda lines: F.array_join(_kept(lines, starts, width), "\n"))[0]
    text = F.when(starts.isNotNull(), kept).otherwise(docs["text"])
    later = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.lit(2**31 - 1)))
    removed = F.aggregate(F.zip_with(starts, later, lambda a, b: F.least(b - a, F.lit(width))), F.lit(0), lambda n, x: n + x)
    return docs.join(gone, same, "left"), text, F.coalesce(removed, F.lit(0)).cast("long")


def dedup_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_lines, n_removed, text for each row; see :func:`dedup_lines` for the rules."""
    rows, text, removed = _joined(docs, width)
    n = F.when(docs["text"].isNull(), 0).otherwise(F.size(_lines(docs["text"].cast("string")))).cast("long")
    return rows.select(docs["doc_id"], n.alias("n_lines"), removed.alias("n_removed"), text.alias("text"))


def dedup_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the lines removed that later occurrences of repeated windows cover.

    Lines are compared without blanks, tabs and carriage returns at their ends; windows of blank lines alone are left.
    Overlapping occurrences are merged, inside one text too. A text without repeats, of fewer lines than a window, empty
    or null stays as it is. Rows that repeat doc_id and text are one document and keep the same lines. All columns are
    kept, of any name; n_chars, where there is one, follows a changed text. A text is one row, however long; a window
    that is in very many documents is counted before it is shuffled.
    """
    rows, text, removed = _joined(docs, width)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(removed > 0, F.length(text).cast(dict(docs.dtypes)["n_chars"])).otherwise(docs["n_chars"])
    return rows.select(*(new.get(c, docs[c]).alias(c) for c in docs.columns))


#: The report as DuckDB SQL.
REPORT_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) raw FROM documents),
t AS (SELECT doc_id, list_transform(raw, lambda x: trim(x, ' ' || chr(9) || chr(13))) w FROM l WHERE len(raw) >= 3),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 2], chr(10)) g FROM t, unnest(range(1, len(w) - 1)) u(i)),
placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) k FROM wins WHERE g <> chr(10) || chr(10)),
gone AS (SELECT DISTINCT doc_id, p FROM placed, unnest(range(i, i + 3)) u(p) WHERE k > 1),
lists AS (SELECT doc_id, list(p) ps, count(*) n FROM gone GROUP BY doc_id)
SELECT l.doc_id, CAST(coalesce(len(raw), 0) AS BIGINT) n_lines, CAST(coalesce(n, 0) AS BIGINT) n_removed,
  CASE WHEN n IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(raw) + 1), lambda j: NOT list_contains(ps, j)), lambda j: raw[j]), chr(10)) END text
FROM l LEFT JOIN lists USING (doc_id)
"""
