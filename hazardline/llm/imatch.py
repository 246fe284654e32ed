"""I-Match fingerprints: distinct terms of middling document frequency, hashed per randomised lexicon subset.

The lexicon is the terms whose inverse document frequency lies in a band; it is cut into random subsets at several
grains. A text has one hash per subset, of its sorted distinct terms in it. Coarse subsets tell short texts apart, fine
ones still agree where long texts share a part. Everything is DataFrame expressions.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Share of all documents that a lexicon term is in: at least and at most. A lexicon has at most the mean number of
#: distinct terms of a document, divided by the lower share, whatever the number of documents.
BAND = (1 / 200, 1 / 10)
#: Grains: a term is drawn where its md5 starts with so many zeros (1 in 16 each), and dealt to one of sixteen subsets by
#: the digit after them.
GRAINS = (0, 1, 2)
DIGITS = "0123456789abcdef"
#: Subsets of a grain that must be in use for it to count towards a likeness, unless no grain has as many.
IN_USE = 4
#: Slots of the lookup table of lexicon terms.
SLOTS = 16_384
#: Rows that a range of neighbouring ids has on average, and cut points between ranges at most (on average): a larger
#: table gets larger ranges, so that what every task is sent stays at a few megabytes.
BUCKET_ROWS, CUT_POINTS = 8_192, 50_000


def terms(text: Column) -> Column:
    """Distinct lower-cased words of a text."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), ""))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """term: those in at least and at most the given shares of all rows of ``docs`` (text)."""
    rows = docs.count()
    low, high = max(2, math.ceil(band[0] * rows)), math.floor(band[1] * rows)
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return df.where(F.col("df").between(low, high)).select("term")


def _slots(words: DataFrame) -> Column:
    """The lexicon as a constant: an array of SLOTS arrays of terms. Its size is bounded by the band (see BAND)."""
    slots: list[list[str]] = [[] for _ in range(SLOTS)]
    for row in words.select("term", F.pmod(F.xxhash64("term"), F.lit(SLOTS)).cast("int").alias("slot")).toLocalIterator():
        slots[row["slot"]].append(row["term"])
    return F.from_json(F.lit(json.dumps(slots, ensure_ascii=False)), "array<array<string>>")


def fingerprint(text: Column, slots: Column) -> Column:
    """The hashes of a text's lexicon subsets: four hexadecimal digits each, "-" for an empty one, "." between subsets
    and "/" between grains. A text without lexicon terms has one hash of all its distinct terms, after "="."""
    words = terms(text)
    known = F.filter(words, lambda t: F.array_contains(F.element_at(slots, F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int") + 1), t))
    return _with(F.struct(words.alias("all"), F.array_sort(known).alias("known")), _hashes)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once."""
    return F.transform(F.array(value), use)[0]


def _hashes(both: Column) -> Column:
    def subset(own: Column, zeros: int, digit: Column) -> Column:
        mine = F.transform(F.filter(own, lambda x: F.substring(x["m"], zeros + 1, 1) == digit), lambda x: x["t"])
        return _with(mine, lambda ts: F.when(F.size(ts) == 0, "-").otherwise(F.substring(F.md5(F.array_join(ts, " ")), 1, 4)))

    def grain(dealt: Column, zeros: int) -> Column:
        mine = F.filter(dealt, lambda x: F.startswith(x["m"], F.lit("0" * zeros))) if zeros else dealt
        digits = F.array(*map(F.lit, DIGITS))
        return _with(mine, lambda own: F.array_join(F.transform(digits, lambda digit: subset(own, zeros, digit)), "."))

    dealt = F.transform(both["known"], lambda t: F.struct(t.alias("t"), F.md5(t).alias("m")))
    marks = _with(dealt, lambda own: F.concat_ws("/", *(grain(own, zeros) for zeros in GRAINS)))
    rest = F.concat(F.lit("="), F.md5(F.array_join(F.array_sort(both["all"]), " ")))
    return F.when(F.size(both["known"]) == 0, rest).otherwise(marks)


def likeness(one: Column, other: Column) -> Column:
    """How far two fingerprints agree: in the best grain, the share of its subsets not empty in both that are equal.
    Equal fingerprints have 1; one without lexicon terms is like no other."""

    def grain(pair: Column) -> Column:
        cells = F.arrays_zip(F.split(pair["a"], "[.]").alias("x"), F.split(pair["b"], "[.]").alias("y"))
        used = F.filter(cells, lambda c: (c["x"] != "-") | (c["y"] != "-"))
        return _with(used, lambda u: F.struct((F.size(u) >= IN_USE).alias("enough"), (F.size(F.filter(u, lambda c: c["x"] == c["y"])) / F.greatest(F.size(u), F.lit(1))).alias("share")))

    grains = F.transform(F.arrays_zip(F.split(one, "/").alias("a"), F.split(other, "/").alias("b")), grain)
    none = F.startswith(one, F.lit("=")) | F.startswith(other, F.lit("="))
    return F.when(one == other, 1.0).when(none, 0.0).otherwise(F.array_max(grains)["share"])


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, t1 (the text's hash), bucket, copy: rows cut into ranges of descending doc_id (nulls last, ties by t1).

    Ids may be numbers, texts or dates. Ranges are cut at rows drawn by hash, so they follow the rows however ids
    are spread, and rows that repeat an id are cut too (unless their texts are equal). A drawn row is the first of its
    range; a copy of it (copy = 1) stands in the range before. A copy of the first row of all stands in the last range.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    apart = max(BUCKET_ROWS, -(-rows.count() // CUT_POINTS))
    placed = rows.withColumn("t1", F.xxhash64("text")).withColumn("key", F.struct("doc_id", "t1"))
    drawn = F.when(F.pmod(F.xxhash64(F.lit(53), "doc_id", "t1"), F.lit(apart)) == 0, F.col("key"))
    found = placed.agg(F.sort_array(F.collect_set(drawn)).alias("cuts"), F.max("key").alias("top"))
    found = found.withColumn("block", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("cuts"))).cast("int")))
    ends = F.filter("cuts", lambda _, i: (i + 1) % F.col("block") == 0)  # every block-th
    found = found.select(F.struct("cuts", "top", "block", ends.alias("ends")).alias("at"))
    # a constant, and not a column, which would be copied with every row
    at = F.from_json(F.lit(found.select(F.to_json("at")).first()[0]), found.schema["at"].dataType)
    # the cut points below a row are counted by two short searches
    placed = placed.withColumn("blocks", F.size(F.filter(at["ends"], lambda c: c < F.col("key"))) * at["block"])
    within = F.size(F.filter(F.slice(at["cuts"], F.col("blocks") + 1, at["block"]), lambda c: c < F.col("key")))
    placed = placed.withColumn("own", F.col("blocks") + within)
    place = lambda bucket, copy: F.struct(bucket.alias("bucket"), F.lit(copy).alias("copy"))
    first = F.get(at["cuts"], F.col("own")) == F.col("key")
    places = F.array(
        place(F.col("own"), 0), F.when(first, place(F.col("own") + 1, 1)), F.when(F.col("key") == at["top"], place(F.lit(0), 1))
    )
    return placed.select("doc_id", "text", "t1", F.inline(F.array_compact(places)))


def with_next(docs: DataFrame, **more: Column) -> DataFrame:
    """doc_id, text and next_text, the text of the following row in descending order of doc_id (nulls last, ties by the
    text's hash); after the last comes the first. ``more`` are expressions of the text, given with and as next_*.

    A neighbour is found inside a range (see :func:`in_ranges`), so texts are shuffled once and nothing is joined.
    """
    both = in_ranges(docs).withColumns(more)
    inside = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("t1"))
    follow = [F.lead(c).over(inside).alias(f"next_{c}") for c in ("text", *more)]
    return both.select("doc_id", "text", "copy", *more, *follow).where("copy = 0").drop("copy")


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, fingerprint of each row: the operator itself. A null text counts as an empty one."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", fingerprint(F.col("text"), _slots(lexicon(rows, band))).alias("fingerprint"))


def compare_edited(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The edited text has its last floor(n_chars / 2) code points replaced by as many, or all, from the start of the next
    row's text (see :func:`with_next`). The lexicon is that of the unedited texts. Null texts count as empty; an empty
    text has the fingerprint of no terms and equals other empty ones. Repeated rows each get their row; a lone row is
    its own neighbour; other columns are left out; an empty table gives no rows. Texts are taken whole.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    slots = _slots(lexicon(rows, band))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    full = with_next(rows, fingerprint=fingerprint(F.col("text"), slots))
    full = full.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    full = full.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_fingerprint", fingerprint(F.col("edited"), slots))
    return full.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _fingerprint_sql(words: str) -> str:
    def grain(zeros: int) -> str:
        mine = f"[t FOR t IN ks IF starts_with(md5(t), '{'0' * zeros}') AND substr(md5(t), {zeros + 1}, 1) = d]"
        return f"array_to_string([CASE WHEN len({mine}) = 0 THEN '-' ELSE substr(md5(array_to_string({mine}, ' ')), 1, 4) END FOR d IN string_split('{DIGITS}', '')], '.')"

    return f"CASE WHEN len(ks) = 0 THEN '=' || md5(array_to_string(list_sort({words}), ' ')) ELSE {" || '/' || ".join(map(grain, GRAINS))} END"


def _likeness_sql(a: str, b: str) -> str:
    def grain(k: int) -> str:
        x, y = f"string_split(string_split({a}, '/')[{k}], '.')", f"string_split(string_split({b}, '/')[{k}], '.')"
        used = f"len([c FOR c IN list_zip({x}, {y}) IF c[1] <> '-' OR c[2] <> '-'])"
        same = f"len([c FOR c IN list_zip({x}, {y}) IF c[1] = c[2] AND c[1] <> '-'])"
        return f"{{'e': {used} >= {IN_USE}, 's': {same} / greatest({used}, 1)}}"

    best = f"list_max([{', '.join(grain(k + 1) for k in range(len(GRAINS)))}])['s']"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a}[1] = '=' OR {b}[1] = '=' THEN 0.0 ELSE {best} END"


def compare_sql(band: tuple[float, float] = BAND) -> str:
    """:func:`compare_edited` as DuckDB SQL, for distinct ids that are not null."""
    words = r"list_distinct([w FOR w IN regexp_split_to_array(lower({0}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''])"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') tx FROM documents),
nx AS (SELECT *, coalesce(lead(tx) OVER (ORDER BY doc_id DESC), first_value(tx) OVER (ORDER BY doc_id DESC)) nt FROM d),
e AS (SELECT *, left(tx, CAST(length(tx) - length(tx) // 2 AS BIGINT)) || left(nt, CAST(length(tx) // 2 AS BIGINT)) ed FROM nx),
w AS (SELECT doc_id, ed, tx, {words.format('tx')} a, {words.format('ed')} b FROM e),
df AS (SELECT t, count(*) n FROM w, unnest(a) u(t) GROUP BY t),
lex AS (SELECT t FROM df, (SELECT count(*) c FROM d) WHERE n BETWEEN greatest(2, ceil({band[0]!r} * c)) AND floor({band[1]!r} * c)),
ka AS (SELECT doc_id, list(t ORDER BY t) ks FROM w, unnest(a) u(t) WHERE t IN (SELECT t FROM lex) GROUP BY doc_id),
kb AS (SELECT doc_id, list(t ORDER BY t) ks FROM w, unnest(b) u(t) WHERE t IN (SELECT t FROM lex) GROUP BY doc_id),
fa AS (SELECT doc_id, {_fingerprint_sql('a')} fa FROM (SELECT doc_id, a, coalesce(ks, []::VARCHAR[]) ks FROM w LEFT JOIN ka USING (doc_id))),
fb AS (SELECT doc_id, {_fingerprint_sql('b')} fb FROM (SELECT doc_id, b, coalesce(ks, []::VARCHAR[]) ks FROM w LEFT JOIN kb USING (doc_id))),
al AS (SELECT *, coalesce(lead(fa) OVER (ORDER BY doc_id DESC), first_value(fa) OVER (ORDER BY doc_id DESC)) fn FROM fa)
SELECT doc_id, CAST(length(tx) AS BIGINT) n_chars, sha256(ed) edited_sha256, fa fingerprint, fb edited_fingerprint,
  {_likeness_sql('fa', 'fb')} near_edited, {_likeness_sql('fa', 'fn')} near_next
FROM w JOIN al USING (doc_id) JOIN fb USING (doc_id)
"""
