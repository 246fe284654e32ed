import random

import pytest

from hazardline.llm import linedup, shard
from hazardline.llm.queries import SHARD_BYTES, op7_shards

DOC = "doc_id long, text string, lang string, covered_ string, n_chars int"


def random_docs(seed, n=60):
    rng = random.Random(seed)
    lines = ["", " a", "b", "b ", "c", "d\r", "long " * 30]
    rows = [(k, "\n".join(rng.choices(lines, k=rng.randrange(0, 12))), "en", "x", 1) for k in range(n)]
    return [*rows, (900, None, None, None, None), (901, "", None, None, 0), (902, "\n\n\n\n", None, "y", 4), (903, "q\n" * 4000, None, None, None)]


def test_lines_against_sql(spark, against_sql):
    docs = spark.createDataFrame(random_docs(1), DOC)
    against_sql(linedup.dedup_report(docs), linedup.REPORT_SQL, documents=docs)


def test_lines_planted_repeated_and_null_ids(spark):
    block = "first line\nsecond line\nthird line\nfourth"
    rows = [
        (1, "x\n" + block + "\ny", "en", "keep", 1),
        (2, "p\n" + block + "\nq", "en", None, 1),
        (2, "p\n" + block + "\nq", "de", None, 1),
        (None, block, None, None, None),
        (3, "first line\nsecond line", "en", None, 7),
    ]
    out = linedup.dedup_lines(spark.createDataFrame(rows, DOC))
    assert out.columns == ["doc_id", "text", "lang", "covered_", "n_chars"]
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, "x\ny", 3), (2, "p\nq", 3), (2, "p\nq", 3), (None, block, None), (3, "first line\nsecond line", 7)], key=str)


def test_lines_of_a_very_long_text(spark):
    n = 400_000
    block = "one\ntwo\nthree"
    rows = [(1, block + "\n" + "q\n" * n + block + "\nend", "en", None, None)]
    (row,) = linedup.dedup_report(spark.createDataFrame(rows, DOC)).collect()
    # the first window of equal lines stays, later ones cover all but its first line; so do those of the second block
    assert row["text"] == block + "\nq\nend" and (row["n_lines"], row["n_removed"]) == (n + 7, n + 2)


@pytest.mark.parametrize("limit", [1, 50, 400, 10**9])
def test_shards_against_sql(spark, against_sql, limit):
    docs = spark.createDataFrame(random_docs(2), DOC)
    again = docs.union(docs.where("doc_id < 4")).union(spark.createDataFrame([(None, "null id", None, None, None)], DOC))
    frame = shard.assign(again, limit).cache()
    assert frame.where(f"shard_bytes > {limit} and not oversize").isEmpty()
    against_sql(frame.distinct(), shard.assign_sql(limit, 60), documents=again.select("doc_id", "text"))
    assert frame.count() == again.count()


def test_registered_shards_split(spark, against_sql):
    folder = "/root/testdata/sf0.01"
    got = op7_shards(spark, folder).cache()
    against_sql(got, shard.assign_sql(SHARD_BYTES), documents=spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    assert got.select("shard").distinct().count() > 2 and got.where(f"shard_bytes > {SHARD_BYTES}").isEmpty()


def test_shards_of_one_text_over_the_limit(spark):
    rows = [(1, "x" * 3_000_000, None, None, None), (2, "y" * 900, None, None, None), (3, "z" * 900, None, None, None)]
    got = {r["doc_id"]: r for r in shard.assign(spark.createDataFrame(rows, DOC), 2_000).collect()}
    assert got[1]["oversize"] and got[1]["shard_bytes"] == 3_000_000 and got[2]["shard_bytes"] <= 1_800 and not got[2]["oversize"]


def test_shards_open_more_bits(spark, monkeypatch):
    monkeypatch.setattr(shard, "AHEAD", 1)
    docs = spark.createDataFrame(random_docs(4), DOC)
    few = {tuple(r) for r in shard.assign(docs, 60).collect()}
    monkeypatch.setattr(shard, "AHEAD", 30)
    assert few == {tuple(r) for r in shard.assign(docs, 60).collect()}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOC)
    assert shard.assign(docs).count() == 0 and linedup.dedup_report(docs).count() == 0 and linedup.dedup_lines(docs).count() == 0
