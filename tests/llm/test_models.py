import random
import uuid
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from hazardline.llm import common, langid, mil

DOC = "doc_id long, text string, lang string, score string"
SOUNDS = {"en": "th er on an re he in ed nd ha".split(), "de": "ch sch ei ung en zu ver äu ß ge".split(), "fr": "eau é qu oi è ment aux ou le ç".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randrange(1, 5))) for _ in range(n)).capitalize() + "."


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        lang = rng.choice(list(SOUNDS))
        rows.append((k, text_of(rng, lang, rng.choice([6, 40, 300])), None if k % 11 == 0 else lang, lang))
    return rows


def test_languages_held_out(spark):
    rows = corpus()
    odd = [(900, None, "de", None), (901, "", "fr", None), (902, "12 !! 3", "en", None), (None, rows[0][1], "en", None), (1, rows[1][1], None, None), (903, "x" * 3_000_000, None, None), (904, "12 ½", "de", None), (905, "² Ⅷ ①", "fr", None)]
    out = langid.identify_held_out(spark.createDataFrame([*rows, *odd], DOC)).collect()
    assert len(out) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in out}
    for i in (900, 901, 902, 904, 905):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["accepted"]) == ("und", 0.0, False)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {r[0] for r in held} == {r["doc_id"] for r in out if r["held_out"]} - {900, 901, 902, 903, 904, 905}
    assert sum(by_id[r[0]]["lang_pred"] == r[3] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_chunk_edges_lose_no_gram(monkeypatch):
    text = text_of(random.Random(2), "fr", 60)
    whole = sorted(np.concatenate(list(langid.buckets(text))).tolist())
    for size in (1, 2, 3, 5, 64):
        monkeypatch.setattr(langid, "CHUNK", size)
        assert sorted(np.concatenate(list(langid.buckets(text))).tolist()) == whole


def test_languages_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(k, "some text", None, None) for k in range(9)], DOC)
    assert {r["lang_pred"] for r in langid.identify_held_out(docs).collect()} == {"und"}
    assert langid.identify_held_out(docs.limit(0)).count() == 0


def quality_rows(n=300):
    rng = random.Random(8)
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        text = text_of(rng, "en", rng.choice([30, 200, 900]))
        if not good:
            spam = " ".join("BUY!! NOW!! " for _ in range(60))
            text = text[: len(text) // 2] + spam + text[len(text) // 2 :]
        docs.append((k, text, "en", None))
        labels.append((k, int(good), 0))
    return docs, labels


def test_quality_held_out(spark):
    docs, labels = quality_rows()
    odd = [(900, None, None, "s"), (901, "", None, None), (None, docs[0][1], None, None), (2, docs[2][1], None, None)]
    table = spark.createDataFrame([*docs, *odd], DOC)
    marks = spark.createDataFrame([*labels, (900, None, None), (None, 1, 0), (5000, 0, 0), (3, labels[3][1], 1)], "doc_id long, quality int, toxic int")
    out = mil.score_held_out(table, marks).collect()
    assert len(out) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    truth = {k: q for k, q, _ in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    kept = mil.keep_good(table, marks)
    assert kept.columns == table.columns
    assert kept.count() == sum(r["predicted"] for r in out)


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", None, None)], DOC)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mil.score_held_out(docs, none).first()["score"] == 0.5
    assert mil.score_held_out(docs.limit(0), none).count() == 0
    assert mil.keep_good(docs.where(F.lit(False)), none).count() == 0


def test_quality_stage_sends_texts_once_in_small_batches(spark, tmp_path, monkeypatch):
    def noted(df, work, schema):
        def measured(batches):
            for batch in batches:
                (tmp_path / f"{batch.nbytes}-{uuid.uuid4().hex}").touch()
                yield from work(iter([batch]))

        return df.mapInArrow(measured, schema)

    monkeypatch.setattr(mil, "map_arrow", noted)
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.range(0, 4_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some text "), 400).alias("text"), F.lit("en").alias("lang"))
    out = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert (out.dtypes, out.count()) == (docs.dtypes, 4_000)
    sizes = [int(p.name.split("-")[0]) for p in tmp_path.glob("*-*")]
    assert 16_000_000 < sum(sizes) < 17_000_000 and max(sizes) < 1.5 * common.BATCH_BYTES


def test_quality_keeps_texts_of_other_types(spark):
    docs = spark.createDataFrame([(1, 12), (2, None)], "doc_id long, text int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = mil.keep_good(docs, none)
    assert kept.dtypes == docs.dtypes and sorted(kept.collect()) == [(1, 12), (2, None)]


def test_worker_holds_one_large_thing():
    common.let_go()
    made = []
    make = lambda name: common.held(name, lambda: made.append((name, list(common._HELD))) or name)
    assert [make("a"), make("a"), make("b"), make("a")] == ["a", "a", "b", "a"]
    assert made == [("a", []), ("b", []), ("a", [])] and list(common._HELD) == ["a"]
    common.let_go()
    assert not common._HELD
