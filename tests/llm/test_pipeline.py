import shutil

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hazardline.llm import mil

from .test_decontam import brute as leaks
from .test_lines_shards import linedup
from .test_models import quality_rows
from .test_neardup import brute as groups

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def folder(spark, tmp_path):
    made, labels = quality_rows(120)
    item = " ".join(f"item{k}" for k in range(14))
    block = "\n".join(f"shared line {k} of a page that many have" for k in range(5))
    rows = [(k, t + (" " + item if k % 17 == 0 else "") + ("\n" + block if k % 13 == 0 else ""), "en", "s", len(t)) for k, t, _, _ in made]
    rows += [(1000 + k, rows[k][1] + (" changed" if k % 2 else ""), "en", "s", 1) for k in range(0, 60, 3)]
    rows += [(2000, item, None, None, None), (2001, None, None, None, None), (2002, "", "en", "s", 0), (None, "null id text", None, None, None)]
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    yield str(tmp_path)
    shutil.rmtree(tmp_path, ignore_errors=True)


def test_stages_against_brute_force(spark, folder, against_sql):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        before, after = docs.collect(), out.collect()
        if name != "packing":
            assert out.dtypes == docs.dtypes
        if name == "quality":
            rated = mil.score(docs, mil.train(docs, spark.read.parquet(f"{folder}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)))
            good = {r["doc_id"] for r in rated.where("score >= 0.3").collect()}
            assert {r["doc_id"] for r in after} == good and len(after) < len(before)
        elif name == "lines":
            against_sql(out.select("doc_id", "text"), f"SELECT doc_id, text FROM ({linedup.REPORT_SQL})", documents=docs.select("doc_id", "text"))
        elif name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before]
            want = {c for i, n, c in groups(rows, 5) if n} | {i for i, n, _ in groups(rows, 5) if not n}
            assert {r["doc_id"] for r in after} == want and len(after) == len(want) < len(before)
        elif name == "decontamination":
            for r in before:
                n, hit, _ = leaks(r["text"], [(1, item)])
                new = [x for x in after if x["doc_id"] == r["doc_id"]]
                assert len(new) == (hit <= 0.5 * n)
                if new and not hit:
                    assert new[0]["text"] == r["text"]
                elif new:
                    assert leaks(new[0]["text"], [(1, item)])[1] == 0 and new[0]["n_chars"] == len(new[0]["text"])
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            want = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before}
            got = {}
            for r in after:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
            assert got == want
            whole = {r["doc_id"]: r["doc_tokens"] for r in corpus_pipeline.run(spark, folder).collect()}
            assert whole == want
        docs = spark.createDataFrame(after, out.schema) if name != "packing" else None


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
