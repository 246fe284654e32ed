import random

from hazardline.llm import decontam

DOC = "doc_id long, text string, lang string, n_hit string, n_chars long"


def brute(text, items, window=10):
    w = decontam.words(text.encode() if text is not None else None)
    hit, seen = set(), set()
    for name, item in items:
        v = decontam.words(item.encode() if item is not None else None)
        k = min(window, len(v))
        if not k:
            continue
        wins = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                seen.add(str(name))
    return len(w), len(hit), len(seen)


def test_random_against_brute_force(spark):
    rng = random.Random(3)
    letters = ["a", "b", "c", "Ä", "7"]
    items = [(k, " ".join(rng.choices(letters, k=rng.choice([1, 3, 4, 6, 12, 30])))) for k in range(12)] + [(90, None), (91, ""), (92, "..")]
    docs = [(k, " ".join(rng.choices([*letters, "X"], k=rng.choice([0, 2, 40, 200]))), None, "x", 1) for k in range(40)]
    docs += [(None, items[5][1].upper() + "!", None, None, None), (7, None, None, None, None), (0, docs[0][1], None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, DOC)
    for window, block in ((5, 10_000), (5, 12), (3, 9)):
        got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.report(df, bench, window, block).collect())
        want = sorted((str(d[0]), *(b := brute(d[1], items, window)), b[1] > 0) for d in docs)
        assert got == want, (window, block)


def test_spans_leave_and_clean_texts_stay(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [
        (1, "Before, " + item.title() + "! after. " + "pad " * 40, "en", "e", 9),
        (2, "clean é text\n\n  kept", "en", "e", 5),
        (3, item, "en", "e", 4),
        (None, None, None, None, None),
        (4, "", "en", "e", 0),
    ]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontam.remove_matches(spark.createDataFrame(rows, DOC), bench).collect()}
    assert set(out) == {1, 2, None, 4}
    assert out[1]["text"] == "Before, ! after. " + "pad " * 40 and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == rows[1][1] and out[2]["n_chars"] == 5 and out[2]["n_hit"] == "e"
    assert out[None]["text"] is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOC)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b", None, None, None)], DOC)
    assert [tuple(r)[:4] for r in decontam.report(one, bench).collect()] == [(1, 2, 0, 0)]
    assert decontam.remove_matches(one, bench).count() == 1


def test_one_worker_per_task_whatever_the_blocks(spark):
    bench = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(20)], "item_id long, text string")
    assert len(decontam.write_automata(bench, 10, 50)) > 5
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(25)), None, None, None) for k in range(20)], DOC)
    out = decontam.report(docs, bench, 10, 50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {(r["n_words"], r["n_hit"], r["n_items"]) for r in out.collect()} == {(25, 25, 1)}


def test_groups_of_batches_and_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(decontam, "GROUP_BYTES", 1)
    item = " ".join(f"k{j}" for j in range(12))
    long = "pad word " * 200_000 + item + " tail" * 100_000
    rows = [(1, long, None, None, None), (1, long, None, None, None), (2, "pad", None, None, None)]
    bench = spark.createDataFrame([(1, item), (None, "other words here"), (None, "tail tail tail tail")], "item_id long, text string")
    for block in (200_000, 3):
        got = sorted(tuple(r)[:4] for r in decontam.report(spark.createDataFrame(rows, DOC), bench, 10, block).collect())
        assert got == [(1, 500_012, 100_012, 2), (1, 500_012, 100_012, 2), (2, 1, 0, 0)]


def test_registered_query_against_sql(spark, against_sql):
    folder = "/root/testdata/sf0.001"
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark")}
    against_sql(decontam.report(tables["documents"], tables["benchmark"]), decontam.REPORT_SQL, **tables)
    against_sql(decontam.report(tables["documents"], tables["benchmark"], block_words=500), decontam.REPORT_SQL, **tables)
