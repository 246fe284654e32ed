import random

import pytest

from hazardline.llm import neardup
from hazardline.llm.common import cut
from hazardline.llm.components import components

DOC = "doc_id long, text string, lang string, component_id string"


def brute(rows, width=4, percent=80):
    sets = []
    for _, text, *_ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [(r[0], len(s), r[0] if not s else least.get(top(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def near_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 40, 150])) + (passage if group % 2 else [])
        for _ in range(rng.choice([1, 2, 5, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text), "x", "y"))
    rng.shuffle(rows)
    return [*rows, (1000, None, None, None), (1001, " \n", None, None), (None, rows[0][1].upper(), None, None), (None, None, None, None), (1002, "one", None, None), (1003, "ONE", None, None), rows[3], (None, "only null", None, None)]


@pytest.mark.parametrize(("seed", "node", "levels", "block"), [(1, 64, 3, 10**6), (2, 2, 2, 300), (3, 1, 1, 90)])
def test_groups_against_brute_force(spark, monkeypatch, seed, node, levels, block):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block)
    rows = near_rows(seed)
    got = [tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, DOC), 4, 80, node=node, levels=levels).collect()]
    assert sorted(map(str, got)) == sorted(str((*w, w[0] == w[2])) for w in brute(rows))


def test_one_of_each_group_stays(spark):
    rows = near_rows(5)
    out = neardup.keep_one(spark.createDataFrame(rows, DOC), width=4)
    assert out.columns == ["doc_id", "text", "lang", "component_id"]
    got = sorted(str(r["doc_id"]) for r in out.collect())
    groups = brute(rows)
    want = [str(i) for i, n, _ in groups if n == 0] + [str(c) for c in {c for _, n, c in groups if n} if c is not None] + ["None"]
    assert got == sorted(want)  # the last: the one group that has no id


def test_chain_of_links(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {tuple(r) for r in components(links).collect()}
    assert got == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOC)
    assert neardup.near_duplicates(docs).count() == 0 and neardup.keep_one(docs).count() == 0


def test_rows_are_dealt_out_once(spark, monkeypatch, capsys):
    """Rows of nodes move for their nodes' sizes and for the join with them only; full sets go by their class and are not written."""
    seen = {}

    def spied(df, name):
        df.explain()
        seen.setdefault(name, []).append(capsys.readouterr().out.count("Exchange hashpartitioning("))
        return cut(df, name)

    monkeypatch.setattr(neardup, "cut", spied)
    rows = [(1, "a b c d e f", None, None), (2, "a b c d e f g", None, None), (3, "x y z", None, None)]
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, DOC), 4, 70, levels=1).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert sorted(got) == [(1, 3, 1, True), (2, 4, 1, False), (3, 1, 3, True)]
    assert seen["shared"] == [2] and "sets" not in seen


def test_repeated_rows_give_one_set(spark):
    rows = [(1, "a b c d e f", None, None)] * 3 + [(2, "a b c d e g", None, None)] * 2
    join = neardup._Join(spark.createDataFrame(rows, DOC), 4, 80, 4, 64, 3)
    assert join.classes.count() == 2 and join.sets(join.classes.select("ckey")).count() == 2


def test_nodes_of_a_class_are_listed_once(spark):
    text = " ".join(f"w{k}" for k in range(300))
    docs = spark.createDataFrame([(1, text, None, None)], DOC)
    (row,) = neardup._signatures(docs, 4, 80, 64).select("nodes").collect()
    assert len(row["nodes"]) > 16 and len(set(row["nodes"])) == len(row["nodes"])
