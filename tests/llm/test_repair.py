import hashlib
import random
import zlib
from functools import cache

import pytest

from hazardline.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, place string, edit int"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit at every row; rows are (role, text, fault)."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    write = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, room):  # room: insertions left before the next row
        found = []
        if room:
            cost, audit, lines = best(i, write[state], room - 1)
            found.append((cost + 5, "I" + audit, (f"{name[write[state]]}:", *lines)))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            ways = [("D", 2, state, None)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role[:1]) in follow:
                    ways.append(("K", more, follow[state, role[:1]], f"{role}:{text}"))
                ways.append(("R", 1 + more, write[state], f"{name[write[state]]}:{text}"))
            for edit, price, to, line in ways:
                cost, audit, lines = best(i + 1, to, 4)
                found.append((cost + price, edit + audit, lines if line is None else (line, *lines)))
        return min(found) if found else (1 << 40, "", ())

    return best(0, "", 4)


def brute(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text, *_ in table:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(key.encode()) % 20
            if h == 1:
                text = ""
            elif h == 2:
                text = "".join(x for x in text if x not in ".!?")
            elif h == 4:
                role = "user"
            rows += [(turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in rows:
            solid = text.strip(SPACE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, *_ in rows if t is not None}
        cost, audit, lines = cheapest(marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        count = lambda f: sum(m[2] == f for m in marked)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def made(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "open", "", " \t", "é?", "Same.", "tail. \n", "x" * 50 + ".", None, "a ", "😀"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for c in [*range(conversations), None]:
        for t in range(rng.randrange(0, longest)):
            turn = rng.choice([t, t, t, t // 2, None, t + 3])
            rows.append((c, turn, rng.choice(roles), rng.choice(texts), "z", 1))
    return rows + [(1000, None, "user", "only null turn.", "", 2), (1001, 5, "user", "long " * 100_000 + ".", "", 2)]


def check(spark, rows):
    got = repair.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_query_equals_trying_everything(spark):
    check(spark, made(1))


@pytest.mark.parametrize("chunk", [1, 3])
def test_chunks_converge_to_the_same(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    check(spark, made(2, 12, 40))


def test_pathological_conversations(spark, monkeypatch):
    """Rows that keep no rank down (all blank, all truncated) pass vectors on through many chunks."""
    monkeypatch.setattr(repair, "CHUNK", 2)
    rows = [(1, t, "user", " ", "", 0) for t in range(60)] + [(1, 99, "assistant", "Hm.", "", 0)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"cut {t}", "", 0) for t in range(50)]
    rows += [(3, t, "assistant", f"{t}.", "", 0) for t in range(30)] + [(4, 7, "user", "Same.", "", 0)] * 40
    check(spark, rows)


def test_a_large_conversation_is_cut_by_size(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 5)
    measured = repair.measure_keys
    monkeypatch.setattr(repair, "measure_keys", lambda df, keys: measured(df, keys, 20))
    check(spark, made(3, 3, 200))


def test_fix_up_stops_where_vectors_meet():
    rng = random.Random(1)
    for _ in range(200):
        codes = "".join(rng.choices("suaoSUAOD", k=30))
        end = repair.run_back("".join(rng.choices("suaD", k=5)), repair.END)[0]
        start = repair.run_back(codes, repair.END)[0]
        assert repair.fix_up(codes, repair.END, end, start) == repair.run_back(codes, end)[0]


def test_real_outputs(spark):
    rows = [(9, 0, "assistant", "Hi."), (9, 1, "assistant", "Well."), (9, 2, "assistant", "Well.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r["edit"], r["new_role"], r["fault"]) for r in repair.repair(repair.as_rows(df)).orderBy("place").collect()]
    assert got == [("R", "user", None), ("K", "assistant", None), ("D", None, "duplicate")]


def test_empty_table(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_equals_trying_everything():
    import duckdb
    import pyarrow as pa

    rows = [r for r in made(5, 80, 12) if r[2] != ""]
    con = duckdb.connect()
    con.register("conversations", pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}))
    cur = con.execute(repair.report_sql())
    names = [c[0] for c in cur.description]
    assert names == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(cur.fetchall(), key=str) == sorted(brute(rows), key=str)
