import hashlib
import random
import zlib

from hazardline.llm import runs


def brute_runs(words, least=12):
    """All maximal stretches of each period, kept where the period is the smallest of the stretch."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words, word = [], []
    for ch in text or "":
        if ch in "\x20\x09\x0a\x0b\x0c\x0d":
            if word:
                words.append("".join(word))
            word = []
        else:
            word.append(ch)
    words += ["".join(word)] if word else []
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *top, top[1] * 1000 // top[2] if found else None, sha(listed), sha(kept))


def test_runs_equal_brute_force():
    rng = random.Random(4)
    for _ in range(1500):
        words = rng.choices("abc"[: rng.randrange(1, 4)], k=rng.randrange(0, 70))
        if rng.random() < 0.5:  # nested repeats
            block = rng.choices("ab", k=rng.randrange(1, 6)) * rng.randrange(1, 5)
            words = words[:10] + (block + rng.choices("abc", k=rng.randrange(3))) * rng.randrange(1, 5) + words[10:20]
        assert runs.runs_of([w.encode() for w in words]) == brute_runs(words)
        for least in (2, 5):
            assert runs.find_runs(words, least) == brute_runs(words, least)


def test_stretches_hold_every_run():
    rng = random.Random(8)
    for _ in range(300):
        words = [str(x) for x in rng.choices(range(40), k=80)]
        at, q = rng.randrange(50), rng.randrange(1, 12)
        words[at : at + 30] = (words[at : at + q] * 30)[:30]
        spans = runs.repeated_stretches(words)
        assert all(any(a <= s and s + n <= b for a, b in spans) for s, n, _ in brute_runs(words))


def test_query_equals_brute_force(spark):
    rng = random.Random(6)
    odd = [None, "", " \t ", "one", "a " * 11, "a " * 12, "a\x0bb\x1cc d e", "é ü " * 9, "x y z " * 400, "long words " + "q" * 100_000]
    made = [" ".join(rng.choices(["aa", "b", "c\n", "dé"], k=rng.randrange(1, 150))) for _ in range(250)]
    rows = [(k, t, 1, "n") for k, t in enumerate([*odd, *made])] + [(None, "a b " * 20, 2, "n"), (7, "b " * 30, 3, "n"), (7, "b " * 30, 3, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, key_ string").repartition(3)
    got = runs.report(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_row(i, t) for i, t, *_ in rows), key=str)


def test_real_outputs(spark):
    docs = spark.createDataFrame([(1, "w a b a b a b a b a b a b a z")], "doc_id long, text string")
    [row] = runs.detect(docs).collect()
    assert row["n_words"] == 15 and [tuple(r) for r in row["runs"]] == [(1, 13, 2)] and row["collapsed"] == "w a b z"


def test_empty_table(spark):
    assert runs.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_text(spark):
    text = " ".join(f"w{i % 997}" for i in range(60_000)) + " " + "again " * 40_000
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    [row] = runs.detect(docs).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 997), (60_000, 40_000, 1)]
