import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hazardline.llm import bpe, pack

FILE = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, n_tokens string"
ODD = ["", None, " ", "  ", "a  b", "a   b", " a", "x \n y", "x\n \ny", "don't we'll", "<|endoftext|>a<|endoftext|>", "naïve ½ ²x", "日本語 　 テスト", "a\x1cb \x85", "\t\t a \r\n", "é" * 500, "tail   ", "a \n", "😀 👩‍👩‍👧", "ab" * 3000, " <|endoftext|> x"]


def odd_rows():
    rng = random.Random(5)
    alphabet = [" ", " ", "\n", "a", "the", "é", "1", "!", "'s", " ", "_", "x", "½"]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(300)]
    return [(k, t, "x") for k, t in enumerate([*ODD, *made])] + [(None, "null id", None), (5, "a   b", None)]


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(FILE)
    rows = odd_rows()
    got = bpe.token_counts(spark.createDataFrame(rows, DOC), FILE, limit=3).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 3) for i, t, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_remembering_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    library = Tokenizer.from_file(FILE)
    with open(FILE, encoding="utf-8") as f:
        counter = bpe.TokenCounter(f.read())
    for _, text, _ in odd_rows():
        assert counter.count(text) == len(library.encode(text or "", add_special_tokens=False).ids)
    assert len(counter.chunks) <= 3 and len(counter.chunks.words) <= 3


def encoder():
    with open(FILE, encoding="utf-8") as f:
        return pack.Encoder(f.read())


def test_identifiers_of_every_settled_character_equal_the_library():
    own, library = encoder(), Tokenizer.from_file(FILE)
    points = [*range(0xD800), *range(0xE000, 0x10000), *(c for a, b in pack.SIGN_BLOCKS for c in range(a, b + 1))]
    texts = [f"a{c}1{c}{c} {c}" for c in map(chr, points) if not pack.unsettled().search(c)]
    assert len(texts) > 50_000 and all(map(own._ranked_too, texts))
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(texts)] == [w.ids for w in want]


def test_identifiers_of_odd_and_long_texts_equal_the_library():
    own, library = encoder(), Tokenizer.from_file(FILE)
    runs = ["a" * 3000, "x " + "1" * 500, "_-" * 400, " " * 700 + "b", "w\n" * 600, "a  b" * 300, "\U00010400 \U0001e900", "z" * 255]
    texts = [*(t or "" for _, t, _ in odd_rows()), *runs]
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [own._ranked_too(t) for t in runs] == [False, False, False, False, True, True, False, True]


def test_other_vocabularies_are_left_to_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = pack.Encoder(f.read())
    assert words.ranked is None
    assert np.frombuffer(words.encode("Two words"), "<u4").tolist() == words.library.encode("Two words", add_special_tokens=False).ids


def test_pieces_round_trip(spark):
    library = Tokenizer.from_file(FILE)
    rows = [(k, t, "x") for k, (_, t, _) in enumerate(odd_rows())] + [(5000, "long text " * 9000, None), (5001, "z " * 700, None)]
    pieces = pack.pack(spark.createDataFrame(rows, DOC).repartition(3), FILE, step_tokens=2048).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            piece = np.array(ids[i][at : at + p["length"]], "<u4").tobytes()
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(piece) and p["doc_tokens"] == len(ids[i])
            at += p["length"]
        assert at == len(ids[i])
    tokens = defaultdict(int)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded
        assert len({p["step_group"] for p in own}) == 1 and len({p["tier"] for p in own}) == 1
        tokens[own[0]["step_group"]] += own[0]["tier"]
    assert max(tokens.values()) <= 2048


def test_repeated_rows_and_empty_tables(spark):
    same = spark.createDataFrame([(1, "a b c", None)] * 3 + [(None, None, None)], DOC)
    got = pack.pack(same, FILE).collect()
    assert sum(p["length"] for p in got) == 4 * 3 + 1
    empty = spark.createDataFrame([], DOC)
    assert pack.pack(empty, FILE).count() == 0 and bpe.token_counts(empty, FILE).count() == 0
