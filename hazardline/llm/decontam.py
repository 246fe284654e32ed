"""Benchmark decontamination by a generalised suffix automaton over the words of test items.

The automaton holds every run of words of every item. Documents are streamed through it word by word; it keeps the
length of the longest run ending at the current word, so each occurrence of a window is seen as its last word is read.
No document is shuffled. Automata are built by tasks, kept in the shared folder, and read by the workers that match.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import WORD_BYTES, cut, held, map_arrow, texts
from hazardline.session import shared_folder

#: Words of test items in one automaton. More items make more automata, each of which all documents pass in turn.
BLOCK_WORDS = 200_000
#: Bytes of documents that pass one automaton before the next is read, where there are several.
GROUP_BYTES = 32 << 20
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, split at ASCII other than letters and digits."""
    return text.translate(WORD_BYTES).split() if text else []


class Automaton:
    """Generalised suffix automaton of word lists.

    An item of at least ``window`` words is matched by any ``window`` consecutive words of it, a shorter one as a whole.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        go: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        lists = []
        for name, item in items:
            lists.append((name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item]))

        def clone(state: int, target: int, word: int) -> int:
            made = len(go)
            go.append(dict(go[target]))
            link.append(link[target])
            length.append(length[state] + 1)
            link[target] = made
            while state >= 0 and go[state].get(word) == target:
                go[state][word] = made
                state = link[state]
            return made

        def extend(last: int, word: int) -> int:
            target = go[last].get(word)
            if target is not None:
                return target if length[target] == length[last] + 1 else clone(last, target, word)
            made = len(go)
            go.append({})
            link.append(0)
            length.append(length[last] + 1)
            state = last
            while state >= 0 and word not in go[state]:
                go[state][word] = made
                state = link[state]
            if state >= 0:
                target = go[state][word]
                link[made] = target if length[target] == length[state] + 1 else clone(state, target, word)
            return made

        for _, item in lists:
            state = 0
            for word in item:
                state = extend(state, word)
        self.size = max(1, len(self.vocabulary))
        self.link, self.length = link, length
        self.go = {state * self.size + word: to for state, edges in enumerate(go) for word, to in edges.items()}
        self.least = min([window, *(len(item) for _, item in lists)])
        owners: list[set[str]] = [set() for _ in go]
        whole: dict[int, list[tuple[int, str]]] = {}
        for name, item in lists:
            state = 0
            for word in item:
                state = self.go[state * self.size + word]
                above = state
                while len(item) >= window and above > 0 and length[above] >= window and name not in owners[above]:
                    owners[above].add(name)
                    above = link[above]
            if len(item) < window:
                whole.setdefault(state, []).append((len(item), name))
        order = sorted(range(len(go)), key=length.__getitem__)
        self.full = [0] * len(go)  # the state of the last `window` words, for a state that holds as many
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(go)
        for state in order[1:]:
            up = link[state]
            if length[state] >= window:
                self.full[state] = state if length[up] < window else self.full[up]
            self.short[state] = self.short[up] + tuple(whole.get(state, ()))
        self.owners = [frozenset(x) if self.full[k] == k and k else frozenset() for k, x in enumerate(owners)]
        self.runs = re.compile(b"\x01{%d,}" % max(1, self.least))

    def match(self, found: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged word ranges [from, to) inside occurrences, and the items that occur."""
        spans: list[list[int]] = []
        seen: set[str] = set()
        has = bytes(map(self.vocabulary.__contains__, found))
        go, link, length, size, window = self.go, self.link, self.length, self.size, self.window

        def mark(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, end])

        for run in self.runs.finditer(has):
            state = reach = 0
            for at in range(run.start(), run.end()):
                word = self.vocabulary[found[at]]
                to = go.get(state * size + word)
                while to is None and state:
                    state = link[state]
                    reach = length[state]
                    to = go.get(state * size + word)
                if to is None:
                    reach = 0
                    continue
                state, reach = to, reach + 1
                if reach >= window:
                    mark(at - window + 1, at + 1)
                    seen |= self.owners[self.full[state]]
                for own, name in self.short[state]:
                    if own <= reach:
                        mark(at - own + 1, at + 1)
                        seen.add(name)
        return spans, seen


def _pieces(batches: Iterator[pa.RecordBatch], window: int, block_words: int) -> Iterator[pa.RecordBatch]:
    step = max(block_words, window)
    for batch in batches:
        items, numbers, parts, counts = [], [], [], []
        for item, text in zip(batch.column("item").to_pylist(), texts(batch), strict=True):
            found = words(text)
            for start in range(0, max(1, len(found) - window + 1), step) if found else ():
                piece = found[start : start + step + window - 1]
                items.append(item)
                numbers.append(start // step)
                parts.append(b" ".join(piece))
                counts.append(len(piece))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.string()), pa.array(numbers, pa.int64()), pa.array(parts, pa.binary()), pa.array(counts, pa.int64())],
            ["item", "number", "piece", "n_words"],
        )


def write_automata(benchmark: DataFrame, window: int, block_words: int) -> list[str]:
    """Files of automata in the shared folder, each of about ``block_words`` words of items, built by Spark's tasks.

    A longer item goes in pieces that share ``window`` - 1 words, so that each of its windows is in one piece. Pieces are
    dealt to blocks by hash; a repeated attempt writes its block's file anew under its own name. The driver sees names.
    """
    folder = shared_folder(benchmark.sparkSession, "automata")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    pieces = cut(map_arrow(items, lambda batches: _pieces(batches, window, block_words), "item string, number long, piece binary, n_words long"), "pieces")
    total = pieces.agg(F.sum("n_words")).first()[0]
    if not total:
        return []
    block = F.pmod(F.xxhash64("item", "number"), F.lit(-(-total // block_words))).alias("block")

    def build(group: pa.Table) -> pa.Table:
        rows = zip(group.column("item").to_pylist(), group.column("piece").to_pylist(), strict=True)
        automaton = Automaton([(item, piece.split()) for item, piece in sorted(set(rows))], window)
        path = f"{folder}/{group.column('block')[0].as_py()}-{uuid.uuid4().hex}"
        fs, name = FileSystem.from_uri(path)
        fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(name, compression=None) as out:
            out.write(pickle.dumps(automaton, pickle.HIGHEST_PROTOCOL))
        return pa.table({"path": [path]})

    return sorted(r["path"] for r in pieces.select("item", "piece", block).groupBy("block").applyInArrow(build, "path string").collect())


def _load(path: str) -> Automaton:
    fs, name = FileSystem.from_uri(path)
    with fs.open_input_stream(name, compression=None) as source:
        return pickle.loads(source.read())


def _merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


Batches = Iterator[pa.RecordBatch]


def _groups(batches: Batches, limit: int) -> Iterator[list[pa.RecordBatch]]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= limit:
            yield held
            held = []
    if held:
        yield held


def match_items(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS,
    then: Callable[[Batches], Batches] | None = None, then_schema: str = "",
) -> DataFrame:
    """One row per document row: doc_id, text, items (sorted item ids as text), spans (merged word ranges inside
    occurrences).

    A null or empty text has no words and no hits; an item without words matches nothing; a null item_id counts as the
    empty id; items with the same id are one. Repeated document rows each get their row. A very long text is streamed
    whole, in time linear in its words but for the hits it holds. Other columns are left out. One Python worker per task
    passes its rows through all automata in turn, of which it holds one; with several, rows wait in groups of
    ``GROUP_BYTES``, so that an automaton is read once a group. ``then`` is applied to the rows by the same workers, and
    gives ``then_schema``.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    paths = write_automata(benchmark, window, block_words)
    limit = GROUP_BYTES if len(paths) > 1 else 0

    def match(batches: Batches) -> Batches:
        for group in _groups(batches, limit):
            spans: list[list[list[list[int]]]] = [[[] for _ in range(b.num_rows)] for b in group]
            items: list[list[set[str]]] = [[set() for _ in range(b.num_rows)] for b in group]
            for path in paths:
                automaton = held(path, partial(_load, path))
                for at, batch in enumerate(group):
                    for k, text in enumerate(batch.column("text").cast(pa.binary())):
                        ranges, seen = automaton.match(words(text.as_py()))
                        if seen:
                            items[at][k] |= seen
                            spans[at][k] = _merge(spans[at][k] + ranges)
            for at, batch in enumerate(group):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(map(sorted, items[at]), pa.list_(pa.string())), pa.array(spans[at], pa.list_(pa.list_(pa.int32())))],
                    ["doc_id", "text", "items", "spans"],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if then is None:
        return map_arrow(rows, match, f"doc_id {id_type}, text string, items array<string>, spans array<array<int>>")
    return map_arrow(rows, lambda batches: then(match(batches)), then_schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document row (see :func:`match_items`)."""
    id_type = dict(docs.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([len(words(t)) for t in texts(batch)], pa.int64())
            hit = [sum(b - a for a, b in s) for s in batch.column("spans").to_pylist()]
            items = batch.column("items").to_pylist()
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n, pa.array(hit, pa.int64()), pa.array(map(len, items), pa.int64()), pa.array(digest), pa.array([x > 0 for x in hit])],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return match_items(docs, benchmark, window, block_words, count, f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without the text of benchmark occurrences.

    Each merged span of hit words leaves the text. A document of which more than ``max_coverage`` of the words are hit
    goes altogether. Documents without a hit pass unchanged, null texts included; all columns are kept (an extra column
    of any name too), and n_chars, where there is one, follows the text.
    """
    columns = docs.columns
    keep = [c for c in columns if c not in ("doc_id", "text")]
    tucked = docs.select("text", F.struct("doc_id", *keep).alias("doc_id"))
    id_type = tucked.schema["doc_id"].dataType.simpleString()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, kept = [], []
            found = batch.column("spans").to_pylist()
            plain = batch.column("text")
            for k, spans in enumerate(found):
                if not spans:
                    out.append(plain[k].as_py())
                    kept.append(True)
                    continue
                text = plain[k].as_py().encode()
                at = [m.span() for m in _WORD.finditer(text.translate(WORD_BYTES))]
                kept.append(sum(b - a for a, b in spans) <= max_coverage * len(at))
                parts, last = [], 0
                for a, b in spans:
                    parts.append(text[last : at[a][0]])
                    last = at[b - 1][1]
                out.append(b"".join([*parts, text[last:]]).decode())
            edited = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string()), pa.array([bool(s) for s in found])], ["doc_id", "text", "edited"]
            )
            yield edited.filter(pa.array(kept, pa.bool_()))

    cleaned = match_items(tucked, benchmark, window, block_words, clean, f"doc_id {id_type}, text string, edited boolean")
    old = {c: F.col("doc_id").getField(c) for c in ["doc_id", *keep]}
    if "n_chars" in old:
        kind = dict(docs.dtypes)["n_chars"]
        old["n_chars"] = F.when(F.col("edited"), F.length("text").cast(kind)).otherwise(old["n_chars"])
    return cleaned.select(*(F.col("text") if c == "text" else old[c].alias(c) for c in columns))


#: The report as DuckDB SQL, for windows of ten words.
REPORT_SQL = r"""
WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
wins AS (SELECT DISTINCT item, least(10, len(w)) k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') g FROM items, unnest(range(1, greatest(2, len(w) - 8))) u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM wins),
grams AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') g FROM fold, sizes, unnest(range(1, len(w) - k + 2)) u(i)),
hits AS (SELECT doc_id, i, g.k, item FROM grams g JOIN wins v ON g.k = v.k AND g.g = v.g),
per AS (SELECT doc_id, count(DISTINCT p) n_hit FROM hits, unnest(range(i, i + k)) u(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) n_items, string_agg(DISTINCT item, ',' ORDER BY item) all_items FROM hits GROUP BY doc_id)
SELECT f.doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items,
  sha256(coalesce(all_items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM fold f LEFT JOIN per USING (doc_id) LEFT JOIN named USING (doc_id)
"""
