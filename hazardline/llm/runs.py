"""Periodic runs of words, from squares that a suffix automaton with link-cut access reports.

The suffix links of a text's automaton form a tree; a node stands for the substrings that end at the same places. Prefixes
are visited in order. A visit recolours the path from the prefix to the root with the new end, and on its way meets the
segments of the path that an earlier end coloured last: their substrings ended there last. Where the distance of the two
ends is no longer than the segment's longest substring, a square ends here, and is extended to its run. The paths are kept
as in a link-cut tree (splay trees of preferred paths), so all visits take n log n steps together, however a text repeats.

A run of at least 12 words that repeats itself at least twice holds nothing but words of six-word sequences that occur twice
in the text. So the automaton is built over the stretches that such sequences cover; in most prose there is none.

A document is worked on within one task; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import map_arrow, texts

#: Words of the shortest run that counts.
LEAST = 12

Run = tuple[int, int, int]


class SuffixAutomaton:
    """States of a sequence: ``length`` of the longest substring, suffix ``link``, and the state of each prefix."""

    def __init__(self, words: list) -> None:
        length, link, edges = [0], [-1], [{}]
        prefixes = []
        last = 0
        for word in words:
            state = len(length)
            length.append(length[last] + 1)
            link.append(0)
            edges.append({})
            p = last
            while p >= 0 and word not in edges[p]:
                edges[p][word] = state
                p = link[p]
            if p >= 0:
                q = edges[p][word]
                if length[q] == length[p] + 1:
                    link[state] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    edges.append(dict(edges[q]))
                    while p >= 0 and edges[p].get(word) == q:
                        edges[p][word] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            prefixes.append(state)
            last = state
        self.length, self.link, self.prefixes = length, link, prefixes


class LastEnds:
    """The root paths of a tree, each coloured with the last end that visited it.

    Preferred paths are splay trees ordered by depth; ``up`` leads to the parent inside a path's tree, or from its top to
    the node above the path. A path has one colour, kept at the root of its splay tree; 0 stands for none.
    """

    def __init__(self, parents: list[int]) -> None:
        n = len(parents)
        self.up = [p + 1 for p in parents]  # nodes from 1, so that 0 is none
        self.up.insert(0, 0)
        self.left, self.right, self.colour = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if not p or left[p] != x and right[p] != x:
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if not inner:
                colour[x] = colour[p]
            if left[p] == x:
                if inner and left[g] == p:  # zig-zig: the parent first
                    self._rotate(p)
                    p = up[x]
                    self._rotate(x)
                else:
                    self._rotate(x)
                    if inner:
                        self._rotate(x)
            elif inner and right[g] == p:
                self._rotate(p)
                self._rotate(x)
            else:
                self._rotate(x)
                if inner:
                    self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:  # x is the root of its splay tree now
            colour[x] = colour[p]

    def visit(self, node: int, end: int) -> Iterator[tuple[int, int]]:
        """Recolours the root path of ``node`` with ``end``; yields its segments as (deepest node, earlier end)."""
        up, right, colour = self.up, self.right, self.colour
        x, below = node + 1, 0
        while x:
            self._splay(x)
            cut = right[x]
            if cut:
                colour[cut] = colour[x]
            if colour[x]:
                yield x - 1, colour[x]
            right[x] = below
            below = x
            x = up[x]
        colour[below] = end


def find_runs(words: list, least: int = LEAST) -> list[Run]:
    """(start, length, period) of every run of at least ``least`` words, by start, then period.

    A run has its smallest period, is at least twice as long, and no neighbouring word extends it.
    """
    n = len(words)
    automaton = SuffixAutomaton(words)
    ends, length = LastEnds(automaton.link), automaton.length
    reached: dict[int, int] = {}  # by period: where the last run of that period stops
    runs = []
    for r, state in enumerate(automaton.prefixes):
        for node, before in ends.visit(state, r + 1):
            period = r + 1 - before
            if period > length[node] or reached.get(period, 0) > r:
                continue
            start, stop = r + 1 - 2 * period, r + 1
            while start and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while stop < n and words[stop] == words[stop - period]:
                stop += 1
            reached[period] = stop
            if stop - start >= least:
                runs.append((start, stop - start, period))
    runs.sort(key=lambda run: (run[0], run[2]))
    return runs


def repeated_stretches(words: list, least: int = LEAST) -> list[tuple[int, int]]:
    """Bounds of the stretches of at least ``least`` words that are covered by sequences of ``least / 2`` words which occur
    twice. Every run of ``least`` words lies inside one: it repeats half of itself."""
    n, width = len(words), least // 2
    if n < least:
        return []
    values = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    sums = values[: n - width + 1].copy()
    for k in range(1, width):
        sums *= np.uint64(0x9E3779B97F4A7C15)
        sums ^= sums >> np.uint64(29)
        sums += values[k : n - width + 1 + k]
    order = np.argsort(sums)
    same = sums[order[1:]] == sums[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(len(sums), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(twice)
    steps[at] += 1
    steps[at + width] -= 1
    inside = np.concatenate(([0], (np.cumsum(steps[:-1]) > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(inside)).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in edges if b - a >= least]


def runs_of(words: list, least: int = LEAST) -> list[Run]:
    """:func:`find_runs` over the stretches of a text that can hold any."""
    found = []
    for a, b in repeated_stretches(words, least):
        found += [(a + s, length, period) for s, length, period in find_runs(words[a:b], least)]
    return found


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def repeat_tail(words: list, doc_id: str) -> list:
    """The words of every tenth document (by the crc32 of its id) with a part of them repeated to the end."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    part = words[a : a + p]
    return words[:a] + part * times + part[:rest]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(docs: DataFrame, least: int = LEAST, planted: bool = False) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period), collapsed: one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0; ``collapsed`` is the words kept, joined by one space: a word goes if
    a run holds it after the run's first period. ``planted`` first repeats a part of every tenth document, see
    :func:`repeat_tail` (a null doc_id is never one). A null or empty text has no words, no runs and an empty ``collapsed``.
    Rows are on their own: repeated rows give equal results, an empty table gives none; no column but doc_id and text
    is read, so others may have any name. A text of any length is read whole; memory grows with the longest text, time
    with its words times the logarithm of their number.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            keys = batch.column("key_").to_pylist()
            counts, runs, kept = [], [], []
            for key, text in zip(keys, texts(batch), strict=True):
                words = (text or b"").split()
                if planted and key is not None:
                    words = repeat_tail(words, key)
                found = runs_of(words, least)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                kept.append(b" ".join(collapse(words, found)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("key_"), F.col("text").cast("string").alias("text"))
    return map_arrow(
        rows, work, f"doc_id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli) and digests of all runs and of the collapsed
    text, for documents with planted repeats. Of equally long runs the one of the smallest start, then period, is
    reported; without a run its four columns are null."""
    found = detect(docs, planted=True)
    runs = F.col("runs")
    # structs compare field by field
    top = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select("doc_id", "runs", "collapsed", top.alias("top")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(F.col("top.length") * F.lit(1000) / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
