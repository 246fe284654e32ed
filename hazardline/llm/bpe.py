"""Token counts by byte-pair merging with a heap over a linked list.

A text is cut at blanks, since no token of a byte-level vocabulary spans a blank and what stands before it. Each
different chunk is counted once per worker: its pre-tokens start as bytes, and the adjacent pair of lowest rank is
popped and joined until none is left. Tokens are symbols less merges; no identifiers are made.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import map_arrow

#: Pre-tokens of a byte-level vocabulary: contractions, letters, numbers, other signs, white space. Fixed value.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank with white space on both sides: there a text can't be cut at blanks.
WIDE_GAP = re.compile(r"\s (?:\s|\Z)")
#: Different chunks and pre-tokens that a worker remembers. Others are counted anew each time.
REMEMBERED = 400_000
#: Longest chunk that is remembered, in characters.
REMEMBERED_CHARS = 64

_BITS = 20
_AT = (1 << 40) - 1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself where printable, else the
    next code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PairMerger:
    """Merge ranks of a byte-level vocabulary; ``count`` gives the tokens of one pre-token."""

    def __init__(self, vocabulary_json: str) -> None:
        model = json.loads(vocabulary_json)
        if model["model"]["type"] != "BPE" or (model.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("only byte-level pair vocabularies are counted")
        self.special = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        ids: dict[str, int] = {letter: b for letter, b in byte_letters().items()}
        self.rank: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = ids.setdefault(left + right, len(ids))
            self.rank[ids[left] << _BITS | ids[right]] = rank
            self.joined.append(made)

    def count(self, word: bytes) -> int:
        n = len(word)
        if n < 2:
            return n
        rank, joined = self.rank, self.joined
        symbol = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 40 | i for i in range(n - 1) if (r := rank.get(symbol[i] << _BITS | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            top = heapq.heappop(heap)
            i, r = top & _AT, top >> 40
            j = after[i]
            if symbol[i] < 0 or j >= n or rank.get(symbol[i] << _BITS | symbol[j]) != r:
                continue  # one of the two was joined meanwhile
            symbol[i], symbol[j] = joined[r], -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(symbol[i] << _BITS | symbol[k])) is not None:
                    heapq.heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := rank.get(symbol[h] << _BITS | symbol[i])) is not None:
                heapq.heappush(heap, r << 40 | h)
        return left


class _Words(dict):
    """Tokens by pre-token."""

    def __init__(self, merger: PairMerger) -> None:
        self.merger = merger

    def __missing__(self, word: str) -> int:
        n = self.merger.count(word.encode())
        if len(self) < REMEMBERED and len(word) <= REMEMBERED_CHARS:
            self[word] = n
        return n


class _Chunks(dict):
    """Tokens of a blank and what follows it up to the next blank."""

    def __init__(self, words: _Words) -> None:
        self.words, self.find = words, regex.compile(PRETOKEN).findall

    def __missing__(self, chunk: str) -> int:
        n = self.text(" " + chunk)
        if len(self) < REMEMBERED and len(chunk) <= REMEMBERED_CHARS:
            self[chunk] = n
        return n

    def text(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.find(text)))


class TokenCounter:
    """Token counts of whole texts, special strings in them taken as one token each."""

    def __init__(self, vocabulary_json: str) -> None:
        merger = PairMerger(vocabulary_json)
        self.chunks = _Chunks(_Words(merger))
        self.special = re.compile("|".join(map(re.escape, merger.special))) if merger.special else None

    def _plain(self, text: str) -> int:
        if WIDE_GAP.search(text):
            return self.chunks.text(text)
        first, *rest = text.split(" ")
        return self.chunks.text(first) + sum(map(self.chunks.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not (found := self.special.findall(text)):
            return self._plain(text)
        return len(found) + sum(map(self._plain, self.special.split(text)))


_COUNTERS: dict[int, TokenCounter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each document row, by the byte-level vocabulary file ``vocabulary``.

    A null or empty text has no bytes and no tokens. Repeated rows each get their row; other columns are left out. Very
    long texts are read whole: a heap holds one pre-token, not a text. The file is read by the driver alone.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(content)
    id_type = dict(docs.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        if key not in _COUNTERS:  # a worker that serves several tasks keeps what it has counted
            _COUNTERS[key] = TokenCounter(shared.value)
        counter = _COUNTERS[key]
        for batch in batches:
            n = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return map_arrow(source, count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
