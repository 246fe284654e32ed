"""Hierarchical packing of documents into windows of several context sizes.

A document's tokens are cut into windows of the longest size; what remains goes to the tier of the smallest size that
holds it. Each tier is packed, longest first; gaps of its windows are filled from shorter tiers, and the last filler is
cut to fit, so that windows are full. Whole windows of one size are dealt to step groups of equal tokens.

A task packs the documents it reads and keeps a bounded buffer, so nothing is shuffled. The few pieces left at its end
are cut into power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.bpe import PRETOKEN, byte_letters
from hazardline.llm.common import held, map_arrow

#: Context sizes; powers of two, so that none of their windows is padded.
TIERS = (1024, 512, 256, 128)
#: Tokens of a step group.
STEP_TOKENS = 8192
#: Remainders that a task holds before it packs them.
BUFFER = 4096
#: Characters of texts that are encoded together.
GROUP_CHARS = 1_000_000
#: Characters of a run that may be one pre-token from which a text goes to the tokenizers library.
LONG_RUN = 256
_LONG_TOKEN = re.compile(rf"\w{{{LONG_RUN}}}|(?:[^\w\s]|_){{{LONG_RUN}}}|\s{{{LONG_RUN}}}")
#: Blocks beyond the first plane that hold signs only, no letters, numbers or blanks. Fixed values.
SIGN_BLOCKS = ((0x1F300, 0x1F6FF), (0x1F900, 0x1FAFF))

_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
_FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]


class Encoder:
    """Identifiers of whole texts as little-endian unsigned 32-bit bytes, as the tokenizers library gives them.

    A byte-level vocabulary whose identifiers follow its merges means the same to tiktoken, which reads pairs from ranks
    and is several times as fast: a token is merged from one pair only, and what its letters become on their own they
    also become inside a word. Both facts are checked on the file; another vocabulary goes to the library alone. So do
    texts with special strings, with characters that versions of Unicode may class differently, or with very long runs.
    """

    def __init__(self, vocabulary_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary_json)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        ranks = merge_ranks(json.loads(vocabulary_json))
        self.ranked = tiktoken.Encoding("ranked", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def _ranked_too(self, text: str) -> bool:
        if self.ranked is None or self.special is not None and self.special.search(text):
            return False
        if not text.isascii() and unsettled().search(text):
            return False
        if len(text) < LONG_RUN:
            return True
        sizes = list(map(len, text.split()))
        blanks = len(text) - sum(sizes) - len(sizes)  # those beyond one a word
        return max(sizes, default=0) < LONG_RUN and blanks < LONG_RUN or not _LONG_TOKEN.search(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Identifiers of each text, in order."""
        out, others = [b""] * len(texts), []
        for k, text in enumerate(texts):
            if not self._ranked_too(text):
                others.append(k)
            elif text:
                out[k] = array("I", self.ranked.encode_ordinary(text)).tobytes()
        made = self.library.encode_batch_fast([texts[k] for k in others], add_special_tokens=False)
        for k, encoded in zip(others, made, strict=True):
            out[k] = array("I", encoded.ids).tobytes()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def merge_ranks(file: dict) -> dict[bytes, int] | None:
    """Bytes to identifier, if the vocabulary is plainly byte-level and its merges make the tokens in order of their
    identifiers, each from letters that merge to it on their own; else None."""
    model, letters = file["model"], byte_letters()
    pre = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    plain = model["type"] == "BPE" and not file.get("normalizer") and not any(model.get(o) for o in options)
    if not plain or {k: v for k, v in (file.get("pre_tokenizer") or {}).items() if k in pre} != pre:
        return None
    vocab = model["vocab"]
    made = {t: vocab.get(t) for t in letters}
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        if left not in made or right not in made or left + right in made:
            return None
        made[left + right] = vocab.get(left + right)
    merged = list(made.values())[len(letters) :]
    special = {t["content"] for t in file.get("added_tokens", [])}
    if None in made.values() or merged != sorted(merged) or max(vocab[t] for t in letters) > min(merged, default=len(vocab)):
        return None
    if set(vocab) - set(made) - special:
        return None
    return {bytes(letters[c] for c in t): k for t, k in made.items()}


@functools.cache
def unsettled() -> re.Pattern[str]:
    """Characters whose class may depend on the version of Unicode: not yet given in 3.2, save blocks of signs alone."""
    given = [c for c in range(0x10000) if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs")]
    spans: list[list[int]] = []
    for c in given:
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in [*spans, *SIGN_BLOCKS]) + "]")


def groups_of(texts: Iterable[str | None], most: int) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``most`` characters; a longer text is a list of its own."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text or "") > most:
            yield held
            held, size = [], 0
        held.append(text or "")
        size += len(text or "")
    if held:
        yield held


class Packer:
    """Packs one task's documents. ``rows`` collects the pieces as tuples of document number and output fields."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> None:
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers, reverse=True):
            raise ValueError("context sizes are powers of two, longest first")
        self.tiers, self.step_tokens, self.base = tiers, step_tokens, task << 40
        self.sequences = 0
        self.filled = {t: 0 for t in tiers}
        self.held: list[tuple[int, object, int, int, bytes]] = []  # length, document, its tokens, start, identifiers
        self.rows: list[tuple] = []

    def add(self, document: object, ids: bytes) -> None:
        n, longest = len(ids) // 4, self.tiers[0]
        full = n - n % longest
        for start in range(0, full, longest):
            self._emit([(longest, document, n, start, ids[4 * start : 4 * (start + longest)])])
        if n > full:
            self.held.append((n - full, document, n, full, ids[4 * full :]))

    def _emit(self, pieces: list[tuple[int, object, int, int, bytes]]) -> None:
        size = sum(p[0] for p in pieces)
        tier = next(t for t in reversed(self.tiers) if t >= size)
        step = self.filled[tier] // self.step_tokens
        self.filled[tier] += tier
        group = self.base | self.tiers.index(tier) << 36 | step
        offset = 0
        for length, document, n, start, ids in pieces:
            self.rows.append((document, start, length, zlib.crc32(ids), n, self.base | self.sequences, offset, tier, group))
            offset += length
        self.sequences += 1

    def flush(self, last: bool = False) -> None:
        """Packs what is held; unless ``last``, pieces that fill no window stay."""
        waiting = sorted(self.held, key=lambda p: p[0])  # ascending; the list of all shorter pieces is a prefix of it
        sizes = [p[0] for p in waiting]
        rest: list[tuple[int, object, int, int, bytes]] = []
        while waiting:
            window = [waiting.pop()]
            sizes.pop()
            tier = next(t for t in reversed(self.tiers) if t >= window[0][0])
            gap = tier - window[0][0]
            while gap and waiting:
                at = bisect.bisect_right(sizes, gap) - 1
                if at >= 0:
                    filler = waiting.pop(at)
                    sizes.pop(at)
                else:  # all are longer than the gap: the shortest is cut to fit
                    n, document, total, start, ids = waiting.pop(0)
                    sizes.pop(0)
                    filler = (gap, document, total, start, ids[: 4 * gap])
                    tail = (n - gap, document, total, start + gap, ids[4 * gap :])
                    to = bisect.bisect_left(sizes, tail[0])
                    waiting.insert(to, tail)
                    sizes.insert(to, tail[0])
                window.append(filler)
                gap -= filler[0]
            if gap:
                rest += window
            else:
                self._emit(window)
        self.held = rest
        if last:
            self._even(rest)
            self.held = []

    def _even(self, pieces: list[tuple[int, object, int, int, bytes]]) -> None:
        """Cuts the pieces into sequences of power-of-two lengths, longest first."""
        left = sum(p[0] for p in pieces)
        queue = list(reversed(pieces))
        while left:
            size = gap = min(self.tiers[0], 1 << (left.bit_length() - 1))
            window = []
            while gap:
                n, document, total, start, ids = queue.pop()
                take = min(n, gap)
                window.append((take, document, total, start, ids[: 4 * take]))
                if n > take:
                    queue.append((n - take, document, total, start + take, ids[4 * take :]))
                gap -= take
            self._emit(window)
            left -= size


def pack(docs: DataFrame, vocabulary: str, tiers: tuple[int, ...] = TIERS, end_id: int = 0, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A document is its identifiers and ``end_id``; a null or empty text is ``end_id`` alone. Each row is a document of its
    own, repeated rows too. A text of any length is cut into windows; other columns are left out; an empty table gives
    no rows. ``tier`` is the context size a sequence belongs to; the sequences of a step group add up to ``step_tokens``
    of one size (the last group of a task to less).
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = dict(docs.dtypes)["doc_id"]
    end = array("I", [end_id]).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("encoder", hash(shared.value)), lambda: Encoder(shared.value))
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        kind = None

        def made() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True))
            packer.rows = []
            types = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=True))], ["doc_id", *_FIELDS]
            )

        for batch in batches:
            kind = batch.column("doc_id").type
            documents = iter(batch.column("doc_id").to_pylist())
            for texts in groups_of((t.as_py() for t in batch.column("text")), GROUP_CHARS):
                for ids in encoder.encode_all(texts):
                    packer.add(next(documents), ids + end)
                    if len(packer.held) >= BUFFER:
                        packer.flush()
                    if len(packer.rows) >= 20_000:
                        yield made()
        packer.flush(last=True)
        if packer.rows:
            yield made()

    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, f"doc_id {id_type}, {_SCHEMA}")
