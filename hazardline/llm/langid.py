"""Language identification by averaged hashed subword embeddings.

A text is the mean of the vectors of its byte n-grams inside words; a linear softmax over it gives the language. Vectors
and weights are learned by stochastic gradient descent in numpy, on a bounded sample. A temperature makes scores match
how often they are right, and a threshold marks those that are not sure enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import fold, map_arrow, sample_by_label

#: Hashed n-grams and their vectors' length; lengths of n-grams in bytes.
BUCKETS_LOG2, DIMENSIONS, GRAMS = 16, 16, (2, 3, 4)
#: Documents in the sample that the model is learned from, and bytes of one training piece. A sampled text of any
#: length is used whole.
SAMPLE_DOCS, PIECE = 2_000, 240
EPOCHS, RATE = 3, 0.5
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 20

_LETTER = regex.compile(r"\p{L}")
_SPACED = np.array([b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)], np.uint8)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams inside words, each word with a blank before and after it, a chunk of starts at a time."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    for at in range(0, len(data), CHUNK):
        a = _SPACED[data[at : at + CHUNK + max(GRAMS) - 1]].astype(np.uint32)
        blank = a == 32
        gram, inside = a, ~blank
        for n in range(2, max(GRAMS) + 1):
            if len(a) < n:
                break
            gram = gram[:-1] << np.uint32(8) | a[n - 1 :]
            if n == 2:
                used = inside[:-1] | inside[1:]
            else:
                middle = inside[1:-1] if n == 3 else middle[:-1] & inside[n - 2 : -1]
                used = middle
            if n in GRAMS:
                yield (gram[:CHUNK][used[:CHUNK]] * np.uint32(2654435761 + 2 * n)) >> np.uint32(32 - BUCKETS_LOG2)


@dataclass
class Model:
    """Languages, and for each bucket what it adds to the logits of each."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for b in buckets(text):
            n += len(b)
            if len(b) > len(self.table) // 4:
                total += np.bincount(b, minlength=len(self.table)) @ self.table
            else:
                total += self.table[b].sum(0)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _pieces(text: str) -> list[str]:
    """A text in pieces of about PIECE characters, cut at blanks."""
    words, out, held, size = text.split(" "), [], [], 0
    for w in words:
        held.append(w)
        size += len(w) + 1
        if size >= PIECE:
            out.append(" ".join(held))
            held, size = [], 0
    return [*out, " ".join(held)] if held else out


def learn(samples: list[tuple[str, str]], target: float = 0.99, seed: int = 1) -> Model:
    """The model of (text, language) pairs. Every fifth text is kept for the temperature and for the threshold, the
    smallest score from which the share of right answers is ``target``."""
    samples = [(t, lang) for t, lang in samples if t and _LETTER.search(t)]
    languages = sorted({lang for _, lang in samples})
    size, classes = 1 << BUCKETS_LOG2, len(languages)
    if not classes:
        return Model([], np.zeros((size, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (size, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, classes), np.float32), np.zeros(classes, np.float32)
    kept = samples[::5] if len(samples) >= 20 else samples
    used = [s for k, s in enumerate(samples) if k % 5] if len(samples) >= 20 else samples
    pieces = []
    for text, lang in used:
        for piece in _pieces(text):
            b = np.concatenate(list(buckets(piece)) or [np.empty(0, np.uint32)])
            if len(b):
                pieces.append((*np.unique(b, return_counts=True), languages.index(lang)))
    steps = EPOCHS * len(pieces)
    order = np.concatenate([rng.permutation(len(pieces)) for _ in range(EPOCHS)]) if pieces else []
    for step, k in enumerate(order):
        rate = RATE * (1 - step / steps)
        b, counts, label = pieces[k]
        share = (counts / counts.sum()).astype(np.float32)
        mean = share @ vectors[b]
        z = mean @ weights + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        back = weights @ p
        weights -= rate * np.outer(mean, p)
        bias -= rate * 0.01 * p
        vectors[b] -= rate * np.outer(share, back) * len(b)
    model = Model(languages, (vectors @ weights).astype(np.float64), bias.astype(np.float64))
    z = np.array([model.logits(t) for t, _ in kept])
    truth = np.array([languages.index(lang) for _, lang in kept])

    def loss(t: float) -> float:
        s = z / t
        top = s.max(1)
        return float((np.log(np.exp(s - top[:, None]).sum(1)) + top - s[np.arange(len(s)), truth]).mean())

    model.temperature = min((2.0**k for k in np.arange(-6, 6.5, 0.5)), key=loss)
    p = np.exp((z - z.max(1)[:, None]) / model.temperature)
    score = (p / p.sum(1)[:, None]).max(1)
    right = z.argmax(1) == truth
    order = np.argsort(-score, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= target)
    model.threshold = float(score[order][good[-1]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, target: float = 0.99) -> Model:
    """A model of about ``sample_docs`` rows of ``docs`` (doc_id, text, lang), evenly over languages; rows without text or
    language are not used. The sample is drawn by a hash of doc_id."""
    rows = sample_by_label(docs.where("text is not null").select("doc_id", "lang", F.col("text").cast("string").alias("text")), "lang", sample_docs)
    found = sorted((r["doc_id"], r["text"], r["lang"]) for r in rows.collect())
    return learn([(t, lang) for _, t, lang in found], target)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, accepted for each row.

    A null text, or one without a letter, is ``und`` with score 0 and not accepted; so is every text if the model has no
    language. ``accepted`` is false where the score is under the model's threshold. Repeated rows each get their row;
    other columns are left out; texts are read whole.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[0] != "und" and f[1] >= own.threshold for f in found])],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, f"doc_id {id_type}, lang_pred string, score double, accepted boolean")


def identify_held_out(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted: learned from the rows of ``docs`` outside fold ``held`` of ``parts``,
    applied to all."""
    out = fold(F.col("doc_id"), parts) == held
    model = train(docs.where(~out))
    return identify(docs, model).select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
