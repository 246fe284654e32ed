"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from the kinds of its bytes, their successions and how much of
it repeats; a gated attention, learned from labels of whole documents alone, weighs the passages, and the weighted
representation is scored. So a short bad part can decide about a long text. The model is learned in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import fold, let_go, map_arrow, sample_by_label

#: Bytes of a passage; units of the encoder and of the attention.
PASSAGE, UNITS, GATES = 480, 24, 12
#: Labelled documents that the model is learned from at most, and passes over them. A sampled text is used whole.
SAMPLE_DOCS, EPOCHS, RATE = 4_000, 14, 0.01
#: From this score on a document counts as good.
GOOD = 0.3
#: Bytes that are encoded at once.
CHUNK = PASSAGE * 2_048
_SLOTS = 1_024

#: Kinds of bytes: one for each group and one for all others.
_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"|", b"#", b"$", b"%", b"&", b"*", b"=+/\\<>@_~^", b"\"'()[]{}", b"-:;?", bytes(range(128, 192)), bytes(range(192, 256))]
_KINDS = len(_GROUPS) + 1
_KIND = np.full(256, _KINDS - 1, np.int64)
for _k, _g in enumerate(_GROUPS):
    _KIND[list(_g)] = _k
FEATURES = _KINDS + _KINDS * _KINDS + 3


def encode(text: bytes | None) -> np.ndarray:
    """A row of features for each passage of a text; one of zeros for an empty text."""
    if not text:
        return np.zeros((1, FEATURES), np.float32)
    out = []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data), CHUNK):
        a = data[at : at + CHUNK]
        kind = _KIND[a]
        count = -(-len(a) // PASSAGE)
        passage = np.arange(len(a)) // PASSAGE
        size = np.bincount(passage, minlength=count).astype(np.float32)
        single = np.bincount(passage * _KINDS + kind, minlength=count * _KINDS).reshape(count, _KINDS)
        pair = np.bincount((passage[1:] * _KINDS + kind[:-1]) * _KINDS + kind[1:], minlength=count * _KINDS * _KINDS).reshape(count, -1)
        # how many slots the passage's runs of four bytes fill, of those that as many different runs would
        wide = a.astype(np.uint32)
        runs = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24) if len(a) > 3 else wide[:0]
        slot = (runs * np.uint32(2654435761)) >> np.uint32(22)
        filled = (np.bincount(passage[: len(slot)] * _SLOTS + slot, minlength=count * _SLOTS).reshape(count, _SLOTS) > 0).sum(1)
        fresh = filled / (_SLOTS * -np.expm1(-np.maximum(size, 1) / _SLOTS))
        gaps = single[:, 3] + single[:, 4] + 1
        letters = single[:, 0] + single[:, 1] + single[:, 17] + single[:, 18]
        extra = np.stack([1 - fresh, np.minimum(letters / gaps, 20) / 10 - 0.6, np.minimum(size / PASSAGE, 1)], 1)
        out.append(np.concatenate([np.sqrt(single / size[:, None]), np.sqrt(pair / size[:, None]), 2 * extra], 1).astype(np.float32))
    return np.concatenate(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of the encoder (w, b), attention (v, u, a) and score (o, c); slope and shift of the calibration."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.5
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES, np.float32))

    def forward(self, x: np.ndarray) -> tuple[float, tuple]:
        p = self.weights
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        share = np.exp(e - e.max())
        share /= share.sum()
        z = share @ h
        return float(z @ p["o"] + p["c"]), (h, t, g, share, z)

    def score(self, text: bytes | None) -> float:
        return float(_sigmoid(np.array(self.slope * self.forward(encode(text))[0] + self.shift)))


def learn(samples: list[tuple[bytes | None, int]], seed: int = 1) -> Model:
    """The model of (text, label 0 or 1) pairs. Labels are weighted evenly while learning; on every fifth text, kept
    back, scores are then fitted to the odds at which the labels occur there."""
    rng = np.random.default_rng(seed)
    init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"w": init(FEATURES, UNITS), "b": np.zeros(UNITS, np.float32), "v": init(UNITS, GATES), "u": init(UNITS, GATES), "a": init(GATES), "o": init(UNITS), "c": np.zeros((), np.float32)}
    model = Model(p)
    if len({y for _, y in samples}) < 2:
        model.slope, model.shift = 0.0, 4.0 if samples and samples[0][1] else -4.0 if samples else 0.0
        return model
    bags = [(encode(t), y) for t, y in samples]
    kept, used = (bags[::5], [b for k, b in enumerate(bags) if k % 5]) if len(bags) >= 50 else (bags, bags)
    even = np.array([sum(y == k for _, y in used) or 1 for k in (0, 1)], float)
    weight = even.sum() / (2 * even)
    first, second = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step, total = 0, EPOCHS * len(used)
    grads = {k: np.zeros_like(x) for k, x in p.items()}
    for _ in range(EPOCHS):
        for at in rng.permutation(len(used)):
            x, y = used[at]
            out, (h, t, g, share, z) = model.forward(x)
            d = weight[y] * (_sigmoid(np.array(out)) - y)
            dz = d * p["o"]
            ds = h @ dz
            de = share * (ds - share @ ds)
            dtg = de[:, None] * p["a"]
            dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
            dh = (share[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
            for k, value in (("w", x.T @ dh), ("b", dh.sum(0)), ("v", h.T @ dt), ("u", h.T @ dg), ("a", (t * g).T @ de), ("o", d * z), ("c", d)):
                grads[k] += value
            step += 1
            if step % 8 == 0 or step == total:
                n, rate = (step + 7) // 8, RATE * (1 - step / (total + 1))
                for k, x_ in p.items():
                    first[k] = 0.9 * first[k] + 0.1 * grads[k]
                    second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                    p[k] = (x_ - rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6) - rate * 1e-3 * x_).astype(np.float32)
                    grads[k][...] = 0
    raw = np.array([model.forward(x)[0] for x, _ in kept])
    truth = np.array([y for _, y in kept], float)
    slope, shift = 1.0, 0.0
    for _ in range(200):  # logistic regression on one number, damped Newton steps
        q = _sigmoid(slope * raw + shift)
        s = q * (1 - q) + 1e-4
        g1, g0 = ((q - truth) * raw).sum() + 0.05 * slope, (q - truth).sum()
        a, b, c = (s * raw * raw).sum() + 0.05, (s * raw).sum(), s.sum()
        det = a * c - b * b
        slope -= 0.5 * (c * g1 - b * g0) / det
        shift -= 0.5 * (a * g0 - b * g1) / det
    model.slope, model.shift = float(slope), float(shift)
    return model


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of about ``sample_docs`` labelled documents, as many of either label as there are up to half of them.

    ``labels`` has doc_id and quality (0 or 1); rows with null or another value are not used. The sample is drawn by a
    hash of doc_id; scores are fitted to the odds of the labels among all labelled rows."""
    rows = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    counts = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    drawn = sample_by_label(rows, "quality", sample_docs)
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    samples = sorted((r["doc_id"], r["text"] or "", r["quality"]) for r in found.collect())
    model = learn([(t.encode(), y) for _, t, y in samples])
    taken = [sum(y == k for *_, y in samples) for k in (0, 1)]
    if all(taken) and len(counts) == 2:
        model.shift += float(np.log(counts[1] / counts[0]) - np.log(taken[1] / taken[0]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted (1 from GOOD on) for each row. A null or empty text is one passage without features.
    Repeated rows each get their row; other columns are left out; every passage of a text counts."""
    id_type = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        own = shared.value
        for batch in batches:
            s = [own.score(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s, pa.float64()), pa.array([int(x >= GOOD) for x in s], pa.int32())], ["doc_id", "score", "predicted"]
            )

    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, f"doc_id {id_type}, score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from labels outside fold ``held`` of ``parts``, applied to all."""
    out = fold(F.col("doc_id"), parts) == held
    model = train(docs, labels.where(~out))
    return score(docs, model).select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns; the model learns from ``labels`` outside fold 0
    of 5. A text goes to the workers once, beside the other columns, and rows come back as they went, so nothing is joined;
    null and empty texts are scored too. Each row is decided by its own text, repeated rows alike. Without labels all rows
    stay; an empty table stays empty."""
    model = train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    once = {"text"} if dict(docs.dtypes).get("text") == "string" else set()  # else it is scored as a string and kept as it was
    rows = docs.select(F.struct(*(docs[c].alias(c) for c in docs.columns if c not in once)).alias("row"), docs["text"].cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py()) >= GOOD for t in batch.column("text").cast(pa.binary())], pa.bool_()))

    good = map_arrow(rows, work, rows.schema)
    return good.select(*(F.col("text") if c in once else F.col("row").getField(c).alias(c) for c in docs.columns))
