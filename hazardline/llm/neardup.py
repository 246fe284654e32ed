"""Near-duplicate groups by the chosen-path set similarity join.

A document is its set of word shingles. In each of a number of independent trees it chooses every shingle whose keyed
hash falls under 1 / (threshold * set size); documents that choose the same shingle meet in a node. A pair at the
threshold or above shares at least one chosen shingle on average in each tree, so enough trees find it. Nodes of few
documents are compared exhaustively; larger ones branch again on shingles chosen with a key that depends on the node,
which parts documents that only share a passage. Nodes that stay large after the last branching are compared in blocks.

Documents of equal sets are one class, and all work is on classes. Links inside what is already known to be one
component are not compared again, so a group of n copies costs about n comparisons. A bottom-k sketch drops pairs far
from the threshold; every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import LOWER_BYTES, cut, map_arrow, text_key
from hazardline.llm.components import components

#: Independent trees. A pair at the threshold is missed by one tree of three levels with odds of at most 0.63.
TREES = 24
#: Documents of a node that are compared in pairs; larger nodes branch.
NODE = 64
#: Levels of a tree.
LEVELS = 3
#: Smallest hashes kept in a sketch, and how far below the threshold an estimate may be (six deviations).
SKETCH, SLACK = 64, 0.3
#: Classes that may be broadcast to find their texts; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Shingles of a block when a large node is compared in blocks.
BLOCK_SHINGLES = 400_000

_MIX1, _MIX2, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _MIX1
    x ^= x >> np.uint64(32)
    x *= _MIX2
    x ^= x >> np.uint64(29)
    return x


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words (A-Z lower-cased, split at ASCII white space); of fewer
    words, one hash of all; of none, nothing."""
    words = text.translate(LOWER_BYTES).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    wide = min(width, len(words))
    count = len(words) - wide + 1
    out = np.full(count, wide, np.uint64) * _STEP
    for k in range(wide):
        out = _mix(out + one[k : k + count])
    return np.unique(out)


def choose(shingles: np.ndarray, keys: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each key the shingles it chooses: positions in ``keys`` and the ids of the nodes they lead to."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(shingles)))))
    at, nodes = [], []
    step = max(1, 1_000_000 // len(shingles))
    for k in range(0, len(keys), step):
        drawn = _mix(shingles[None, :] ^ keys[k : k + step, None])
        row, column = np.nonzero(drawn <= limit)
        at.append(row + k)
        nodes.append(drawn[row, column])
    return np.concatenate(at), np.concatenate(nodes)


_TREE_KEYS = _mix(np.arange(1, 1 + 4096, dtype=np.uint64) * _STEP)


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def similar(both: int, one: int, other: int, percent: int) -> bool:
    return 100 * both >= percent * (one + other - both)


def _size_fits(one: Column, other: Column, percent: int) -> Column:
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _signatures(docs: DataFrame, width: int, percent: int, trees: int) -> DataFrame:
    """doc_id, t1, t2, ckey (of the set; null where empty), n, nodes (each once), sketch for each row."""
    id_type = dict(docs.dtypes)["doc_id"]
    keys, threshold = _TREE_KEYS[:trees], percent / 100

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, nodes, sketch = [], [], [], []
            for text in batch.column("text").cast(pa.binary()):
                own = shingle_set(text.as_py(), width)
                n.append(len(own))
                key.append(_key(own) if len(own) else None)
                nodes.append(np.unique(choose(own, keys, threshold)[1]).view(np.int64) if len(own) else [])
                sketch.append((own[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t1"), batch.column("t2"), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(nodes, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["doc_id", "t1", "t2", "ckey", "n", "nodes", "sketch"],
            )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), *text_key(F.col("text").cast("string")))
    return map_arrow(source, work, f"doc_id {id_type}, t1 long, t2 long, ckey binary, n long, nodes array<long>, sketch binary")


class _Join:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, width: int, percent: int, trees: int, node: int, levels: int) -> None:
        self.docs, self.width, self.percent = docs, width, percent
        self.node, self.levels = node, levels
        self.rows = cut(_signatures(docs, width, percent, trees), "signatures")
        self.classes = cut(
            self.rows.where("n > 0").groupBy("ckey").agg(
                F.min(F.struct("doc_id", "t1", "t2")).alias("rep"), F.min("doc_id").alias("least"),
                F.first("n").alias("n"), F.first("nodes").alias("nodes"), F.first("sketch").alias("sketch"),
            ),
            "classes",
        )

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (ckey and more) with the text of one document of each class."""
        reps = wanted.join(self.classes.select("ckey", "rep"), "ckey").select("rep.*", *wanted.columns).withColumnRenamed("doc_id", "rep_id")
        if reps.count() <= BROADCAST_ROWS:
            reps = F.broadcast(reps)
        source = self.docs.select("doc_id", F.col("text").cast("string").alias("text"), *text_key(F.col("text").cast("string")))
        same = source["doc_id"].eqNullSafe(reps["rep_id"]) & (source["t1"] == reps["t1"]) & (source["t2"] == reps["t2"])
        return source.join(reps, same).select("text", *wanted.columns)

    def sets(self, wanted: DataFrame) -> DataFrame:
        """ckey, shingles of the classes in ``wanted`` (ckey), dealt by ckey, so that a join on it moves no set again."""
        width = self.width

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingle_set(t.as_py(), width).tobytes() for t in batch.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("ckey"), pa.array(found, pa.binary())], ["ckey", "shingles"])

        found = map_arrow(self.texts_of(wanted.select("ckey").distinct()), work, "ckey binary, shingles binary")
        return found.dropDuplicates(["ckey"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b: class keys, each pair once) that reach the threshold."""
        percent, least = self.percent, self.percent / 100 - SLACK

        def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for one, other in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                    x, y = np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4")
                    merged = np.sort(np.concatenate([x, y]))
                    twice = merged[1:] == merged[:-1]
                    union = len(merged) - int(twice.sum())
                    if len(x) == SKETCH or len(y) == SKETCH:  # only the smallest of the union are known
                        first = np.flatnonzero(np.concatenate([[True], ~twice]))
                        if len(first) > SKETCH:
                            twice = twice[: first[SKETCH] - 1]
                            union = SKETCH
                    keep.append(twice.sum() >= least * union)
                yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

        def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for one, other in zip(batch.column("xa"), batch.column("xb"), strict=True):
                    x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, other))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(similar(both, len(x), len(y), percent))
                yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

        sketches = self.classes.select("ckey", "sketch")
        near = pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        near = cut(map_arrow(near, estimate, "a binary, b binary"), "near")
        sets = self.sets(near.select(F.col("a").alias("ckey")).union(near.select("b")))
        full = near.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b").select("a", "b", "xa", "xb")
        return cut(map_arrow(full, confirm, "a binary, b binary"), "found")

    def shared(self, rows: DataFrame) -> DataFrame:
        """``rows`` (node, ckey, n) of nodes that several classes are in, with the node's smallest class and its size."""
        nodes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min(F.struct("ckey", "n")).alias("lead")).where("size > 1")
        return cut(rows.join(nodes, "node"), "shared")

    def open_nodes(self, shared: DataFrame, roots: DataFrame) -> DataFrame:
        """``shared`` rows of nodes whose classes are not yet in one component, with each class's component."""
        rooted = shared.select("node", "ckey", "n", "size").join(roots.withColumnRenamed("node", "ckey"), "ckey", "left").withColumn("root", F.coalesce("root", "ckey"))
        mixed = rooted.groupBy("node").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("node")
        return cut(rooted.join(mixed, "node"), "open")

    def branch(self, rows: DataFrame) -> DataFrame:
        """The next level below the nodes of ``rows``: node, ckey, n."""
        width, threshold = self.width, self.percent / 100

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                below, size = [], []
                for text, above in zip(batch.column("text").cast(pa.binary()), batch.column("above"), strict=True):
                    own = shingle_set(text.as_py(), width)
                    keys = _mix(np.array(above.as_py(), np.int64).view(np.uint64) + _STEP)
                    at, nodes = choose(own, keys, threshold)
                    below.append(np.unique(_mix(nodes ^ keys[at])).view(np.int64))
                    size.append(len(own))
                yield pa.RecordBatch.from_arrays([batch.column("ckey"), pa.array(size, pa.int64()), pa.array(below, pa.list_(pa.int64()))], ["ckey", "n", "nodes"])

        wanted = rows.groupBy("ckey").agg(F.collect_set("node").alias("above"))
        found = map_arrow(self.texts_of(wanted), work, "ckey binary, n long, nodes array<long>")
        return cut(found.select(F.explode("nodes").alias("node"), "ckey", "n").distinct(), "branch")

    def pairs_within(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components in the nodes of ``rows``, of sizes that could reach the threshold."""
        one = rows.select("node", F.col("ckey").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
        other = rows.select("node", F.col("ckey").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
        return one.join(other, "node").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _size_fits(F.col("na"), F.col("nb"), self.percent)).select("a", "b")

    def in_blocks(self, rows: DataFrame) -> DataFrame:
        """Links between different components in nodes that stay large, enough of them to join what belongs together.

        Classes of a node's largest component are never compared with each other. Blocks are bounded by shingles; a task
        holds two, and compares the classes of a block outside that component with each other too.
        """
        percent = self.percent
        by_root = rows.groupBy("node", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
        total = by_root.groupBy("node").agg(F.max(F.struct("c", "root", "s")).alias("main"), F.sum("s").alias("s"))
        blocks = lambda s: F.ceil(s / F.lit(float(BLOCK_SHINGLES))).cast("int")
        sized = total.select(
            "node", F.col("main.root").alias("main"), blocks(F.col("main.s")).alias("n_main"), F.greatest(F.lit(1), blocks(F.col("s") - F.col("main.s"))).alias("n_side")
        )
        draw = F.xxhash64("ckey")
        placed = rows.join(sized, "node").withColumn(
            "block", F.when(F.col("root") == F.col("main"), F.pmod(draw, "n_main")).otherwise(F.col("n_main") + F.pmod(draw, "n_side")).cast("int")
        )
        side = F.col("block") >= F.col("n_main")
        last = F.col("n_main") + F.col("n_side") - 1
        copies = placed.withColumn("with", F.explode(F.when(side, F.array_remove(F.sequence(F.lit(0).cast("int"), last), F.col("block"))).otherwise(F.sequence(F.col("n_main"), last))))
        tasks = copies.select("node", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "ckey", "root", side.alias("side"))
        full = tasks.join(self.sets(rows.select("ckey")), "ckey")

        def compare(group: pa.Table) -> pa.Table:
            keys, roots = group.column("ckey").to_pylist(), group.column("root").to_pylist()
            side = np.array(group.column("side").to_pylist(), bool)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
            size = np.array([len(x) for x in sets])
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            _, index = np.unique(np.concatenate(sets), return_inverse=True)
            member = {r: k for k, r in enumerate(dict.fromkeys(roots))}
            own = np.array([member[r] for r in roots])
            found: list[tuple[bytes, bytes]] = []
            has = np.zeros(int(index.max()) + 1, np.int32)
            for k in np.flatnonzero(side):
                mine = index[start[k] : start[k] + size[k]]
                has[mine] = 1
                both = np.add.reduceat(has[index], start)
                has[mine] = 0
                near = np.flatnonzero((100 * both >= percent * (size + size[k] - both)) & (own != own[k]))
                for j in near:
                    if own[j] != own[k]:
                        found.append((keys[k], keys[j]))
                        own[own == own[j]] = own[k]
            return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

        return cut(full.groupBy("node", "x", "y").applyInArrow(compare, "a binary, b binary"), "found")

    def rooted(self) -> DataFrame:
        """ckey, least (smallest doc_id), root (the component's smallest class key) of every class."""
        roots = self.linked().withColumnRenamed("node", "ckey")
        return cut(self.classes.select("ckey", "least").join(roots, "ckey", "left").withColumn("root", F.coalesce("root", "ckey")), "rooted")

    def linked(self) -> DataFrame:
        """node, root: class keys of all classes that have a link."""
        shared = self.shared(self.classes.select(F.explode("nodes").alias("node"), "ckey", "n"))
        lead = F.col("lead.ckey")
        stars = shared.where((lead != F.col("ckey")) & _size_fits(F.col("n"), F.col("lead.n"), self.percent)).select(lead.alias("a"), F.col("ckey").alias("b")).distinct()
        found = self.links(stars)
        roots = cut(components(found), "roots")
        pairs = None
        for level in range(1, self.levels + 1):
            rest = self.open_nodes(shared, roots)
            few = self.pairs_within(rest.where(F.col("size") <= self.node))
            pairs = few if pairs is None else pairs.union(few)
            large = rest.where(F.col("size") > self.node)
            if large.isEmpty():
                break
            if level == self.levels:
                found = found.union(self.in_blocks(large))
            else:
                shared = self.shared(self.branch(large))
        found = found.union(self.links(pairs.distinct()))
        return components(found)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, trees: int = TREES, node: int = NODE, levels: int = LEVELS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Rows are linked where 100 * shared shingles >= ``percent`` * shingles of either. component_id is the smallest doc_id
    that can be reached over links; kept is true where that is the row's own. A null or empty text, or one of white
    space, has no shingles and is its own component. Repeated rows are copies of each other and each get their row. A
    null doc_id counts only where a component has no other id; its component_id is null then, and kept is true. Texts
    of any length are taken whole. Other columns are left out; an empty table gives no rows.
    """
    join = _Join(docs, width, percent, trees, node, levels)
    rooted = join.rooted()
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(of_root, "root").select("ckey", "component_id")
    out = join.rows.select("doc_id", F.col("n").alias("n_shingles"), "ckey").join(by_class, "ckey", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each group the row with the smallest doc_id stays (a null id comes last, ties
    go by the text's hash), of rows that repeat id and text one.

    All columns are kept, of any name. Rows without words are in no group and all stay.
    """
    join = _Join(docs, width, percent, TREES, NODE, LEVELS)
    rows = join.rows.where("n > 0").join(join.rooted().select("ckey", "root"), "ckey")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "t1", "t2")
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    gone = rows.join(first, "root").where(~order.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("gone_id"), "t1", "t2").distinct()
    gone = cut(gone, "gone")
    t1, t2 = text_key(F.col("text").cast("string"))
    own = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (t1 == gone["t1"]) & (t2 == gone["t2"])
    left = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, own, "left_anti")
    again = join.rows.where("n > 0").groupBy(F.col("doc_id").alias("again_id"), "t1", "t2").count().where("count > 1").drop("count")
    if again.isEmpty():
        return left
    same = docs["doc_id"].eqNullSafe(again["again_id"]) & (t1 == again["t1"]) & (t2 == again["t2"])
    return left.join(again, same, "left_anti").union(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


#: The groups as DuckDB SQL, for shingles of four words and a similarity of 0.8.
GROUPS_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') g FROM w, unnest(range(1, greatest(2, len(w) - 2))) u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
both_sets AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM both_sets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id r FROM w UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
least_id AS (SELECT doc_id, min(r) component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, component_id, w.doc_id = component_id kept
FROM w JOIN least_id USING (doc_id) LEFT JOIN n USING (doc_id)
"""
