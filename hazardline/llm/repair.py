"""Conversation repair at least cost: a Viterbi recursion over the rows, run in parallel by rank convergence.

The cheapest edits of a conversation are a shortest path through four states (nothing yet, after system, user, assistant).
From its end backwards, a vector holds the least cost to go from each state; every row maps one vector to the next by sums
and minima. A long conversation is cut into chunks. All but the last do not know the vector they start from, so each begins
with a guess, the vector of a conversation's end. Such maps lose rank fast: from different starts the vectors soon differ by
a constant only, which no choice depends on. Fix-up passes hand each chunk the vector its successor ended with; the chunk runs
again from its end until its vector and the old one differ by a constant, where all before stays right. Passes go on until
no chunk's start has changed. In pass ``k`` one task follows a change through up to ``GROWTH ** k`` chunks, so that even
conversations that never lose rank (rows that are all deleted) need logarithmically many passes.

Then the stitched costs drive the trace: every chunk finds, from each state it could be entered in, the state it is left in;
the entries follow chunk by chunk, and each chunk writes the ASCII-least of its cheapest edits.

A chunk is a short row of codes, one byte a row; texts take no part in any pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardline.llm.common import cut, map_arrow
from hazardline.operators.scans import KeySizes, following, measure_keys, ordered_scan, position

#: Rows of a chunk.
CHUNK = 4096
#: Times more chunks that one task may follow in each further fix-up pass.
GROWTH = 8

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States: nothing yet, after system, after user, after assistant. A conversation may end in the first and the last.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEPT = {  # state and initial of a kept row to the next state
    (_NONE, "s"): _SYSTEM, (_NONE, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER,
}
_WRITTEN = (_USER, _USER, _ASSISTANT, _USER)  # the state after an inserted or re-roled row
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}

Vector = tuple[int, int, int, int]

#: Codes of a row: D must be deleted; s, u, a, o (other) is its role's initial, upper case where it is truncated.
MUST_GO = "D"


def _closed(costs: list[int]) -> Vector:
    """With insertions before the row: from a state to the next at ``INSERT``, any number of times."""
    for _ in range(3):
        for q in range(4):
            costs[q] = min(costs[q], INSERT + costs[_WRITTEN[q]])
    return costs[0], costs[1], costs[2], costs[3]


#: Costs to go at the end of a conversation.
END: Vector = _closed([0, 1 << 30, 1 << 30, 0])


def _options(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in a state as initial, cost and next state, by initial."""
    yield "D", DELETE, state
    if code != MUST_GO:
        extra = TRUNCATED if code.isupper() else 0
        after = _KEPT.get((state, code.lower()))
        if after is not None:
            yield "K", KEEP + extra, after
        yield "R", REROLE + extra, _WRITTEN[state]


_STEPS: dict[tuple[str, Vector], tuple[Vector, int]] = {}


def step(code: str, after: Vector) -> tuple[Vector, int]:
    """The vector before a row from a normal one after it (least cost 0), normal again, and the constant taken off.

    Costs to go lie within two insertions of each other, so there are few normal vectors, and each step is remembered.
    """
    found = _STEPS.get((code, after))
    if found is None:
        costs = _closed([min(cost + after[to] for _, cost, to in _options(code, q)) for q in range(4)])
        low = min(costs)
        found = _STEPS[code, after] = (tuple(c - low for c in costs), low)
    return found


def run_back(codes: str, end: Vector) -> tuple[Vector, int]:
    """The normal vector before a chunk from the one after it, and the constants taken off together."""
    total = 0
    for code in reversed(codes):
        end, low = step(code, end)
        total += low
    return end, total


def fix_up(codes: str, old_end: Vector, new_end: Vector, start: Vector) -> Vector:
    """The chunk's start vector from ``new_end``, where ``start`` is that from ``old_end``: runs until the two meet."""
    old, new = old_end, new_end
    for code in reversed(codes):
        if old == new:
            return start
        old, new = step(code, old)[0], step(code, new)[0]
    return new


def vectors(codes: str, end: Vector) -> list[Vector]:
    """Normal vectors before each row of a chunk and after its last."""
    out = [end]
    for code in reversed(codes):
        end, _ = step(code, end)
        out.append(end)
    out.reverse()
    return out


def trace(codes: str, to_go: list[Vector], state: int, last: bool) -> tuple[int, str, list[str]]:
    """The ASCII-least of the cheapest edits of a chunk entered in ``state``: the state it is left in, the edits' initials and,
    per edit, the role of the row it writes (empty: none, ``=``: the row's own). ``last``: the conversation ends here, so what
    has to be inserted at its end is too. Insertions between two chunks belong to the later one.
    """
    edits, roles = [], []
    for i, code in enumerate(codes):
        now, then = to_go[i], to_go[i + 1]
        low = step(code, then)[1]
        while True:
            choices = [(e, cost + then[to] - low, to) for e, cost, to in _options(code, state)]
            choices.append(("I", INSERT + now[_WRITTEN[state]], _WRITTEN[state]))
            edit, _, to = min(c for c in choices if c[1] == now[state])
            edits.append(edit)
            roles.append("" if edit == "D" else "=" if edit == "K" else _ROLE[to])
            state = to
            if edit != "I":
                break
    while last and state in (_SYSTEM, _USER):
        state = _WRITTEN[state]
        edits.append("I")
        roles.append(_ROLE[state])
    return state, "".join(edits), roles


# ---------------------------------------------------------------- damage and faults


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after planted faults, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats it (``copies`` is 2), 4 makes its role user.
    In the key and in role and text a null is one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), h.alias("h")).where("h <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("h") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def as_rows(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form of :func:`damage`."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", text("role"), text("text"), F.lit(1).cast("long").alias("copies"))


def _initial() -> Column:
    return F.substring("role", 1, 1)


def classify(rows: DataFrame, sizes: KeySizes) -> DataFrame:
    """One row per distinct row of a conversation, in its order: conv_id, turn, role, text, copies, place (from 1), fault (of
    the first copy: blank, duplicate, truncated or null), code (see ``MUST_GO``) and illegal (adjacent initials that may not
    follow each other, from this row to the next and inside its copies).

    The order is by turn (nulls first), then role, then text. A later copy of a row is always a duplicate, or blank.
    """
    keyed = rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(3), "role", "text").alias("h2"))
    distinct = keyed.groupBy("conv_id", "turn", "h1", "h2").agg(
        F.first("role").alias("role"), F.first("text").alias("text"), F.sum("copies").alias("copies")
    )
    # the first place of a role and text is one row, so the join back has one row a key on either side
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = keyed.groupBy(F.col("conv_id").alias("c_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_")).agg(F.min(turn).alias("first"))
    same = (
        F.col("conv_id").eqNullSafe(F.col("c_")) & F.col("turn").eqNullSafe(F.col("first.turn"))
        & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_"))
    )
    marked = distinct.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", F.col("first").isNull().alias("seen"), F.col("turn").isNotNull().alias("known")
    )
    ordered = ordered_scan(
        marked.withColumn("initial", _initial()), ["conv_id"], ["known", "turn", "role", "text"],
        {"place": position(), "then": following("initial")}, sizes=sizes,
    )
    tail = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    blank, truncated = tail == "", ~tail.isin(".", "!", "?")
    fault = F.when(blank, "blank").when(F.col("seen"), "duplicate").when(truncated, "truncated")
    code = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    legal = lambda a, b: F.concat(a, b).isin("su", "ua", "au")
    within = F.when(legal(F.col("initial"), F.col("initial")), 0).otherwise(F.col("copies") - 1)
    across = F.when(F.col("then").isNull() | legal(F.col("initial"), F.col("then")), 0).otherwise(1)
    return ordered.select(
        "conv_id", "turn", "role", "text", "copies", "place", fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), MUST_GO).when(truncated, F.upper(code)).otherwise(code).alias("code"),
        (within + across).cast("long").alias("illegal"),
    )


# ---------------------------------------------------------------- parallel Viterbi


def _chunks(classified: DataFrame) -> DataFrame:
    """conv_id, chunk, codes, n, end, start: the rows of each chunk as codes, with the start vector from a guessed end."""
    packed = (
        classified.groupBy("conv_id", F.floor((F.col("place") - 1) / CHUNK).alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("rows"))
        .select("conv_id", "chunk", F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [run_back(c, END)[0] for c in batch.column("codes").to_pylist()]
            end = pa.array([END] * batch.num_rows, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, end, pa.array(starts, pa.list_(pa.int32()))], [*batch.schema.names, "end", "start"])

    return map_arrow(packed, work, _schema(packed) + ", end array<int>, start array<int>")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _pass(chunks: DataFrame, reach: int) -> DataFrame:
    """One fix-up pass: ``next`` is the successor's start vector; a changed end is followed through up to ``reach`` chunks.

    A task reads a group's chunks from the last to the first, one at a time, and holds one vector.
    """
    grouped = chunks.withColumn("group", F.floor(F.col("chunk") / reach))
    dealt = grouped.repartition("conv_id", "group").sortWithinPartitions("conv_id", "group", F.desc("chunk"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, vector = object(), END
        for batch in batches:
            ends, starts = [], []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "group", "codes", "end", "start", "next")]
            for conv, number, codes, end, start, following_start in zip(*columns, strict=True):
                if (conv, number) != group:  # the group's last chunk takes what its successor had before this pass
                    group, vector = (conv, number), tuple(following_start) if following_start is not None else END
                old, begun = tuple(end), tuple(start)
                ends.append(vector)
                vector = fix_up(codes, old, vector, begun)
                starts.append(vector)
            kind = pa.list_(pa.int32())
            kept = [batch.column(c) for c in ("conv_id", "chunk", "codes")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ends, kind), pa.array(starts, kind)], ["conv_id", "chunk", "codes", "end", "start"])

    return map_arrow(dealt, work, _schema(chunks.select("conv_id", "chunk", "codes", "end", "start")))


def converge(chunks: DataFrame, sizes: KeySizes) -> DataFrame:
    """The chunks with their true end vectors. Conversations of one chunk are done from the start, and stay out of the passes."""
    settled = cut(chunks, "repair-chunks")
    several = settled.where("chunk = 1").select(F.col("conv_id").alias("c_"))
    here = F.col("conv_id").eqNullSafe(F.col("c_"))
    long = cut(settled.join(several, here, "left_semi"), "repair-long")
    reach = 1
    while True:
        linked = ordered_scan(long, ["conv_id"], ["chunk"], {"next": following("start")}, sizes=sizes)
        if linked.where("next IS NOT NULL AND next <> end").isEmpty():
            break
        long = cut(_pass(linked, reach), "repair-long")
        reach *= GROWTH
    return settled.join(several, here, "left_anti").unionByName(long)


def _exits(chunks: DataFrame, sizes: KeySizes) -> DataFrame:
    """The chunks with ``entry``, the state each is entered in.

    A chunk's exits from all four states are a map of states to states; the entry of a chunk is what the maps before it make
    of the first state. Chunks of one conversation are composed in blocks, block by block, as a running scan would.
    """
    last = ordered_scan(chunks, ["conv_id"], ["chunk"], {"after": following("chunk")}, sizes=sizes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            columns = [batch.column(c).to_pylist() for c in ("chunk", "codes", "end", "after")]
            for number, codes, end, after in zip(*columns, strict=True):
                if number == 0 and after is None:
                    maps.append(None)  # a conversation of one chunk is entered in the first state
                    continue
                to_go = vectors(codes, tuple(end))
                maps.append([trace(codes, to_go, q, False)[0] for q in range(4)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maps, pa.list_(pa.int32()))], [*batch.schema.names, "exits"])

    return map_arrow(last, work, _schema(last) + ", exits array<int>")


def _compose(first: Column, then: Column) -> Column:
    return F.transform(first, lambda s: F.get(then, s))


def entries(chunks: DataFrame, sizes: KeySizes) -> DataFrame:
    """conv_id, chunk, codes, end, after (null for the last chunk) and entry.

    Doubling: in round ``k`` a chunk's map over the ``2 ** k`` chunks before it is joined with the one before those, so a
    conversation of n chunks takes log n rounds, of one row a chunk, and no task holds a conversation.
    """
    mapped = cut(_exits(chunks, sizes), "repair-exits")
    alone = mapped.where("exits IS NULL").select("conv_id", "chunk", "codes", "end", "after", F.lit(_NONE).alias("entry"))
    scan = mapped.where("exits IS NOT NULL").select("conv_id", "chunk", F.col("exits").alias("before"))
    reach, longest = 1, scan.agg(F.max("chunk")).first()[0] or 0
    while reach <= longest:
        left = scan.select(F.col("conv_id").alias("c_"), (F.col("chunk") + reach).alias("to_"), F.col("before").alias("left_"))
        both = scan.join(left, scan["conv_id"].eqNullSafe(left["c_"]) & (scan["chunk"] == left["to_"]), "left")
        joined = F.when(F.col("left_").isNull(), F.col("before")).otherwise(_compose(F.col("left_"), F.col("before")))
        scan = cut(both.select("conv_id", "chunk", joined.alias("before")), "repair-entries")
        reach *= 2
    entered = scan.select(F.col("conv_id").alias("c_"), (F.col("chunk") + 1).alias("to_"), F.get("before", F.lit(_NONE)).alias("entry"))
    rest = mapped.where("exits IS NOT NULL")
    here = rest["conv_id"].eqNullSafe(entered["c_"]) & (rest["chunk"] == entered["to_"])
    several = rest.join(entered, here, "left").select(
        "conv_id", "chunk", "codes", "end", "after", F.coalesce("entry", F.lit(_NONE)).alias("entry")
    )
    return alone.unionByName(several)


def _edits(chunks: DataFrame) -> DataFrame:
    """conv_id, chunk, row (its number in the chunk, from 0), before (roles inserted before it), edit, role, and for the last
    row of a conversation behind (roles inserted after it)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("at", pa.int64()), ("before", pa.list_(pa.string())), ("edit", pa.string()), ("role", pa.string()),
            ("behind", pa.list_(pa.string())),
        ])
        for batch in batches:
            where, made = [], []

            def rows(of: pa.RecordBatch) -> pa.RecordBatch:
                at = pa.array(where, pa.int64())
                out = pa.RecordBatch.from_pylist(made, schema)
                where.clear()
                made.clear()
                return pa.RecordBatch.from_arrays(
                    [of.column("conv_id").take(at), of.column("chunk").take(at), *out.columns], ["conv_id", "chunk", *schema.names]
                )

            columns = [batch.column(c).to_pylist() for c in ("codes", "end", "after", "entry")]
            for k, (codes, end, after, entry) in enumerate(zip(*columns, strict=True)):
                _, edits, roles = trace(codes, vectors(codes, tuple(end)), entry, after is None)
                row, waiting = 0, []
                for edit, role in zip(edits, roles, strict=True):
                    if edit == "I":
                        waiting.append(role)
                        continue
                    where.append(k)
                    made.append({"at": row, "before": waiting, "edit": edit, "role": role, "behind": []})
                    row, waiting = row + 1, []
                if waiting:
                    made[-1]["behind"] = waiting
                if len(made) >= 20_000:
                    yield rows(batch)
            if made:
                yield rows(batch)

    kind = dict(chunks.dtypes)["conv_id"]
    return map_arrow(
        chunks, work, f"conv_id {kind}, chunk long, at long, before array<string>, edit string, role string, behind array<string>"
    )


def repair(rows: DataFrame, sizes: KeySizes | None = None) -> DataFrame:
    """The rows of :func:`classify` with the cheapest edits: edit (D, K or R, of the first copy; later copies are deleted),
    new_role (null: deleted), before and behind (roles of the empty rows inserted around it).

    ``rows`` are those of :func:`damage` or :func:`as_rows`. A conversation is mended so that its role initials read
    ``(s?(ua)+)?``; of the cheapest edits the ASCII-least are taken (D < I < K < R). Initials are the first characters of
    roles; a role without characters can't be kept. A null conv_id is a conversation like others; null turns come first.
    Rows that tie on turn are ordered by role and text, repeated rows are copies of one. Very long texts are one row each and
    are not looked at again; a conversation of any length is cut into chunks. An empty table gives no rows. Extra columns
    are dropped before.
    """
    sizes = sizes or measure_keys(rows.select("conv_id"), ["conv_id"])
    classified = cut(classify(rows, sizes), "repair-rows")
    edits = _edits(entries(converge(_chunks(classified), sizes), sizes))
    edits = edits.select(
        F.col("conv_id").alias("c_"), (F.col("chunk") * CHUNK + F.col("at") + 1).alias("p_"), "before", "edit", F.col("role").alias("r_"), "behind"
    )
    here = F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("place") == F.col("p_"))
    new_role = F.when(F.col("r_") == "=", F.col("role")).when(F.col("r_") != "", F.col("r_"))
    return classified.join(edits, here).select(
        "conv_id", "turn", "role", "text", "copies", "place", "fault", "illegal", "edit", new_role.alias("new_role"), "before", "behind"
    )


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: conv_id, gaps, blank, duplicate, truncated, illegal, cost.

    Sums only, combined before the shuffle.
    """
    fault = F.col("fault")
    copies = F.col("copies")
    blank = F.when(fault == "blank", copies).otherwise(0)
    duplicate = F.when(fault == "duplicate", copies).when(fault == "blank", 0).otherwise(copies - 1)
    kept_truncated = F.when((fault == "truncated") & (F.col("edit") != "D"), TRUNCATED).otherwise(0)
    own = F.when(F.col("edit") == "D", DELETE).when(F.col("edit") == "R", REROLE).otherwise(KEEP)
    inserted = F.size("before") + F.size("behind")
    sums = repaired.groupBy("conv_id", "turn").agg(  # a turn counts once
        F.sum(blank).alias("blank"), F.sum(duplicate).alias("duplicate"), F.sum(F.when(fault == "truncated", 1).otherwise(0)).alias("truncated"),
        F.sum("illegal").alias("illegal"), F.sum(own + kept_truncated + INSERT * inserted + DELETE * (copies - 1)).alias("cost"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counts = [F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return sums.groupBy("conv_id").agg(gaps.alias("gaps"), *counts)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 per conversation of :func:`repair`.

    A digest of a conversation is a chain over all its text, and its audit one value, so a conversation's rows pass through
    one task here, sorted on disk and one at a time; nothing but the audit and the state of the digest is held.
    """
    # a row's edits and lines: inserted ones before it, itself, its deleted copies, inserted ones behind it
    line = F.when(F.col("new_role").isNotNull(), F.concat("new_role", F.lit(":"), "text"))
    slim = repaired.select("conv_id", "place", "copies", "edit", "before", "behind", line.alias("line"))
    dealt = slim.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    kind = dict(repaired.dtypes)["conv_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, audit, digest, begun = None, [], None, False
        done: list[tuple] = []
        id_type = None

        def add(text: str) -> None:
            nonlocal begun
            digest.update(("\n" if begun else "").encode() + text.encode())
            begun = True

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["conv_id", "audit", "repaired_sha256"],
            )

        for batch in batches:
            id_type = batch.column("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "copies", "edit", "before", "behind", "line")]
            for conv, copies, edit, before, behind, text in zip(*columns, strict=True):
                if digest is None or conv != held:
                    if digest is not None:
                        done.append((held, "".join(audit), digest.hexdigest()))
                    held, audit, digest, begun = conv, [], hashlib.sha256(), False
                for role in before:
                    audit.append("I")
                    add(f"{role}:")
                audit.append(edit)
                if text is not None:
                    add(text)
                audit.append("D" * (copies - 1))
                for role in behind:
                    audit.append("I")
                    add(f"{role}:")
            if len(done) >= 10_000:
                yield batch_of()
        if digest is not None:
            done.append((held, "".join(audit), digest.hexdigest()))
        if done:
            yield batch_of()

    return map_arrow(dealt, work, f"conv_id {kind}, audit string, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """Per original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of the repaired rows
    (``role:text``, joined by line feeds), after :func:`damage`. A conversation without rows after damage has zeros, an empty
    audit and the digest of the empty text."""
    sizes = measure_keys(conversations.select("conv_id"), ["conv_id"])
    repaired = cut(repair(damage(conversations), sizes), "repair-edits")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select("conv_id").distinct()
    one = summary(repaired).withColumnRenamed("conv_id", "s_")
    two = digests(repaired).withColumnRenamed("conv_id", "d_")
    joined = ids.join(one, ids["conv_id"].eqNullSafe(one["s_"]), "left").join(two, ids["conv_id"].eqNullSafe(two["d_"]), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def report_sql() -> str:
    """The report as DuckDB SQL: the recursion over whole conversations, one row after the other."""
    end = "e: {c: 0, a: '', t: ''}, s: {c: 10, a: 'II', t: 'user:' || chr(10) || 'assistant:' || chr(10)}"
    end += ", u: {c: 5, a: 'I', t: 'assistant:' || chr(10)}, v: {c: 0, a: '', t: ''}"  # v: after assistant
    written = {"e": ("u", "user"), "s": ("u", "user"), "u": ("v", "assistant"), "v": ("u", "user")}
    kept = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("u", "a"): "v", ("v", "u"): "u"}
    on = lambda x, cost, edit, line="''": f"{{c: {x}.c + {cost}, a: '{edit}' || {x}.a, t: {line} || {x}.t}}"

    def moved(q: str) -> str:
        more, to = "(CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END)", written[q]
        ways = [f"[{on(f'b.x.{q}', 2, 'D')}]"]
        own, new = "r.role || ':' || r.text || chr(10)", f"'{to[1]}:' || r.text || chr(10)"
        free = "r.fault IN ('blank', 'duplicate')"
        ways.append(f"CASE WHEN {free} THEN [] ELSE [{on(f'b.x.{to[0]}', f'1 + {more}', 'R', new)}] END")
        for (state, initial), after in kept.items():
            if state == q:
                ways.append(f"CASE WHEN {free} OR left(r.role, 1) <> '{initial}' THEN [] ELSE [{on(f'b.x.{after}', more, 'K', own)}] END")
        return f"list_sort({' || '.join(ways)})[1]"

    def closed(q: str) -> str:
        ways, state, cost, edits, lines = [], q, 0, "", "''"
        for _ in range(4):
            ways.append(on(f"m.{state}", cost, edits, lines))
            state, role = written[state]
            cost, edits, lines = cost + 5, edits + "I", f"{lines} || '{role}:' || chr(10)"
        return f"list_sort([{', '.join(ways)}])[1]"

    states = "esuv"
    return f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS tab),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)) AS bytes FROM conversations),
hashed AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, d: xor(c >> 8, tab[(xor(c, d) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS h FROM keyed, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS tail FROM damaged),
r AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS pair FROM placed),
counts AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
b AS (SELECT conv_id, n AS i, {{{end}}} AS x FROM counts
  UNION ALL
  SELECT conv_id, i, {{{', '.join(f'{q}: {closed(q)}' for q in states)}}} FROM (
    SELECT b.conv_id, b.i - 1 AS i, {{{', '.join(f'{q}: {moved(q)}' for q in states)}}} AS m
    FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i) q)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(b.x.e.c, 0) AS BIGINT) AS cost, coalesce(b.x.e.a, '') AS audit,
  sha256(coalesce(CASE WHEN b.x.e.t = '' THEN '' ELSE left(b.x.e.t, length(b.x.e.t) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 0
"""
