"""Conversations damaged, judged and repaired by the cheapest edits, the least audit of equals.

A repaired conversation is empty, or an optional system turn and then pairs of user and
assistant turns. The states (nothing yet, system, user, assistant) before each row are the
nodes of a graph, the edits its arcs: Keep, Rerole and Delete lead past the row, Insert stays
before it. Costs to the end are found from the last row back. Arcs that keep to that cost are
the optimal ones, and the least audit (the edits' initials) follows the least of them at each
node: a node's arcs have different initials, so prefixes of length one rank them, and equal
prefixes never part. Paths are then laid out by pointers over 1, 2, 4, ... arcs.

Rows are sorted by conversation, turn and content over all tasks, so a conversation that is a
third of all rows is spread. Conversations that lie within a partition are finished there.
The first and last one of each partition are blocks: every block gives a matrix of costs
between states, these are combined (one row for each partition a conversation reaches), and
the blocks are walked again with what follows, then with what precedes them. Only the digest
of a repaired conversation is taken from end to end in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm.tables import written

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where Rerole and Insert lead: to a user turn, or after one to an assistant turn.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: By initial (s, u, a, other) and state: where Keep leads; -1: nowhere.
_KEEP = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
_END, _DELETE, _INSERT, _KEPT, _REROLE = range(5)
#: In the order of the letters, by which audits are compared.
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
_FAR = 1 << 50
#: Characters of role and text that sort the rows of one turn, before their digest.
PREFIX = 64

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = "conv STRING, " + ", ".join(f"{c} BIGINT" for c in COUNTS) + ", audit STRING, repaired_sha256 STRING"
ROW = "part INT, pos BIGINT, dropped BOOLEAN, turn BIGINT, initial INT, fault INT, digest BINARY, role STRING, text STRING"


def damaged(rows: DataFrame) -> DataFrame:
    """`conv, turn, role, text, dropped, initial, fault, digest` of the rows after damage.

    Dropped rows stay, marked and without content, so that their conversation is known. `fault`
    is blank, truncated or none; duplicates are found later, by `digest`. `conv` is the id as text
    behind a mark, empty for null.
    """
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    remainder = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    role = F.when(remainder == 4, "user").otherwise(known("role"))
    text = F.when(remainder == 1, "").when(remainder == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    copies = F.when(remainder == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(remainder != 0, role).otherwise("").alias("role"),
        F.when(remainder != 0, text).otherwise("").alias("text"),
        (remainder == 0).alias("dropped"), F.explode(copies).alias("copy"),
    ).drop("copy")
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(TRUNCATED)
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return kept.select(
        "conv", "turn", "role", "text", "dropped",
        F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial).cast("int").alias("initial"),
        fault.cast("int").alias("fault"), F.unhex(F.sha2(whole, 256)).alias("digest"),
    )


def costs_back(initial: np.ndarray, fault: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end `[conversation, row, ..., state]`, given those `after` the last row.

    All conversations have the same number of rows; `after` may have more dimensions between
    conversation and state.
    """
    n, length = initial.shape
    out = np.empty((n, length + 1, *after.shape[1:]), np.int64)
    out[:, length] = after
    extra_axes = (1,) * (after.ndim - 2)
    for i in range(length - 1, -1, -1):
        then = out[:, i + 1]
        barred = (fault[:, i] == BLANK) | (fault[:, i] == DUPLICATE)
        extra = np.where(barred, _FAR, np.where(fault[:, i] == TRUNCATED, TRUNCATED_COST, 0)).reshape(n, *extra_axes, 1)
        target = _KEEP[initial[:, i]].reshape(n, *extra_axes, 4)
        kept = np.take_along_axis(then, np.broadcast_to(np.maximum(target, 0), then.shape), -1)
        best = np.minimum(then + DELETE_COST, np.where(target >= 0, kept + KEEP_COST + extra, _FAR))
        best = np.minimum(best, then[..., _NEXT] + REROLE_COST + extra)
        user = np.minimum(best[..., USER], best[..., ASSISTANT] + INSERT_COST)
        assistant = np.minimum(best[..., ASSISTANT], best[..., USER] + INSERT_COST)
        out[:, i, ..., USER], out[:, i, ..., ASSISTANT] = user, assistant
        for state in (START, SYSTEM):
            out[:, i, ..., state] = np.minimum(best[..., state], user + INSERT_COST)
    return np.minimum(out, _FAR)


#: After the last row: nothing to do, or the turns that are still needed.
CLOSING = np.array([0, 2 * INSERT_COST, INSERT_COST, 0], np.int64)


def least_arcs(initial: np.ndarray, fault: np.ndarray, costs: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edit and next node of the least optimal arc of every node; nodes are `4 * row + state`."""
    n, length = initial.shape
    edit = np.zeros((n, length + 1, 4), np.int64)
    to = np.broadcast_to(np.arange(4 * (length + 1)).reshape(length + 1, 4), edit.shape).copy()
    here, then = costs[:, :-1], costs[:, 1:]
    row = 4 * np.arange(length + 1).reshape(1, -1, 1)
    barred = ((fault == BLANK) | (fault == DUPLICATE))[..., None]
    extra = np.where(fault == TRUNCATED, TRUNCATED_COST, 0)[..., None]
    target = _KEEP[initial]
    kept = np.take_along_axis(then, np.maximum(target, 0), -1)
    # From the greatest letter to the least, each taking the place of the one before.
    arcs = [
        (_REROLE, ~barred & (here == then[..., _NEXT] + REROLE_COST + extra), row[:, 1:] + _NEXT),
        (_KEPT, ~barred & (target >= 0) & (here == kept + KEEP_COST + extra), row[:, 1:] + target),
        (_INSERT, here == here[..., _NEXT] + INSERT_COST, row[:, :-1] + _NEXT),
        (_DELETE, here == then + DELETE_COST, row[:, 1:] + np.arange(4)),
    ]
    for letter, optimal, ends in arcs:
        edit[:, :-1][optimal] = letter
        to[:, :-1][optimal] = np.broadcast_to(ends, optimal.shape)[optimal]
    if last:
        for state in (SYSTEM, USER):
            edit[:, -1, state], to[:, -1, state] = _INSERT, 4 * length + _NEXT[state]
    return edit.reshape(n, -1), to.reshape(n, -1)


def paths(edit: np.ndarray, to: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Nodes on the way from `start` to an end, by pointers of doubled length; ends repeat."""
    found = start[:, None]
    while np.take_along_axis(edit, found[:, -1:], 1).any():
        # `to` leads as many arcs on as `found` has nodes.
        found = np.concatenate([found, np.take_along_axis(to, found, 1)], 1)
        to = np.take_along_axis(to, to, 1)
    return found


def audits(edit: np.ndarray, nodes: np.ndarray) -> list[str]:
    letters = _LETTERS[np.take_along_axis(edit, nodes, 1)]
    return [row.tobytes().rstrip(b"\0").decode() for row in letters]


def repaired(edit: np.ndarray, to: np.ndarray, nodes: np.ndarray, roles: list[str], texts: list[str]) -> list[str]:
    """The turns that a path leaves, as `role:text`."""
    turns = []
    for node in nodes.tolist():
        done = edit[node]
        if done == _END:
            break
        if done == _DELETE:
            continue
        name = roles[node >> 2] if done == _KEPT else _NAMES[int(to[node]) & 3]
        turns.append(f"{name}:{'' if done == _INSERT else texts[node >> 2]}")
    return turns


def gaps(turns: np.ndarray) -> int:
    return int(turns.max() - turns.min() + 1 - len(np.unique(turns))) if len(turns) else 0


def illegal(initial: np.ndarray) -> np.ndarray:
    """Whether each row but the first follows the one before it as no repaired turn may."""
    a, b = initial[:-1], initial[1:]
    return ~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))


def _with_duplicates(conv: np.ndarray, fault: np.ndarray, digest: pa.Array) -> np.ndarray:
    """Faults with those rows marked that equal an earlier one of their conversation."""
    codes = digest.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first = np.unique(conv * (len(codes) + 1) + codes, return_index=True)
    again = np.ones(len(codes), bool)
    again[first] = False
    return np.where(again & (fault != BLANK), DUPLICATE, fault)


def _utf8(column: pa.Array) -> list[str]:
    return [value.decode("utf-8", "replace") for value in column.cast(pa.binary()).to_pylist()]


def judged(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Results of whole conversations, which lie one after the other in `rows`."""
    names, place = np.unique(rows.column("conv").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    own = rows.filter(pa.compute.invert(rows.column("dropped")))
    conv = place[~rows.column("dropped").to_numpy(zero_copy_only=False)]
    initial, fault = (own.column(c).to_numpy(zero_copy_only=False) for c in ("initial", "fault"))
    fault = _with_duplicates(conv, fault, own.column("digest"))
    sizes = np.bincount(conv, minlength=len(names))
    order = np.argsort(conv, kind="stable")
    begin = np.cumsum(sizes) - sizes
    roles, texts = _utf8(own.column("role")), _utf8(own.column("text"))
    turn = own.column("turn")
    has_turn = turn.is_valid().to_numpy(zero_copy_only=False)
    turns = pa.compute.fill_null(turn, 0).to_numpy(zero_copy_only=False)
    found: dict[str, list] = {c: [0] * len(names) for c in COUNTS} | {"audit": [""] * len(names)}
    digests = [hashlib.sha256(b"").hexdigest()] * len(names)
    for size in np.unique(sizes[sizes > 0]).tolist():
        which = np.flatnonzero(sizes == size)
        at = order[begin[which][:, None] + np.arange(size)]
        i, f = initial[at], fault[at]
        costs = costs_back(i, f, np.broadcast_to(CLOSING, (len(which), 4)))
        edit, to = least_arcs(i, f, costs, True)
        nodes = paths(edit, to, np.full(len(which), START))
        for k, (c, audit) in enumerate(zip(which.tolist(), audits(edit, nodes), strict=True)):
            rows_of = at[k]
            found["gaps"][c] = gaps(turns[rows_of][has_turn[rows_of]])
            for fault_name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
                found[fault_name][c] = int((f[k] == code).sum())
            found["illegal"][c] = int(illegal(i[k]).sum())
            found["cost"][c], found["audit"][c] = int(costs[k, 0, START]), audit
            left = repaired(edit[k], to[k], nodes[k], [roles[r] for r in rows_of], [texts[r] for r in rows_of])
            digests[c] = hashlib.sha256("\n".join(left).encode()).hexdigest()
    return pa.RecordBatch.from_arrays(
        [pa.array(names.tolist(), pa.string()), *(pa.array(found[c], pa.int64()) for c in COUNTS),
         pa.array(found["audit"], pa.string()), pa.array(digests, pa.string())],
        ["conv", *COUNTS, "audit", "repaired_sha256"],
    )


def _apart(rows: DataFrame) -> DataFrame:
    """Finished conversations of each sorted partition, and the rows of its first and last one."""
    result, row = RESULT.split(", "), ROW.split(", ")
    names = [c.split(" ")[0] for c in [*result, *row]]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}

        def shaped(found: pa.RecordBatch) -> pa.RecordBatch:
            columns = [
                found.column(n) if n in found.schema.names else pa.nulls(found.num_rows, kinds[n]) for n in names
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        pos, first, held = 0, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not kinds:
                kinds |= {c: pa.int64() for c in COUNTS} | {"audit": pa.string(), "repaired_sha256": pa.string(), "pos": pa.int64()}
                kinds |= {f.name: f.type for f in batch.schema}
                first = batch.column("conv")[0].as_py()
            batch = batch.append_column("pos", pa.array(np.arange(pos, pos + batch.num_rows)))
            pos += batch.num_rows
            conv = batch.column("conv").to_numpy(zero_copy_only=False)
            ahead = int((conv == first).sum()) if first is not None else 0
            if ahead:
                yield shaped(batch.slice(0, ahead))
            if ahead == batch.num_rows:
                continue
            first, rest = None, batch.slice(ahead)
            conv = conv[ahead:]
            begin = int(np.flatnonzero(conv == conv[-1])[0])  # of the conversation that may go on
            if begin or (held and held[-1].column("conv")[-1].as_py() != conv[0]):
                whole = pa.concat_batches([*held, rest.slice(0, begin)])
                if whole.num_rows:
                    yield shaped(judged(whole))
                held = []
            held.append(rest.slice(begin))
        for batch in held:
            yield shaped(batch)

    columns = [c for c in names if c not in ("pos", *COUNTS, "audit", "repaired_sha256")]
    return rows.select(*columns).mapInArrow(walk, ", ".join([*result, *row]))


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows in order over all partitions; equal rows may part, so that no key is too large for a task."""
    order = [
        "conv", "turn", F.substring("role", 1, PREFIX).alias("role_begin"), F.substring("text", 1, PREFIX).alias("text_begin"),
        "digest", "number",
    ]
    keyed = rows.withColumn("number", F.monotonically_increasing_id()).select("*", *order[2:4])
    keys = ["conv", "turn", "role_begin", "text_begin", "digest", "number"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return placed.withColumn("part", F.spark_partition_id())


# --- conversations that reach beyond a partition ---------------------------------------


def _block(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    own = rows[~rows["dropped"]].sort_values("pos")
    return own, own["initial"].to_numpy(np.int64)[None], own["fault"].to_numpy(np.int64)[None]


SUMMARY = (
    "conv STRING, part INT, n BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, first_initial INT, "
    "last_initial INT, low BIGINT, high BIGINT, n_turns BIGINT, matrix ARRAY<BIGINT>, closing ARRAY<BIGINT>"
)


def _summary(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of a block, and its costs: between states, and to the end if nothing follows."""
    own, initial, fault = _block(rows)
    unit = np.where(np.eye(4, dtype=bool), 0, _FAR)[None]
    matrix = costs_back(initial, fault, unit)[0, 0]  # [end, begin]
    closing = costs_back(initial, fault, CLOSING[None])[0, 0]
    turns = own["turn"].dropna().astype("int64")
    i, f = initial[0], fault[0]
    return pd.DataFrame({
        "conv": [key[0]], "part": [key[1]], "n": [len(own)], "blank": [int((f == BLANK).sum())],
        "duplicate": [int((f == DUPLICATE).sum())], "truncated": [int((f == TRUNCATED).sum())],
        "illegal": [int(illegal(i).sum())], "first_initial": [int(i[0]) if len(i) else None],
        "last_initial": [int(i[-1]) if len(i) else None], "low": [int(turns.min()) if len(turns) else None],
        "high": [int(turns.max()) if len(turns) else None], "n_turns": [turns.nunique()],
        "matrix": [matrix.reshape(-1).tolist()], "closing": [closing.tolist()],
    }).astype({"low": object, "high": object, "first_initial": object, "last_initial": object})


COMBINED = "conv STRING, part INT, after ARRAY<BIGINT>, is_last BOOLEAN, is_first BOOLEAN, " + ", ".join(f"{c} BIGINT" for c in COUNTS)


def _combined(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
    """For each block of a conversation the costs after it; the conversation's counts."""
    blocks = blocks.sort_values("part").reset_index(drop=True)
    n = len(blocks)
    costs = np.array(blocks["closing"].iloc[-1], np.int64)
    after = [CLOSING.tolist()]
    for k in range(n - 2, -1, -1):
        after.append(costs.tolist())
        matrix = np.array(blocks["matrix"].iloc[k], np.int64).reshape(4, 4)
        costs = (matrix + costs[:, None]).min(0)
    full = blocks[blocks["n"] > 0]
    joints = illegal_between(full["last_initial"].to_numpy()[:-1], full["first_initial"].to_numpy()[1:])
    timed = blocks[blocks["n_turns"] > 0]
    # Rows are sorted by turn, so two blocks share one turn at most: the last of one, the first of the next.
    shared = int((timed["high"].to_numpy()[:-1] == timed["low"].to_numpy()[1:]).sum())
    missing = int(timed["high"].max() - timed["low"].min() + 1 - (timed["n_turns"].sum() - shared)) if len(timed) else 0
    counts = [missing, *(int(blocks[c].sum()) for c in ("blank", "duplicate", "truncated")), int(blocks["illegal"].sum()) + joints, int(costs[START])]
    out = pd.DataFrame({"conv": key[0], "part": blocks["part"], "after": after[::-1], "is_last": [False] * (n - 1) + [True],
                        "is_first": [True] + [False] * (n - 1)})
    return out.assign(**dict(zip(COUNTS, counts, strict=True)))


def illegal_between(before: np.ndarray, behind: np.ndarray) -> int:
    return sum(int(illegal(np.array([a, b], np.int64))[0]) for a, b in zip(before, behind, strict=True))


WAYS = "conv STRING, part INT, ends ARRAY<INT>, audits ARRAY<STRING>"


def _walked(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    own, initial, fault = _block(rows)
    after = np.array(rows["after"].iloc[0], np.int64)[None]
    edit, to = least_arcs(initial, fault, costs_back(initial, fault, after), bool(rows["is_last"].iloc[0]))
    return own, edit, to


def _ways(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each state before a block, the state after it and the audit in between."""
    _, edit, to = _walked(rows)
    nodes = paths(np.repeat(edit, 4, 0), np.repeat(to, 4, 0), np.arange(4))
    ends = (nodes[:, -1] & 3).tolist()
    return pd.DataFrame({"conv": [key[0]], "part": [key[1]], "ends": [ends], "audits": [audits(np.repeat(edit, 4, 0), nodes)]})


ENTRIES = "conv STRING, part INT, entry INT, audit STRING"


def _entries(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
    """The state before each block of a conversation, and the audit of that block."""
    blocks = blocks.sort_values("part")
    state, entry, audit = START, [], []
    for ends, own in zip(blocks["ends"], blocks["audits"], strict=True):
        entry.append(state)
        audit.append(own[state])
        state = int(ends[state])
    return pd.DataFrame({"conv": key[0], "part": blocks["part"], "entry": entry, "audit": audit})


def _turns(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """What a block leaves: its turns, one after the other; null if none."""
    own, edit, to = _walked(rows)
    nodes = paths(edit, to, np.array([rows["entry"].iloc[0]]))
    left = repaired(edit[0], to[0], nodes[0], own["role"].tolist(), own["text"].tolist())
    return pd.DataFrame({"conv": [key[0]], "part": [key[1]], "left": ["\n".join(left) if left else None]}).astype({"left": object})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's blocks, which come in order: a stream, nothing is held."""
    conv, digest, empty = None, None, True

    def out(name: str, found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([found.hexdigest()])], ["conv", "repaired_sha256"])

    for batch in batches:
        for i in range(batch.num_rows):
            name, left = batch.column("conv")[i].as_py(), batch.column("left")[i]
            if name != conv:
                if conv is not None:
                    yield out(conv, digest)
                conv, digest, empty = name, hashlib.sha256(), True
            if left.is_valid:
                digest.update(b"" if empty else b"\n")
                digest.update(left.as_py().encode("utf-8", "replace"))
                empty = False
    if conv is not None:
        yield out(conv, digest)


def _across(edges: DataFrame) -> DataFrame:
    """Results of the conversations whose rows may lie in several partitions."""
    key = ["conv", "part"]
    here = F.struct("part", "pos")
    repeated = edges.where("NOT dropped").groupBy("conv", "digest").agg(F.min(here).alias("first"), F.count("*").alias("n"))
    repeated = written(repeated.where("n > 1").select("conv", "digest", "first"), "repeated-turns")
    again = F.col("first").isNotNull() & (F.col("first") < here) & (F.col("fault") != BLANK)
    rows = edges.join(repeated, ["conv", "digest"], "left").withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault")))
    rows = written(rows.drop("first", "digest"), "edge-turns")
    blocks = rows.drop("role", "text").groupBy(*key).applyInPandas(_summary, SUMMARY)
    combined = written(blocks.groupBy("conv").applyInPandas(_combined, COMBINED), "blocks")
    placed = combined.select(*key, "after", "is_last")
    ways = rows.drop("role", "text").join(placed, key).groupBy(*key).applyInPandas(_ways, WAYS)
    entries = written(ways.groupBy("conv").applyInPandas(_entries, ENTRIES), "entries")
    walked = rows.join(placed, key).join(entries.select(*key, "entry"), key)
    left = walked.groupBy(*key).applyInPandas(_turns, "conv STRING, part INT, left STRING")
    digests = left.repartition("conv").sortWithinPartitions(*key).mapInArrow(_digests, "conv STRING, repaired_sha256 STRING")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "")
    texts = entries.groupBy("conv").agg(audit.alias("audit"))
    counts = combined.where("is_first").select("conv", *COUNTS)
    return counts.join(texts, "conv").join(digests, "conv").select("conv", *COUNTS, "audit", "repaired_sha256")


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256` of each conversation.

    Rows (`conv_id, turn, role, text`; nulls count as one space, a null `conv_id` is a conversation
    of its own) are damaged by the remainder by 20 of the CRC-32 of `conv_id:turn`: 0 drops, 1 empties
    the text, 2 removes its `.!?`, 3 repeats the row, 4 makes it a user's. They are then taken by
    turn, nulls first; rows of one turn by the beginnings (64 characters) of role and text, then by a
    digest of both. A row is blank, or a duplicate of an earlier one, or truncated (does not end
    in `.!?`). Blank and duplicate rows must be deleted.

    `gaps` counts turns that are missing, `illegal` neighbours of the damaged rows that may not
    follow each other. `audit` has the initials of the cheapest edits, the least in ASCII of
    equals; `repaired_sha256` is of the repaired turns, `role:text`, joined by line ends. A
    conversation without rows after damage has zeros, an empty audit and the digest of nothing. An
    empty table gives no rows; other columns are not read.
    """
    sorted_ = sorted_rows(damaged(rows))
    apart = written(_apart(sorted_), "conversations")
    inner = apart.where("part IS NULL").select("conv", *COUNTS, "audit", "repaired_sha256")
    across = _across(apart.where("part IS NOT NULL").select("conv", *[c.split(" ")[0] for c in ROW.split(", ")]))
    conv_id = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(rows.schema["conv_id"].dataType)
    return inner.unionByName(across).select(conv_id.alias("conv_id"), *COUNTS, "audit", "repaired_sha256")
