"""Conversation repair against a search over all cheap edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from wordtide.llm import conversations as C

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, audit INT, conv STRING"
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield turn, "user" if kind == 4 else role, text


def search(rows):
    """Cost, audit and turns of the best repair: the least (cost, audit) first, one edit at a time."""
    last, done = len(rows), set()
    heap = [(0, "", 0, "", ())]
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    while True:
        cost, audit, i, state, turns = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == last and state in ("", "a"):
            return cost, audit, turns
        for name in ("user", "assistant"):
            if (state, name[0]) in steps:
                heapq.heappush(heap, (cost + 2, audit + "I", i, name[0], (*turns, name + ":")))
        if i == last:
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, turns))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        if (state, role[:1]) in steps:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, steps[state, role[:1]], (*turns, f"{role}:{text}")))
        for name in ("user", "assistant"):
            if (state, name[0]) in steps:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, name[0], (*turns, f"{name}:{text}")))


def expected(all_rows):
    by_conv = defaultdict(list)
    for row in all_rows:
        by_conv[row[0]].append(row)
    for conv, rows in by_conv.items():
        def order(r):
            whole = f"{len(r[1])}:{r[1]}{r[2]}".encode()
            return r[0] is not None, r[0] or 0, r[1][:64].encode(), r[2][:64].encode(), hashlib.sha256(whole).digest()

        left = sorted(damage(rows), key=order)
        seen, faults = set(), []
        for _, role, text in left:
            stripped = text.strip(BLANKS)
            fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, _, _ in left if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(left, left[1:], strict=False)]
        cost, audit, repaired = search([(r, x, f) for (_, r, x), f in zip(left, faults, strict=True)])
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        yield (conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def made(seed, n_conv, most, roles=("system", "user", "assistant", "tool", "", None, "ultra", "Assistant")):
    pick = random.Random(seed)
    texts = ["Hi.", "So?", "Well", "no!", "", " \n\t", None, "One two. ", "a b", "x", " ", "\xa0"]
    rows = []
    for conv in range(n_conv):
        turns = list(range(pick.randint(0, most)))
        for turn in turns:
            role = pick.choice(roles) if pick.random() < 0.35 else ("user", "assistant")[turn % 2]
            text = pick.choice(texts) if pick.random() < 0.4 else f"text {pick.randint(0, 99)}."
            shown = None if pick.random() < 0.05 else turn + pick.choice([0, 0, 0, 1, 5])
            rows.append((conv if conv else None, shown, role, text))
    return rows


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)
    got = sorted(map(tuple, C.repaired_conversations(frame).collect()), key=repr)
    assert got == sorted(expected(rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_small_conversations(spark, seed):
    check(spark, made(seed, 400, 9))


def test_one_conversation_over_many_partitions(spark):
    """A conversation of most rows is cut into blocks; repeats and gaps reach across them."""
    pick = random.Random(5)
    long = [(7, t if t % 11 else None, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b", f"{t}!", ""])) for t in range(700)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        check(spark, long + made(3, 30, 6))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_rows_and_ties(spark):
    check(spark, [(1, 3, "user", "Hi.")] * 60 + [(1, 3, "assistant", "Yes."), (1, 3, "user", "B" * 70 + "x."), (1, 3, "user", "B" * 70 + "y.")])
    check(spark, [(None, None, None, None)] * 3 + [(2, None, "user", "a."), (2, None, "assistant", "b.")])


def test_nothing_left(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone."), (dropped + 1, 4, "user", "x" * 100_000)]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repaired_conversations(empty).count() == 0


def test_query_over_the_table(spark, sf_dir):
    from wordtide.llm.queries import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, queries()["op12_conversation_repair"](spark, sf_dir).collect()), key=repr)
    assert got == sorted(expected(rows), key=repr)
