"""Collocations against a count of all phrases, and the guarantee of the summaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from wordtide.llm import collocations as C

SCHEMA = "doc_id BIGINT, lang STRING, text STRING, rank INT, phrase STRING, a STRING"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, threshold, longest=4, best=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(words[i : i + k])] += 1
    for lang, own in counts.items():
        known = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        most = Counter()
        for p, a in known.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], a)
        kept = []
        for p, a in known.items():
            if p in most and 100 * most[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


def check(spark, rows, threshold, **options):
    frame = spark.createDataFrame([(i, lang, text, 0, "own", "own") for i, (lang, text) in enumerate(rows)], SCHEMA)
    found = C.collocations(frame, threshold, **options)
    assert found.columns == COLUMNS
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(brute(rows, threshold, **{k: v for k, v in options.items() if k in ("longest", "best")}))
    return got


def made(seed, n=300):
    pick = random.Random(seed)
    words = ["a", "B", "b", "é", "ÉÉ", "of", "the", "x\xa0y", "日本", "c" * 300, *(f"w{i}" for i in range(40))]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " - ", "!?", "\r\n"]
    rows = [(pick.choice(["en", "fr", None, "und", ""]), "".join(pick.choice(words[: pick.randint(2, 50)]) + pick.choice(ends) for _ in range(pick.randint(0, 60)))) for _ in range(n)]
    return [*rows, ("en", None), (None, ""), ("en", " \t"), ("de", "one word"), *[("en", "of the same of the same kind")] * 40]


@pytest.mark.parametrize("threshold", [1, 3, 12])
def test_all_phrases(spark, threshold):
    assert check(spark, made(threshold), threshold)


def test_first_of_each_language(spark):
    assert len(check(spark, made(9), 2, best=5)) == 5 * 4
    check(spark, made(10), 2, longest=3)


def test_small_portions_blocks_and_summaries(spark, monkeypatch):
    """Many blocks for each partition, small tables of bits: the same results."""
    monkeypatch.setattr(C, "PORTION", 2_000)
    monkeypatch.setattr(C, "HELD", 500)
    monkeypatch.setattr(C, "SLOTS", 1 << 16)
    monkeypatch.setattr(C, "ENTRIES", 4)
    check(spark, made(4), 5)


def test_one_phrase_is_most_of_the_text(spark):
    rows = [("en", "same words here " * 2000)] + [("en", f"other w{i} words") for i in range(50)]
    check(spark, rows, 30)


def test_empty_table(spark):
    assert not check(spark, [], 3)


@pytest.mark.parametrize("capacity", [1, 7, 50])
def test_a_summary_keeps_all_that_reach_the_threshold(capacity):
    draw = np.random.default_rng(capacity)
    parts = [draw.zipf(1.3, 4000).astype(np.uint64) % np.uint64(900) for _ in range(6)]
    mass = sum(len(p) for p in parts)
    whole, others = C.Summary(capacity), []
    for k, part in enumerate(parts):
        target = whole if k % 2 else C.Summary(capacity)
        for piece in np.array_split(part, 9):
            keys, counts = np.unique(piece, return_counts=True)
            target.add(keys, counts.astype(np.int64))
        if target is not whole:
            others.append(target)
    for other in others:
        whole.merge(other)
    threshold = mass // capacity + 1
    reached = set(whole.reaching(threshold).tolist())
    assert whole.taken * (capacity + 1) <= mass and len(whole.keys) <= capacity
    true = Counter(np.concatenate(parts).tolist())
    assert {k for k, n in true.items() if n >= threshold} <= reached
    for key, n in zip(whole.keys.tolist(), whole.counts.tolist(), strict=True):
        assert n <= true[key] <= n + whole.taken
