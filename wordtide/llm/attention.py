"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Every passage of the whole text is encoded
(shares of kinds of characters, of repeated word triples, of word endings; then a layer).
Gated attention, learnt from labels of documents alone, weighs the passages: the weight is
a softmax of `w . (tanh(V h) * sigmoid(U h))`, and the weighted sum of encodings gives the
score. So a document with one bad passage among good ones can be told from a good one.

The model is fitted in numpy on a bounded sample: up to `SAMPLE` labelled documents of each
class, the ones of the least hashes of their ids, and up to `BAG` passages of each, those of the
least hashes of their places. Scoring reads all passages: a map over documents, with the few
thousand parameters in the task's closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm import words as W
from wordtide.llm.tables import text_id

PASSAGE = 32
SAMPLE, BAG = 1_000, 250
HIDDEN, ATTENTION = 16, 8
STEPS, RATE, DECAY = 150, 0.02, 1e-3
ENDINGS = 32

_SINGLE = b"!|#$%&*<>?"


def _classes() -> np.ndarray:
    codes = np.arange(256)
    kind = np.full(256, 4)
    kind[(codes >= 97) & (codes <= 122)] = 0
    kind[(codes >= 65) & (codes <= 90)] = 1
    kind[(codes >= 48) & (codes <= 57)] = 2
    kind[codes >= 128] = 3
    kind[[ord(c) for c in ".,;:'\"-()"]] = 5
    for i, c in enumerate(_SINGLE):
        kind[c] = 6 + i
    return kind


_KIND = _classes()
KINDS = 6 + len(_SINGLE)
FEATURES = KINDS + ENDINGS + 4


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and features of each passage; a text without words is one passage of zeros."""
    words = W.split(texts, W.SPACED)
    counts = words.counts
    n = np.maximum(1, -(-counts // PASSAGE))
    begin = np.cumsum(n) - n
    total = int(n.sum())
    document = np.repeat(np.arange(len(counts)), n)
    owner = words.owners()
    passage = begin[owner] + (np.arange(len(owner)) - words.offsets[owner]) // PASSAGE
    lengths = words.ends - words.starts
    n_words = np.bincount(passage, minlength=total)
    n_bytes = np.bincount(passage, weights=lengths, minlength=total)
    # Positions of all bytes of words, word by word.
    place = np.arange(int(lengths.sum())) + np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths)
    kinds = np.bincount(np.repeat(passage, lengths) * KINDS + _KIND[words.data[place]], minlength=total * KINDS)
    last = words.data[words.ends - 1].astype(np.int64)
    ending = (last * 31 + words.data[np.maximum(words.ends - 2, words.starts)]) % ENDINGS
    endings = np.bincount(passage * ENDINGS + ending, minlength=total * ENDINGS)
    repeated = np.zeros(total)
    text, first, triple = W.runs(words, 3)
    if len(text):
        order = np.lexsort((triple, text))
        equal = (text[order][1:] == text[order][:-1]) & (triple[order][1:] == triple[order][:-1])
        again = np.zeros(len(text), bool)
        again[order[1:]] |= equal
        again[order[:-1]] |= equal
        repeated = np.bincount(passage[first[again]], minlength=total).astype(float)
    some = np.maximum(n_words, 1)
    found = np.empty((total, FEATURES))
    found[:, :KINDS] = kinds.reshape(total, KINDS) / np.maximum(n_bytes, 1)[:, None]
    found[:, KINDS : KINDS + ENDINGS] = endings.reshape(total, ENDINGS) / some[:, None]
    found[:, -4] = n_words / PASSAGE
    found[:, -3] = n_bytes / some / 10
    found[:, -2] = repeated / some
    found[:, -1] = n_words > 0
    return document, found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Scaling of features, parameters by name, and what to add to the log odds."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    offset: float

    def forward(self, bag: np.ndarray, n_bags: int, x: np.ndarray) -> dict[str, np.ndarray]:
        """`x` is scaled; `bag` is sorted and every bag has a passage."""
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        raw = (t * g) @ w["w"]
        starts = np.searchsorted(bag, np.arange(n_bags))
        e = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        logit = z @ w["out"] + w["out0"][0]
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "logit": logit, "starts": starts}

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        bag, x = passages(texts)
        return _sigmoid(self.forward(bag, len(texts), (x - self.mean) / self.spread)["logit"] + self.offset)


def _gradients(model: Model, bag: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    w, f = model.weights, model.forward(bag, len(y), x)
    d = (_sigmoid(f["logit"]) - y) / len(y)
    dz = d[:, None] * w["out"]
    dh = f["a"][:, None] * dz[bag]
    da = (f["h"] * dz[bag]).sum(axis=1)
    inner = np.add.reduceat(f["a"] * da, f["starts"])
    draw = f["a"] * (da - inner[bag])
    dt = draw[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
    dg = draw[:, None] * w["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh += dt @ w["v"].T + dg @ w["u"].T
    dpre = dh * (1 - f["h"] ** 2)
    grads = {
        "encode": x.T @ dpre, "encode0": dpre.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg,
        "w": (f["t"] * f["g"]).T @ draw, "out": f["z"].T @ d, "out0": np.array([d.sum()]),
    }
    return {k: g + DECAY * w[k] for k, g in grads.items()}


def fit(texts: pa.Array, labels: np.ndarray, prior: float, seed: int = 42, steps: int = STEPS) -> Model:
    """Fit on whole documents; `prior` is the share of label 1 among all labelled ones.

    With labels of one class, or none, the score is the prior.
    """
    pick = np.random.default_rng(seed)
    bag, x = passages(texts) if len(texts) else (np.zeros(0, int), np.zeros((1, FEATURES)))
    return _fit(bag, x, labels, prior, pick, steps)


def _fit(bag: np.ndarray, x: np.ndarray, labels: np.ndarray, prior: float, pick: np.random.Generator, steps: int) -> Model:
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-6, spread, 1.0)

    def start(*shape):
        return pick.normal(0, 1 / np.sqrt(shape[0]), shape)

    weights = {
        "encode": start(FEATURES, HIDDEN), "encode0": np.zeros(HIDDEN), "v": start(HIDDEN, ATTENTION),
        "u": start(HIDDEN, ATTENTION), "w": start(ATTENTION), "out": start(HIDDEN), "out0": np.zeros(1),
    }
    y = labels.astype(float)
    odds = np.log(np.clip(prior, 1e-6, 1 - 1e-6) / (1 - np.clip(prior, 1e-6, 1 - 1e-6)))
    if not len(y) or y.min() == y.max():
        for value in weights.values():
            value[...] = 0
        return Model(mean, spread, weights, float(odds))
    share = y.mean()
    model = Model(mean, spread, weights, float(odds - np.log(share / (1 - share))))
    x = (x - mean) / spread
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        for k, g in _gradients(model, bag, x, y).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            rate = RATE * (1 - 0.9 * step / steps)
            weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Contract: rows of which labels are never learnt from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bag: int = BAG) -> Model:
    """Fit on up to `sample` documents of each class that are not held out, up to `bag` passages of each.

    `labels` has `doc_id, quality`; repeated labels count once, contradicting and null ones
    not at all. The sample is taken from the labelled ids that have a document, so only its
    texts are fetched. Of several texts with one id that of the least `tables.text_id` is
    learnt from, so repeated rows count once.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    known = known.join(docs.select(F.col("doc_id").cast("bigint")).distinct(), "doc_id", "left_semi").select("doc_id", "y")
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    # At most twice `sample` rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("bigint"), text_id().alias("tid"), "text").join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "y").agg(F.min(F.struct("tid", "text")).alias("one")).select("doc_id", "y", "one.text")
    rows = _bags(one, bag).orderBy("doc_id").toArrow()
    total = sum(counts.values())
    parts = [np.frombuffer(x).reshape(-1, FEATURES) for x in rows.column("bag").to_pylist()]
    owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    x = np.concatenate(parts) if parts else np.zeros((1, FEATURES))
    prior = counts.get(1, 0) / total if total else 0.5
    return _fit(owner, x, rows.column("y").to_numpy(), prior, np.random.default_rng(42), STEPS)


def _bags(wanted: DataFrame, most: int) -> DataFrame:
    """`doc_id, y, bag`: features of `most` passages at most, chosen by a hash of their places."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            owner, x = passages(batch.column("text"))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            found = []
            for begin, end in zip(ends, ends[1:], strict=False):
                own = x[begin:end]
                if len(own) > most:
                    own = own[np.sort(np.argsort(W.mix(np.arange(len(own), dtype=np.uint64)))[:most])]
                found.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "y")), pa.array(found, pa.binary())], ["doc_id", "y", "bag"]
            )

    return wanted.select("doc_id", F.col("y").cast("int"), "text").mapInArrow(encode, "doc_id BIGINT, y INT, bag BINARY")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score` (0 to 1, the higher the likelier label 1) and `predicted`.

    They replace columns of these names. Null and empty texts are a passage of zeros.
    """
    added = ["score", "predicted"]
    own = [c for c in docs.columns if c not in added]
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "text")
    schema = "row " + named.schema["row"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            score = model.scores(batch.column("text"))
            predicted = pa.array((score >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score), predicted], ["row", *added])

    return named.mapInArrow(scan, f"{schema}, score DOUBLE, predicted INT").select("row.*", *added)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with `held_out`, `score`, `predicted`. Only texts are inputs of a score."""
    model = learn(docs, labels)
    return scored(docs.withColumn("held_out", held_out()), model)
