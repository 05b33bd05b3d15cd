"""Near-duplicate documents: DartMinHash signatures, bands, exact verification, components.

A document is the multiset of its shingles: five consecutive words (digits, letters and
everything beyond ASCII; A to Z lowered), weighted by how often it has them. A document of
fewer words is one shingle. Two documents are linked if their weighted Jaccard similarity
is at least 0.8; classes are the connected components of the links.

* Documents of one word sequence are one node, so copies never meet in a band.
* 30 bands of 5 coordinates: a pair at 0.8 shares a band with a probability of 1 - 7e-6.
* Within a band's bucket nodes meet the bucket's hub, the node that shares most buckets:
  copies that drift from one original still share theirs with it. Only pairs whose
  signatures agree enough are compared: a pair at 0.8 agrees in `LEAST_AGREEMENT` of the
  coordinates but for one in 20,000.
* Nodes of a bucket that are in different classes after that go through an exact
  prefix-filter join on their rarest shingles: all pairs of different classes that can be at
  0.8 are compared. Groups of over `PART` nodes are dealt out in blocks, each of which meets
  each other, so no task has a whole group and no pair is left to chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm import words as W
from wordtide.llm.components import components, merged
from wordtide.llm.darts import band_keys, signatures
from wordtide.llm.tables import drop, text_id, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5
LEAST_AGREEMENT = 0.67
SLOT_BITS = 18
PART = 1_000


def document_key() -> Column:
    """`doc_id`, or a large number made from the text where it is null."""
    by_text = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("bigint"), by_text.bitwiseOR(F.lit(1 << 62)))


def weighted(owner: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner's distinct elements, with the number of times it has them."""
    order = np.lexsort((element, owner))
    owner, element = owner[order], element[order]
    if not len(owner):
        return owner, element, np.zeros(0)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])])
    begin = np.flatnonzero(new)
    return owner[begin], element[begin], np.diff(np.concatenate([begin, [len(owner)]])).astype(np.float64)


def signed_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`key, tid, print, n, sketch, bands`: fingerprint (null without words), shingles, a byte of each
    coordinate, and band keys.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.PLAIN)
            n = len(words.counts)
            owner, shingle = W.shingles(words, SHINGLE)
            sizes = np.bincount(owner, minlength=n)
            values = signatures(*weighted(owner, shingle), n, bands * rows)
            keys, sketches, k = band_keys(values, rows), values.astype(np.uint8).tobytes(), bands * rows
            prints = np.stack(W.fingerprints(words), axis=1).tobytes()
            has = words.counts > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("tid"),
                 pa.array([prints[16 * i : 16 * i + 16] if has[i] else None for i in range(n)], pa.binary()),
                 pa.array(sizes.astype(np.int64)),
                 pa.array([sketches[k * i : k * (i + 1)] for i in range(n)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), W.signed(keys.ravel()))],
                ["key", "tid", "print", "n", "sketch", "bands"],
            )

    keyed = docs.select(document_key().alias("key"), text_id().alias("tid"), "text")
    return keyed.mapInArrow(scan, "key BIGINT, tid BIGINT, print BINARY, n BIGINT, sketch BINARY, bands ARRAY<BIGINT>")


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of each pair of texts."""
    sides = []
    for texts in (left, right):
        owner, shingle = W.shingles(W.split(texts, W.PLAIN), SHINGLE)
        sides.append(weighted(owner, shingle))
    owner = np.concatenate([s[0] for s in sides])
    element = np.concatenate([s[1] for s in sides])
    weight = np.concatenate([s[2] for s in sides])
    order = np.lexsort((element, owner))
    owner, element, weight = owner[order], element[order], weight[order]
    twin = np.flatnonzero((owner[1:] == owner[:-1]) & (element[1:] == element[:-1]))
    both = np.bincount(owner[twin], weights=np.minimum(weight[twin], weight[twin + 1]), minlength=len(left))
    whole = np.bincount(owner, weights=weight, minlength=len(left)) - both
    return np.divide(both, whole, out=np.zeros(len(left)), where=whole > 0)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """`a, b` of the pairs whose texts are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for half in W.portions(batches, "left"):
            for batch in W.portions(iter([half]), "right"):
                similar = similarities(batch.column("left"), batch.column("right")) >= least - 1e-12
                yield batch.select(["a", "b"]).filter(pa.array(similar))

    a = texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("right"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "left", "right").mapInArrow(compare, "a BIGINT, b BIGINT")


def _ordered(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _sizes_allow(one: Column, other: Column, least: float) -> Column:
    """The similarity is at most the ratio of the sizes."""
    return F.least(one, other) >= F.greatest(one, other) * F.lit(least - 1e-9)


def hub_pairs(shared: DataFrame, least: float) -> DataFrame:
    """Each node of a bucket with the bucket's hub."""
    degree = shared.groupBy("node").agg(F.sum("members").alias("degree"))
    best = F.max(F.struct("degree", (-F.col("node")).alias("turned"), F.col("n").alias("hub_n")))
    hubs = shared.join(degree, "node").groupBy("bucket").agg(best.alias("best"))
    found = shared.join(hubs, "bucket").withColumn("hub", -F.col("best.turned"))
    fits = _sizes_allow(F.col("n"), F.col("best.hub_n"), least)
    return found.where((F.col("node") != F.col("hub")) & fits).select(*_ordered(F.col("node"), F.col("hub"))).distinct()


def mixed_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """`bucket, node, n, label, members` of the buckets that hold nodes of several classes."""
    tagged = shared.select("bucket", "node", "n").join(labels, "node")
    mixed = tagged.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")
    )
    return tagged.join(mixed.where("low < high").select("bucket", "members"), "bucket")


def agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in `LEAST_AGREEMENT` of their coordinates."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_stacked(batch.column(c)) for c in ("left", "right"))
            enough = (left == right).mean(axis=1) >= LEAST_AGREEMENT if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    a = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("left"))
    b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("right"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "left", "right").mapInArrow(agree, "a BIGINT, b BIGINT")


def _stacked(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.uint8) for x in column.to_pylist()]) if len(column) else np.zeros((0, 1), np.uint8)


def elements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of each shingle; the repeats of a shingle within a text are elements of their own."""
    owner, shingle = W.shingles(W.split(texts, W.PLAIN), SHINGLE)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    if not len(owner):
        return owner, shingle
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])])
    begin = np.flatnonzero(new)
    before = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
    return owner, W.mix(shingle + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How many elements of the texts fall into each of `1 << SLOT_BITS` slots of hashes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in W.portions(batches):
            slot = elements(batch.column("text"))[1] >> np.uint64(64 - SLOT_BITS)
            counts += np.bincount(slot.astype(np.int64), minlength=1 << SLOT_BITS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "count"])

    found = texts.select("text").mapInArrow(scan, "slot BIGINT, count BIGINT").groupBy("slot").agg(F.sum("count").alias("count"))
    rows = found.toArrow()  # one row a slot at most, whatever the input
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[rows.column("slot").to_numpy()] = rows.column("count").to_numpy()
    return counts


def rare_elements(texts: DataFrame, least: float) -> DataFrame:
    """`node, label, n, at, bucket`: the rarest elements of each text, and their place in its order.

    Elements are in one order for all texts, by the count of their slot and their hash. Two
    texts that are similar enough share one of these.
    """
    counts = slot_counts(texts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            owner, element = elements(batch.column("text"))
            order = np.lexsort((element, counts[(element >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], owner))
            owner, element = owner[order], element[order]
            n = np.bincount(owner, minlength=batch.num_rows)
            at = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            rare = at <= n[owner] - np.ceil(n[owner] * least - 1e-9)
            owner = owner[rare]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(owner)), batch.column("label").take(pa.array(owner)),
                 pa.array(n[owner]), pa.array(at[rare]), W.signed(element[rare])],
                ["node", "label", "n", "at", "bucket"],
            )

    return texts.mapInArrow(scan, "node BIGINT, label BIGINT, n BIGINT, at BIGINT, bucket BIGINT")


def rare_pairs(texts: DataFrame, least: float) -> DataFrame:
    """All pairs of nodes of different classes that can be similar enough, by the elements they share.

    The elements that two nodes still have from a shared one on bound their overlap. At the
    first shared one the bound holds, so no link is missed.
    """

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        node, label, n, at, block, one, two = (
            rows.column(c).to_numpy() for c in ("node", "label", "n", "at", "block", "one", "two")
        )
        left, right = np.flatnonzero(block == one[0]), np.flatnonzero(block == two[0])
        found = []
        for begin in range(0, len(left), PART):
            i = left[begin : begin + PART]
            for other in range(0, len(right), PART):
                j = right[other : other + PART]
                need = np.ceil((n[i][:, None] + n[j]) * (least / (1 + least)) - 1e-9)
                fits = (np.minimum((n - at)[i][:, None], (n - at)[j]) >= need) & (label[i][:, None] != label[j])
                x, y = np.nonzero(fits)
                found.append(np.sort(np.stack([node[i[x]], node[j[y]]]), axis=0))
        ends = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], ["a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = np.stack([batch.column(c).to_numpy() for c in unit])
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                rows = batch.slice(begin, end - begin)
                if held and rows.num_rows and any(held[0].column(c)[0] != rows.column(c)[0] for c in unit):
                    yield pairs_of(pa.Table.from_batches(held))
                    held = []
                held.append(rows)
        if held:
            yield pairs_of(pa.Table.from_batches(held))

    unit = ["bucket", "one", "two"]
    rare = written(rare_elements(texts, least), "rare")
    mixed = rare.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")
    )
    parts = int(rare.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Each block of a large group meets each other one, and itself.
    blocks = F.ceil(F.col("members") / PART)
    met = rare.join(mixed.where("low < high").select("bucket", "members"), "bucket").withColumn("blocks", blocks)
    met = met.withColumn("block", F.pmod(F.xxhash64("node", "bucket"), "blocks"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    met = met.withColumn("one", F.least("block", "with")).withColumn("two", F.greatest("block", "with"))
    placed = met.repartition(parts, *unit).sortWithinPartitions(*unit)
    return placed.select(*unit, "block", "node", "label", "n", "at").mapInArrow(scan, "a BIGINT, b BIGINT").distinct()


def node_classes(shared: DataFrame, sketches: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """`node, label` of the nodes of `shared`: the least node that links lead to."""
    nodes = sketches.select("node")
    rows = nodes.count()
    tested = written(agreeing(hub_pairs(shared, least), sketches), "pairs")
    links = written(verified(tested, texts, least), "linked")
    first = components(links)
    labels = nodes.join(first, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    labels = written(labels, "labels", rows)
    rest = written(mixed_buckets(shared, labels).select("node", "label").distinct(), "rest", rows)
    new = rare_pairs(texts.withColumnRenamed("key", "node").join(rest, "node"), least)
    new = written(new.join(tested, ["a", "b"], "left_anti"), "pairs")
    links = written(verified(new, texts, least), "linked")
    return merged(labels, links, rows) if links.head(1) else labels


def classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`key, tid, class_id, class_tid, repeats`, one row per document: the least document of its
    class, and how many rows are this document.

    A document is a `document_key` and a `text_id`: rows that share an id but not the text are
    documents of their own. Documents without words are classes of their own. An empty table
    gives no rows.
    """
    signed = written(signed_documents(docs, bands, rows), "signatures")
    named = signed.where("print IS NOT NULL")
    node = F.shiftrightunsigned(F.xxhash64("print"), 1).alias("node")
    nodes = written(
        named.groupBy("print").agg(F.min(F.struct("key", "tid", "n", "sketch", "bands")).alias("least")).select(node, "least.*"),
        "nodes",
    )
    placed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(placed.join(sizes, "bucket"), "buckets")
    drawn = nodes.join(shared.select("node").distinct(), "node", "left_semi")
    sketches = written(drawn.select("node", "key", "tid", "sketch"), "sketches")
    keyed = docs.select(document_key().alias("key"), text_id().alias("tid"), "text").dropDuplicates(["key", "tid"])
    texts = written(
        keyed.join(sketches.select("node", "key", "tid"), ["key", "tid"]).select(F.col("node").alias("key"), "text"), "texts"
    )
    labels = node_classes(shared, sketches.select("node", "sketch"), texts, least)
    drop(texts)
    own = nodes.select("node", F.struct("key", "tid").alias("own"))
    tagged = own.join(labels, "node", "left").select("node", "own", F.coalesce("label", "node").alias("label"))
    heads = tagged.groupBy("label").agg(F.min("own").alias("head"))
    headed = tagged.join(heads, "label").select("node", "head")
    linked = named.select("key", "tid", node).join(headed, "node").select("key", "tid", "head")
    alone = signed.where("print IS NULL").select("key", "tid", F.struct("key", "tid").alias("head"))
    found = linked.union(alone).groupBy("key", "tid").agg(F.min("head").alias("head"), F.count("*").alias("repeats"))
    return found.select("key", "tid", F.col("head.key").alias("class_id"), F.col("head.tid").alias("class_tid"), "repeats")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`doc_id, class_id, kept`, one row for each row of `docs`.

    `kept` marks the document that stays of each class; its id is `class_id`. Different texts
    of one id are told apart, so two classes can show the same id. A null id stays null, its
    class is named by a number above 2^62 unless an id is in it.
    """
    keyed = docs.select("doc_id", document_key().alias("key"), text_id().alias("tid"))
    found = keyed.join(classes(docs, least, bands, rows), ["key", "tid"])
    first = (F.col("key") == F.col("class_id")) & (F.col("tid") == F.col("class_tid"))
    return found.select("doc_id", "class_id", first.alias("kept"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` that stay: one document of each class, and one row of that document."""
    found = written(classes(docs, least), "classes")
    # Written, so that their size is known: few ids are broadcast, and documents stay in place.
    rows = found.count()
    first = (F.col("key") == F.col("class_id")) & (F.col("tid") == F.col("class_tid"))
    gone = written(found.where(~first | (F.col("repeats") > 1)).select("key", "tid"), "gone", rows)
    again = written(found.where(first & (F.col("repeats") > 1)).select("key", "tid"), "again", rows)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    row = docs.select(document_key().alias("key"), text_id().alias("tid"), own)
    once = row.join(again, ["key", "tid"], "left_semi").groupBy("key", "tid").agg(F.first("row").alias("row"))
    return row.join(gone, ["key", "tid"], "left_anti").select("row.*").union(once.select("row.*"))
