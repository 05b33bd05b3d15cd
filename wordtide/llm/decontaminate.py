"""Documents that hold windows of benchmark items, in DataFrame functions only.

A prefix-filtered set join. Words are ordered by rarity: how often the documents have them. A
document can hold a window only if it has all of the window's words, so the prefix that has
to meet is one word, the window's rarest. Document words are joined with these; the position
of the word in the window then says where the window would begin, which must leave room for
all its words (positional and length bounds), and the words there are compared one by one.

Document words are exploded and joined within one stage, beside the text's array of words, so
they never cross the network. The windows are broadcast in blocks: their bytes are counted
first, and each block has about `BLOCK_BYTES`, so a larger benchmark means more blocks, not
larger broadcasts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm.tables import text_id, written

WINDOW = 10
#: Contract: what is between words, after A to Z are lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_BYTES = 16 << 20


def plain_words(text: Column) -> Column:
    """Words of the text: digits, letters a to z (A to Z lowered) and all beyond ASCII."""
    whole = F.coalesce(text, F.lit(""))
    # Lowering a whole text is fast, but would also lower letters beyond ASCII.
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    slow = F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.when(ascii_only, F.lower(whole)).otherwise(slow), GAP), "")


def item_windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """`window, ids`: distinct windows and the items (as strings) that have them.

    An item of fewer words, but not none, is one window. Items without an id count as hits
    but are not named.
    """
    words = items.select(F.col("item_id").cast("string").alias("id"), plain_words(F.col("text")).alias("words"))
    last = F.greatest(F.size("words") - length, F.lit(0))
    starts = words.where(F.size("words") > 0).withColumn("start", F.explode(F.sequence(F.lit(0), last)))
    windows = starts.select("id", F.slice("words", F.col("start") + 1, length).alias("window"))
    return windows.groupBy("window").agg(F.collect_set("id").alias("ids"))


def _blocks(frame: DataFrame, size: Column, key: str, bytes_: int) -> list[DataFrame]:
    """`frame` in parts of about `bytes_` by hash of `key`, each marked for broadcast."""
    total = frame.agg(F.sum(size)).first()[0] or 0
    n = int(total // bytes_) + 1
    parts = [frame.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [frame]
    return [F.broadcast(p) for p in parts]


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def _exploded(words: DataFrame) -> DataFrame:
    # The outer form: the inner one would compute each array twice, to test its size.
    return words.select("*", F.posexplode_outer("words").alias("position", "word"))


def with_rarest(windows: DataFrame, words: DataFrame, bytes_: int) -> DataFrame:
    """`windows` with `prefix`, the rarest word, and `offset`, its first place in the window."""
    vocabulary = written(windows.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    counts = [
        _exploded(words).join(block, "word").groupBy("word").agg(F.count("*").alias("n"))
        for block in _blocks(vocabulary, F.octet_length("word") + 40, "word", bytes_)
    ]
    known = vocabulary.join(_union(counts), "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    # Written, so that the join that follows is between plain tables: common words can be split.
    counted = written(known, "rarity")
    placed = windows.select("window", "ids", F.posexplode("window").alias("offset", "word"))
    rarest = F.min(F.struct("n", "word", "offset")).alias("rarest")
    return placed.join(counted, "word").groupBy("window").agg(F.first("ids").alias("ids"), rarest).select(
        "window", "ids", F.col("rarest.word").alias("prefix"), F.col("rarest.offset").alias("offset")
    )


def occurrences(docs: DataFrame, items: DataFrame, length: int = WINDOW, bytes_: int = BLOCK_BYTES) -> DataFrame:
    """`doc_id, tid, start, n, ids`: every place where a document has a window, `n` words long."""
    words = docs.select("doc_id", text_id().alias("tid"), plain_words(F.col("text")).alias("words"))
    windows = written(item_windows(items, length), "windows")
    ranked = written(with_rarest(windows, words.select("words"), bytes_), "prefixes")
    size = F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("ids", ",")) + 200
    found = []
    for block in _blocks(ranked.withColumnRenamed("prefix", "word"), size, "word", bytes_):
        met = _exploded(words).join(block, "word")
        start, n = F.col("position") - F.col("offset"), F.size("window")
        fits = (start >= 0) & (start + n <= F.size("words"))
        same = F.slice("words", F.greatest(start, F.lit(0)) + 1, n) == F.col("window")
        found.append(met.where(fits).where(same).select("doc_id", "tid", start.alias("start"), n.alias("n"), "ids"))
    return _union(found)


def per_document(found: DataFrame) -> DataFrame:
    """`doc_id, tid, n_hit, items`: words covered, and the items in order. Bounded by the text."""
    spans = F.sort_array(F.collect_set(F.struct("start", "n")))
    grouped = found.groupBy("doc_id", "tid").agg(spans.alias("spans"), F.flatten(F.collect_set("ids")).alias("items"))
    begin = F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans", begin,
        lambda s, x: F.struct(
            (s["hit"] + F.greatest(x["start"] + x["n"] - F.greatest(s["end"], x["start"]), F.lit(0))).cast("bigint").alias("hit"),
            F.greatest(s["end"], x["start"] + x["n"]).alias("end"),
        ),
        lambda s: s["hit"],
    )
    return grouped.select("doc_id", "tid", covered.alias("n_hit"), F.sort_array(F.array_distinct("items")).alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items` per row of `docs`.

    Null and empty texts have no words and no hits; rows that share an id but not a text are
    judged apart, equal rows alike. Without items nothing is hit.
    """
    hits = written(per_document(occurrences(docs, items, length)), "hits")
    sized = docs.select(
        "doc_id", text_id().alias("tid"), F.size(plain_words(F.col("text"))).cast("bigint").alias("n_words")
    )
    hit = hits.select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), "n_hit", "items")
    both = sized.join(hit, sized["doc_id"].eqNullSafe(hit["_id"]) & (sized["tid"] == hit["_tid"]), "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items_of).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), items_of.alias("items"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The rows of `docs` that hold no window of an item."""
    hits = written(occurrences(docs, items, length).select(
        F.col("doc_id").alias("_id"), F.col("tid").alias("_tid")
    ).distinct(), "contaminated")
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_id"]) & (text_id() == hits["_tid"]), "left_anti")
