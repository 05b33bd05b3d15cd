"""Topics of posts: stop-word removal on arrays, bag of words, LDA."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel, LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordtide.functions import patterns as P, text as T
from wordtide.sources.stopwords import StopWords

SEED = 42
#: Longest stop table that is read to the driver, to become a hash set of the predicate.
MOST_LISTED = 20_000
#: Posts of a partition of the fit, about: some seconds of scoring.
POSTS_A_PART = 8_192


def _listed(stop: StopWords) -> list[str] | None:
    """The words, or None for a table of more than `MOST_LISTED`."""
    if not isinstance(stop, DataFrame):
        return list(stop)
    found = [row.word for row in stop.select("word").limit(MOST_LISTED + 1).collect()]
    return found if len(found) <= MOST_LISTED else None


def _without_joined(arrays: DataFrame, stop: DataFrame) -> DataFrame:
    """`arrays` without the words of a long stop table, by a join.

    Distinct words of all posts meet the table, not the words themselves: a word that is a third
    of the text is one row. The words that are on the list come back to the posts' own distinct
    words, and posts are put together again by a number of their row.
    """
    listed = stop.select(F.lower("word").alias("word")).where("word IS NOT NULL").distinct()
    numbered = arrays.withColumn("row", F.monotonically_increasing_id())
    each = numbered.select("row", F.explode(F.array_distinct("words")).alias("word"))
    stopped = each.select("word").distinct().join(listed, "word", "left_semi")
    found = each.join(stopped, "word").groupBy("row").agg(F.collect_set("word").alias("stopped"))
    rest = F.when(F.col("stopped").isNull(), F.col("words")).otherwise(
        F.filter("words", lambda w: ~F.array_contains("stopped", w))
    )
    return numbered.join(found, "row", "left").select("post_id", rest.alias("words"))


def word_arrays(posts: DataFrame, stop: StopWords, drop_empty: bool = False) -> DataFrame:
    """`post_id, words`: basic tokens without stop words, ignoring case, one row per post.

    Empty words count as words unless `drop_empty`; ids need not be unique. A list is one
    predicate on the words within the post's row; a table of more than `MOST_LISTED` words is
    joined and stays off the driver.
    """
    raw = F.coalesce(T.basic_words(F.col("text")), F.array().cast("array<string>"))
    raw = F.array_remove(raw, "") if drop_empty else raw
    arrays = posts.select("post_id", raw.alias("words"))
    # The words are in lower case already.
    listed = _listed(stop)
    if listed is None:
        return _without_joined(arrays, stop)
    lowered = sorted({word.lower() for word in listed if word is not None})
    if not lowered:
        return arrays
    return arrays.withColumn("words", F.filter("words", lambda w: ~w.isin(lowered)))


def vocabulary(words: DataFrame, size: int = P.VOCABULARY_SIZE) -> DataFrame:
    """`term_idx, term, count` of the commonest terms, ties by term.

    The numbering window sees `size` rows only.
    """
    # The outer form: for the inner one Catalyst infers a size filter on the array below
    # the Generate, which computes each array twice.
    terms = words.select(F.explode_outer("words").alias("term")).where("term IS NOT NULL")
    top = terms.groupBy("term").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "term").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "term")) - 1
    return top.select(rank.alias("term_idx"), "term", "count")


def vectorizer(words: DataFrame, size: int = P.VOCABULARY_SIZE) -> CountVectorizerModel:
    """A count vectoriser over `vocabulary`; its at most `size` terms go to the driver."""
    rows = vocabulary(words, size).orderBy("term_idx").collect()
    return _counter([row.term for row in rows])


def _terms(terms: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, terms)), index + 1)


def bag_of_words(words: DataFrame, model: CountVectorizerModel) -> DataFrame:
    """`post_id, term, tf`, from the sparse vectors: counting stays within the post's row."""
    vectors = model.transform(words).select("post_id", F.unwrap_udt("features").alias("v"))
    pairs = vectors.select("post_id", F.inline(F.arrays_zip("v.indices", "v.values")))
    return pairs.select(
        "post_id",
        _terms(model.vocabulary, F.col("indices")).alias("term"),
        F.col("values").cast("bigint").alias("tf"),
    )


def _counter(terms: Sequence[str]) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(list(terms), inputCol="words", outputCol="features")


def _dealt(features: DataFrame) -> DataFrame:
    """Persisted vectors, dealt anew where the source's partitions are larger than `POSTS_A_PART`.

    Each pass of a fit waits for its slowest core: a few large partitions leave cores idle, and
    a file of one row group would be one task. Rows are dealt and sorted by all they hold, so one
    seed draws the same samples again, however the source lies in files.
    """
    parts = math.ceil(features.count() / POSTS_A_PART)
    if parts <= features.rdd.getNumPartitions():
        return features
    row = F.col("post_id"), F.unwrap_udt("features")
    dealt = features.repartition(parts, *row).sortWithinPartitions(*row).persist(StorageLevel.DISK_ONLY)
    try:
        dealt.count()
    except BaseException:
        dealt.unpersist()
        raise
    features.unpersist()
    return dealt


def _mixtures(model: LDAModel, features: DataFrame) -> DataFrame:
    mixed = model.transform(features)
    return mixed.select("post_id", vector_to_array("topicDistribution").alias("mixture"))


@dataclass
class SavedTopics:
    """A model and the terms of its vocabulary, read from a folder: for posts other than those
    of the fit, stored or of a stream."""

    model: LDAModel
    terms: list[str]

    def topics(self, n_terms: int = P.TOPIC_TERMS) -> DataFrame:
        """`topic, terms, weights`, the terms joined by commas."""
        described = self.model.describeTopics(n_terms)
        words = F.transform("termIndices", lambda i: _terms(self.terms, i))
        return described.select(
            "topic",
            F.concat_ws(",", words).alias("terms"),
            F.col("termWeights").alias("weights"),
        )

    def score(self, words: DataFrame) -> DataFrame:
        """`post_id, mixture` of rows `post_id, words` (`word_arrays`), each by itself: no shuffle, no state.

        Words beyond the vocabulary do not count; without any that does, a mixture is all zero.
        """
        return _mixtures(self.model, _counter(self.terms).transform(words))


@dataclass
class TopicModel(SavedTopics):
    """A fitted model, the vectors it came from, the terms of its vocabulary, and how long
    the fit took.

    The vectors stay persisted, so scoring does not split the texts again; `close` lets
    them go. Used as a context manager, the model closes itself.
    """

    features: DataFrame
    fit_seconds: float = 0.0

    def close(self) -> None:
        self.features.unpersist()

    def __enter__(self) -> TopicModel:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def post_topics(self) -> DataFrame:
        """`post_id, mixture`."""
        return _mixtures(self.model, self.features)

    def save(self, path: str) -> None:
        """Write the model and its terms to a new folder that executors share; see `load_topics`."""
        self.model.save(f"{path}/model")
        # Last: a folder with terms is complete.
        _counter(self.terms).save(f"{path}/terms")

    def quality(self) -> DataFrame:
        """`log_likelihood, log_perplexity` bounds, one row.

        The perplexity is the likelihood per word, so the posts are scored once.
        """
        likelihood = self.model.logLikelihood(self.features)
        counts = F.unwrap_udt("features")["values"]
        n_words = F.sum(F.aggregate(counts, F.lit(0.0), lambda a, b: a + b))
        return self.features.agg(
            F.lit(likelihood).alias("log_likelihood"),
            (F.lit(-likelihood) / n_words).alias("log_perplexity"),
        )


def fit_topics(
    words: DataFrame,
    k: int = P.TOPICS,
    max_iter: int = P.LDA_ITERATIONS,
    vocabulary_size: int = P.VOCABULARY_SIZE,
    seed: int = SEED,
) -> TopicModel:
    """Fit online LDA, its vectors persisted on disk for the optimiser and for scoring.

    A lost executor's share is computed again from the source. The optimiser is given a
    projection, which is not persisted itself: so it keeps vectors of its own as objects, in
    memory as far as they fit, and a pass skips to the vectors it samples. Of a persisted
    frame each pass would decode every vector.
    """
    counter = vectorizer(words, vocabulary_size)
    features = counter.transform(words).select("post_id", "features").persist(StorageLevel.DISK_ONLY)
    try:
        start = time.perf_counter()
        features = _dealt(features)
        model = LDA(k=k, maxIter=max_iter, optimizer="online", seed=seed).fit(features.select("features"))
        seconds = time.perf_counter() - start
    except BaseException:
        features.unpersist()
        raise
    return TopicModel(model, list(counter.vocabulary), features, seconds)


def load_topics(path: str) -> SavedTopics:
    """The model that `TopicModel.save` wrote to `path`; needs a running session."""
    terms = CountVectorizerModel.load(f"{path}/terms").vocabulary
    return SavedTopics(LocalLDAModel.load(f"{path}/model"), list(terms))
