import pytest
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA
from pyspark.sql import functions as F

from wordtide.operators import topics
from wordtide.plans.topics import topics_between, words_between
from wordtide.sources.posts import posts_from_documents
from wordtide.sources.stopwords import COMMON

WEEK = ("2024-01-01 00:00:00", "2024-01-08 00:00:00")


@pytest.fixture
def posts(make_posts):
    return make_posts([(1, "The cat, THE hat."), (2, "the the"), (3, ""), (4, None), (5, "cat hat cat")])


EXPECTED = {0: ["cat", "", "hat", ""], 1: [], 2: [""], 3: [], 4: ["cat", "hat", "cat"]}


def by_id(frame):
    return {r.post_id: r.words for r in frame.collect()}


def test_word_arrays(posts):
    assert by_id(topics.word_arrays(posts, ["The"])) == EXPECTED
    assert by_id(topics.word_arrays(posts, []))[1] == ["the", "the"]
    assert by_id(topics.word_arrays(posts, ["the"], drop_empty=True))[0] == ["cat", "hat"]


@pytest.mark.parametrize("more", [2, 3_000])
def test_stop_lists_of_any_length_give_the_same(spark, make_posts, more):
    """Also for posts that share an id, or have none."""
    rows = make_posts([(1, "The cat, THE hat."), (2, "dog the"), (3, "a dog")])
    rows = rows.withColumn("post_id", F.when(F.col("post_id") < 2, F.lit(7).cast("bigint")))
    stop = spark.createDataFrame([("The",), (None,), *[(f"x{i}",) for i in range(more)]], "word STRING")
    found = sorted([(r.post_id, r.words) for r in topics.word_arrays(rows, stop, drop_empty=True).collect()], key=repr)
    assert found == [(7, ["cat", "hat"]), (7, ["dog"]), (None, ["a", "dog"])]


def test_long_stop_tables_stay_off_the_driver(spark, make_posts):
    """300,000 stop words: order and repeats of the other words are kept."""
    texts = ["The x7 cat The, the", "", None, "x1 x2 x299999", "cat cat dog x300000", "the"]
    rows = make_posts(list(enumerate(texts))).withColumn("post_id", F.col("post_id") % 4)
    stop = spark.range(300_000).select(F.concat(F.lit("X"), "id").alias("word")).union(spark.sql("SELECT 'the' UNION ALL SELECT NULL"))
    found = topics.word_arrays(rows, stop, drop_empty=True)
    assert found.columns == ["post_id", "words"]
    words = [["cat"], [], [], [], ["cat", "cat", "dog", "x300000"], []]
    expected = [(i % 4, w) for i, w in enumerate(words)]
    assert sorted(((r.post_id, r.words) for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_vocabulary_and_bag(posts):
    arrays = topics.word_arrays(posts, ["the"])
    rows = topics.vocabulary(arrays, 2).orderBy("term_idx").collect()
    # Empty words are terms: three of them, as many as "cat"; ties go by term.
    assert [(r.term_idx, r.term, r["count"]) for r in rows] == [(0, "", 3), (1, "cat", 3)]
    bag = topics.bag_of_words(arrays, topics.vectorizer(arrays, 2)).collect()
    assert sorted(tuple(r) for r in bag) == [(0, "", 2), (0, "cat", 1), (2, "", 1), (4, "cat", 2)]


def test_arrays_are_computed_once(posts):
    plan = topics.vocabulary(topics.word_arrays(posts, ["the"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_lda(spark, sf_dir):
    posts = posts_from_documents(spark, sf_dir)
    fitted = topics_between(posts, *WEEK, COMMON, k=3, max_iter=3, vocabulary_size=50)
    rows = fitted.topics().collect()
    assert [r.topic for r in rows] == [0, 1, 2]
    assert all(len(r.weights) == 10 and sorted(r.weights, reverse=True) == r.weights for r in rows)
    assert all(len(r.terms.split(",")) == 10 for r in rows)
    mixtures = fitted.post_topics().collect()
    n_posts = words_between(posts, *WEEK, COMMON).count()
    assert len(mixtures) == n_posts
    # A post without a term of the vocabulary has no mixture: all zero.
    assert all(abs(sum(r.mixture) - 1) < 1e-9 or sum(r.mixture) == 0 for r in mixtures)
    quality = fitted.quality().first()
    assert quality.log_likelihood < 0
    assert quality.log_perplexity == pytest.approx(fitted.model.logPerplexity(fitted.features), rel=1e-9)
    again = topics_between(posts, *WEEK, COMMON, k=3, max_iter=3, vocabulary_size=50)
    assert [r.terms for r in again.topics().collect()] == [r.terms for r in rows]


def test_disjoint_vocabularies_are_recovered(make_posts):
    rows = [(i, " ".join(["red green blue"] * 8 if i % 2 else ["cat dog bird"] * 8)) for i in range(60)]
    arrays = topics.word_arrays(make_posts(rows), [], drop_empty=True)
    with topics.fit_topics(arrays, k=2, max_iter=30, vocabulary_size=10) as model:
        heads = [frozenset(r.terms.split(",")[:3]) for r in model.topics(3).collect()]
        assert set(heads) == {frozenset(("red", "green", "blue")), frozenset(("cat", "dog", "bird"))}
        for r in model.post_topics().collect():
            assert max(r.mixture) > 0.9


def test_likelihood_is_a_bound(make_posts):
    """The bound lies below the likelihood of a word distribution for each post of its own."""
    import math

    texts = ["a a b", "a b b b", "b a a a"] * 4
    arrays = topics.word_arrays(make_posts(list(enumerate(texts))), [], drop_empty=True)
    with topics.fit_topics(arrays, k=2, max_iter=20, vocabulary_size=5) as model:
        quality = model.quality().first()
        best = sum(t.split().count(w) * math.log(t.split().count(w) / len(t.split())) for t in texts for w in "ab")
        total = sum(len(t.split()) for t in texts)
        assert quality.log_likelihood < best < 0
        assert quality.log_perplexity == pytest.approx(-quality.log_likelihood / total, rel=1e-9)
        assert model.fit_seconds > 0


def test_vectors_are_kept_until_closed(make_posts):
    arrays = topics.word_arrays(make_posts([(1, "a b"), (2, "b c")]), [])
    model = topics.fit_topics(arrays, k=2, max_iter=2, vocabulary_size=5)
    assert model.features.storageLevel.useDisk
    model.close()
    assert not model.features.storageLevel.useDisk


def test_passes_do_not_read_the_persisted_frame(make_posts, monkeypatch):
    """The optimiser has vectors of its own, and fits what it would of the persisted ones."""
    levels = []

    class Watched(LDA):
        def fit(self, dataset, params=None):
            levels.append(dataset.storageLevel)
            return super().fit(dataset, params)

    monkeypatch.setattr(topics, "LDA", Watched)
    arrays = topics.word_arrays(make_posts(list(enumerate(["a a b c", "b c", "", None, "c d d"] * 9))), [])
    with topics.fit_topics(arrays, k=2, max_iter=5, vocabulary_size=5) as model:
        assert levels == [StorageLevel(False, False, False, False, 1)]
        assert model.features.storageLevel == StorageLevel.DISK_ONLY
        plain = LDA(k=2, maxIter=5, optimizer="online", seed=topics.SEED).fit(model.features)
        found = model.model.topicsMatrix().toArray()
        assert found.sum() > 0 and found == pytest.approx(plain.topicsMatrix().toArray(), rel=1e-9)


def test_large_partitions_are_dealt(spark, make_posts, monkeypatch):
    """The same model and mixtures however the posts lie in partitions; ids may repeat or be null."""
    monkeypatch.setattr(topics, "POSTS_A_PART", 10)
    texts = ["red green blue red", "cat dog bird", "", None, "cat red", "unknown", "red green", "dog dog"]
    rows = make_posts(list(enumerate(texts * 8))).withColumn("post_id", F.expr("IF(post_id % 5 = 0, NULL, post_id % 20)"))
    data, schema = rows.collect(), rows.schema
    fits = []
    for posts in (data, data[::-1]):
        arrays = topics.word_arrays(spark.createDataFrame(posts, schema).coalesce(1), [])
        with topics.fit_topics(arrays, k=2, max_iter=5, vocabulary_size=6) as model:
            assert model.features.rdd.getNumPartitions() == 7
            mixtures = [(r.post_id, [round(x, 6) for x in r.mixture]) for r in model.post_topics().collect()]
            fits.append((model.model.topicsMatrix().toArray(), sorted(mixtures, key=repr), model.quality().first()))
    (matrix, mixtures, quality), (other, others, again) = fits
    assert matrix == pytest.approx(other, rel=1e-9)
    assert len(mixtures) == len(data) and mixtures == others
    assert tuple(quality) == pytest.approx(tuple(again), rel=1e-9)


def test_saved_models_score_stored_and_streamed_posts_alike(spark, make_posts, tmp_path):
    """In one session, what was fitted and what was read back differ in nothing."""
    texts = ["red green blue red", "cat dog bird", "", None, "cat red", "unknown words", "red green", "dog dog"]
    posts = make_posts(list(enumerate(texts * 4)))
    with topics.fit_topics(topics.word_arrays(posts, []), k=2, max_iter=3, vocabulary_size=6) as fitted:
        fitted.save(str(tmp_path / "saved"))
        with pytest.raises(Exception, match="exist"):
            fitted.save(str(tmp_path / "saved"))
        expected = sorted(map(tuple, fitted.post_topics().collect()))
        described = fitted.topics().collect()
    saved = topics.load_topics(str(tmp_path / "saved"))
    assert saved.topics().collect() == described
    assert sorted(map(tuple, saved.score(topics.word_arrays(posts, [])).collect())) == expected

    for part in range(3):
        posts.where(f"post_id % 3 = {part}").write.parquet(str(tmp_path / f"posts/{part}"))
    arriving = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "posts/*"))

    def run():
        scored = saved.score(topics.word_arrays(arriving, []))
        stream = scored.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
        stream.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted(map(tuple, spark.read.schema(scored.schema).parquet(str(tmp_path / "out")).collect()))

    assert run() == expected
    assert run() == expected  # a restart adds nothing
