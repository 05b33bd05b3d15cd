import random

import corpus_pipeline
from tests.llm import brute, cases
from tests.llm.test_native import contaminated, measures, shared_targets
from tests.llm.test_neardup import brute_classes, edited


def corpus(seed):
    """Documents with junk, near copies, shared passages and benchmark items, and the benchmark."""
    pick, rows = random.Random(seed), []
    shared, item = cases.words((seed, "shared"), 70), cases.words((seed, "item"), 30)
    for i in range(60):
        words = cases.words((seed, i), pick.randrange(20, 120))
        if i % 7 == 0:
            words = words[:10] + shared + words[10:]
        if i % 11 == 0:
            words[5:5] = item
        rows.append(" ".join(words))
        if i % 5 == 0:
            rows += [" ".join(words), " ".join(edited(words, 0.01, pick))]
    rows += ["too short", None, "", "again " * 60, " ".join(shared)]
    pick.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)], [(1, " ".join(item)), (2, None)]


def staged(docs, items):
    """What each stage leaves, by brute force."""
    kept = []
    for i, text in docs:
        n, _, _, _, repeated = measures(text)
        if not (n < 20 or 100 * repeated > 30 * n):
            kept.append((i, text))
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    cut = {i: (n, gone) for i, n, gone, _ in brute.removed_words(kept)}
    texts = []
    for i, text in kept:
        if cut[i][1]:
            words, first = brute.spaced(text), {}
            for j, other in kept:
                w = brute.spaced(other)
                for s in range(len(w) - 49):
                    key = tuple(w[s : s + 50])
                    first[key] = min(first.get(key, j), j)
            gone = {s + k for s in range(len(words) - 49) if first[tuple(words[s : s + 50])] < i for k in range(50)}
            text = " ".join(w for k, w in enumerate(words) if k not in gone)
        texts.append((i, text))
    bad = {i for i, *_, hit in contaminated(texts, items) if hit}
    return [(i, t) for i, t in texts if i not in bad]


def write_tables(spark, folder, docs, items):
    cases.frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, items = corpus(3)
    write_tables(spark, str(tmp_path), docs, items)
    expected = staged(docs, items)
    sizes = {i: len(brute.spaced(t)) for i, t in expected}
    (target,) = shared_targets({"src0": sum(sizes.values())}).values()
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r["size"] for r in rows} == sizes and len(rows) == len(sizes)
    assert all(r.target == target and r.taken == r["size"] for r in rows)
    assert len(expected) < len(docs) - 20


def test_stages_return_documents(spark, tmp_path):
    docs, items = corpus(4)
    write_tables(spark, str(tmp_path), docs, items)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, str(tmp_path)).schema.names == frame.schema.names
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
