import json

import pytest
from pyspark.sql import functions as F

from wordtide.plans import events as plans
from wordtide.plans.seasonal import seasonal_words_of_days
from wordtide.sources import posts as sources
from wordtide.sources.stopwords import stopwords


def line(post_id, created_at, text):
    return json.dumps({"id": post_id, "created_at": created_at, "text": text, "user": {"name": "n"}}) + "\n"


@pytest.fixture
def history_root(tmp_path):
    days = {
        "2020-02-01": [line(1, "Sat Feb 01 06:00:05 +0000 2020", "un deux"), "not json\n"],
        "2020-02-02": [line(2, "Sun Feb 02 06:00:05 +0000 2020", "un"), line(3, "Sun Feb 02 07:30:05 +0000 2020", "un\nhttps://a.bc")],
    }
    for day, lines in days.items():
        folder = tmp_path / "history" / day
        folder.mkdir(parents=True)
        (folder / day).write_text("".join(lines))
        (folder / "notes").write_text(line(9, "Sun Feb 02 06:00:05 +0000 2020", "other"))
    (tmp_path / "history" / "stop_words.txt").write_text("un\ndeux\n")
    return str(tmp_path / "history")


def test_posts_json(spark, history_root):
    rows = sources.posts_json(spark, f"{history_root}/2020-02-02/2020-02-02").orderBy("post_id").collect()
    assert [(r.post_id, str(r.ts), r.text) for r in rows] == [
        (2, "2020-02-02 06:00:05", "un"), (3, "2020-02-02 07:30:05", "un\nhttps://a.bc"),
    ]


def test_history_json_reads_the_file_named_like_its_folder(spark, history_root):
    rows = sources.history_json(spark, history_root).where("text IS NOT NULL").orderBy("post_id").collect()
    assert [(r.post_id, str(r.day)) for r in rows] == [(1, "2020-02-01"), (2, "2020-02-02"), (3, "2020-02-02")]


def test_history_days_as_folders_and_empty_days(spark, history_root):
    import os

    day = f"{history_root}/2020-02-03/2020-02-03"
    os.makedirs(day)
    for part in range(2):
        with open(f"{day}/part-{part}", "w") as file:
            file.write(line(20 + part, "Mon Feb 03 06:00:05 +0000 2020", "un"))
    os.makedirs(f"{history_root}/2020-02-04")
    os.makedirs(f"{history_root}/_temporary")
    listing = sources.history_listing(spark, history_root)
    assert list(listing) == ["2020-02-01", "2020-02-02", "2020-02-03", "2020-02-04"]
    assert listing["2020-02-04"] is None
    rows = sources.history_json(spark, history_root).where("text IS NOT NULL").collect()
    assert sorted((r.post_id, r.day) for r in rows) == [
        (1, "2020-02-01"), (2, "2020-02-02"), (3, "2020-02-02"), (20, "2020-02-03"), (21, "2020-02-03"),
    ]
    current = f"{history_root}/2020-02-02/2020-02-02"
    found = plans.history_events_json(spark, current, history_root, [], eta=-1)
    found.collect()
    with_days = {n: plans.history_events_json(spark, current, history_root, [], eta=0, n_days=n) for n in (None, 4, 2)}
    shares = {n: sorted((r.word, r.avg_past) for r in f.collect()) for n, f in with_days.items()}
    assert shares[None] == shares[4]
    os.makedirs(f"{history_root}/other")
    with open(f"{history_root}/other/posts", "w") as file:
        file.write("")
    with pytest.raises(ValueError):
        sources.history_listing(spark, history_root)


def test_empty_history(spark, tmp_path):
    (tmp_path / "root" / "2020-02-01").mkdir(parents=True)
    assert sources.history_json(spark, str(tmp_path / "root")).count() == 0


def test_a_file_that_runs_past_midnight_is_one_chain(spark, tmp_path):
    current = tmp_path / "2020-02-07"
    current.write_text(
        line(1, "Fri Feb 07 23:30:00 +0000 2020", "a " * 60)
        + line(2, "Sat Feb 08 00:15:00 +0000 2020", "b " * 60)
        + line(3, "Sat Feb 08 00:40:00 +0000 2020", "c " * 60)
    )
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        found = plans.file_events_json(spark, str(current), [], zone=zone).collect()
        assert sorted((r.day, r.batch_idx, r.word, r.is_warmup) for r in found) == [
            ("2020-02-07", 0, "a", True), ("2020-02-07", 0, "b", True), ("2020-02-07", 1, "c", False),
        ]


def test_posts_are_stored_by_day(spark, make_posts, tmp_path):
    from wordtide.sources.store import read_posts, write_posts

    posts = make_posts([("2024-01-01 10:00:00", "a"), ("2024-01-02 10:00:00", "b"), ("2024-01-03 10:00:00", "c")])
    posts = posts.unionByName(posts.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    write_posts(posts, str(tmp_path / "store"))
    assert read_posts(spark, str(tmp_path / "store")).count() == 3
    some = read_posts(spark, str(tmp_path / "store"), ["2024-01-01", "2024-01-03"])
    assert sorted(r.text for r in some.collect()) == ["a", "c"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_seasonal_words_of_stored_posts_parse_json_once(spark, tmp_path, history_root):
    from wordtide.plans.seasonal import seasonal_words_of_store
    from wordtide.sources.store import write_posts

    write_posts(sources.posts_json(spark, f"{history_root}/2020-02-02/2020-02-02"), str(tmp_path / "store"))
    found = seasonal_words_of_store(spark, str(tmp_path / "store"), f"{history_root}/stop_words.txt", ["2020-02-02"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and plan.count("FileScan parquet") == 2
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_jobs_from_the_command_line(spark, history_root, tmp_path):
    from wordtide.__main__ import run

    current = tmp_path / "2020-02-07"
    current.write_text(line(5, "Fri Feb 07 06:00:00 +0000 2020", "deux " * 60 + "trois " * 60))
    (tmp_path / "stop").write_text("trois\n")
    run(spark, ["file-events", str(current), str(tmp_path / "stop"), str(tmp_path / "words"), "--eta", "-1"])
    rows = spark.read.text(str(tmp_path / "words")).collect()
    assert [(str(r.day), r.batch_idx, r.value) for r in rows] == [("2020-02-07", 0, "deux")]
    run(spark, ["history-events", str(current), history_root, str(tmp_path / "stop"), str(tmp_path / "past"), "--eta", "2"])
    assert [r.value for r in spark.read.text(str(tmp_path / "past")).collect()] == ["deux"]
    run(spark, ["store", str(current), str(tmp_path / "store")])
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1
    run(spark, [
        "topics", str(current), str(tmp_path / "stop"), "2020-02-07 05:00:00", "2020-02-07 07:00:00",
        str(tmp_path / "topics"), "--topics", "2", "--iterations", "2", "--drop-empty",
    ])
    assert [r.value for r in spark.read.text(str(tmp_path / "topics")).collect()] == ["deux", "deux"]


def test_history_days(spark, history_root):
    from wordtide.operators.bursts import history_days

    rows = history_days(sources.history_json(spark, history_root)).collect()
    assert sorted((str(r.day), r.n_posts) for r in rows) == [("2020-02-01", 1), ("2020-02-02", 2)]


def test_time_range_reaches_the_scan(spark, sf_dir):
    import __spark_entry__ as entry

    plan = entry.time_range_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_stopwords(spark, history_root):
    assert sorted(r.word for r in stopwords(spark, f"{history_root}/stop_words.txt").collect()) == ["deux", "un"]


def test_events_from_json(spark, history_root, tmp_path):
    current = tmp_path / "current"
    current.write_text(
        line(5, "Fri Feb 07 06:00:00 +0000 2020", "deux " * 60) + line(6, "Fri Feb 07 07:00:01 +0000 2020", "un " * 60)
    )
    found = plans.history_events_json(spark, str(current), history_root, [], eta=2).collect()
    # Batch 0 of the history: "un" and "deux" on day one, "un" on day two; batch 1: "un".
    assert [(r.batch_idx, r.word, r.n_now, r.avg_past) for r in sorted(found)] == [
        (0, "deux", 60, 0.5), (1, "un", 60, 0.5),
    ]
    alone = plans.file_events_json(spark, str(current), []).collect()
    assert sorted((r.batch_idx, r.word) for r in alone) == [(0, "deux"), (1, "un")]


def test_seasonal_words_of_day_folders(spark, tmp_path):
    for day, name in (("01", "Sat"), ("02", "Sun")):
        folder = tmp_path / f"2020-02-{day}"
        folder.mkdir()
        rows = [
            line(h * 10 + i, f"{name} Feb {day} {h:02d}:00:{i + 1:02d} +0000 2020", "nuit le" if i < n else "le")
            for h, n in ((1, 8), (7, 2), (13, 2), (19, 2))
            for i in range(8)
        ]
        (folder / "part").write_text("".join(rows))
    (tmp_path / "stop.txt").write_text("le\n")
    got = seasonal_words_of_days(
        spark, str(tmp_path), str(tmp_path / "stop.txt"), ["2020-02-01", "2020-02-02"], min_count=1
    ).collect()
    assert [tuple(r) for r in got] == [("nuit", -43.0, -43.0, -43.0, 129.0)]


def test_json_stream(spark, history_root, tmp_path):
    stream = sources.posts_json_stream(spark, f"{history_root}/2020-02-02")
    query = (
        stream.writeStream.format("memory").queryName("json_posts")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("json_posts").where(F.col("post_id") < 9).count() == 2
