"""The analyses as jobs: `spark-submit --py-files wordtide.zip wordtide/__main__.py ANALYSIS ...`.

`python -m wordtide --help` lists the analyses and their parameters.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from wordtide.functions import patterns as P
from wordtide.plans import events, seasonal, topics
from wordtide.sources.posts import posts_json
from wordtide.sources.stopwords import stopwords
from wordtide.sources.store import write_posts


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wordtide")
    parser.add_argument("--zone", default="UTC", help="zone of the wall clock of the posts")
    kinds = parser.add_subparsers(dest="analysis", required=True)

    one = kinds.add_parser("seasonal-words", help="words over-represented in one quarter of the day")
    one.add_argument("root", help="folder with a folder of posts per day")
    one.add_argument("stop_words")
    one.add_argument("scores", help="output: a line of scores per word")
    one.add_argument("words", help="output: the words")
    one.add_argument("--days", nargs="+", required=True)
    one.add_argument("--min-count", type=int, default=P.MIN_COUNT)
    one.add_argument("--threshold", type=float, default=P.SEASONAL_THRESHOLD)

    one = kinds.add_parser("file-events", help="bursts of a day against the batches before")
    one.add_argument("posts", help="file or folder of one day")
    one.add_argument("stop_words")
    one.add_argument("out")
    one.add_argument("--batches", type=int, default=2, help="batches of a window")
    one.add_argument("--eta", type=float, default=3)

    one = kinds.add_parser("history-events", help="bursts of a day against other days")
    one.add_argument("posts", help="file or folder of one day")
    one.add_argument("history", help="folder of <day>/<day>")
    one.add_argument("stop_words")
    one.add_argument("out")
    one.add_argument("--eta", type=float, default=5)
    one.add_argument("--align", choices=["ordinal", "hour"], default="ordinal")
    one.add_argument("--n-days", type=int, help="divisor, if not the number of day folders")

    one = kinds.add_parser("topics", help="topics of the posts between two times")
    one.add_argument("posts")
    one.add_argument("stop_words")
    one.add_argument("low")
    one.add_argument("high")
    one.add_argument("out")
    one.add_argument("--topics", type=int, default=P.TOPICS)
    one.add_argument("--iterations", type=int, default=P.LDA_ITERATIONS)
    one.add_argument("--vocabulary", type=int, default=P.VOCABULARY_SIZE)
    one.add_argument("--drop-empty", action="store_true")

    one = kinds.add_parser("store", help="posts as Parquet, a folder per day")
    one.add_argument("posts")
    one.add_argument("out")
    return parser


def run(spark: SparkSession, arguments: Sequence[str]) -> None:
    """Run one analysis on a session."""
    a = _parser().parse_args(arguments)
    if a.analysis == "seasonal-words":
        seasonal.write_seasonal_words(
            spark, a.root, a.stop_words, a.days, a.scores, a.words,
            zone=a.zone, min_count=a.min_count, threshold=a.threshold,
        )
    elif a.analysis == "file-events":
        stop = stopwords(spark, a.stop_words)
        events.write_file_events(spark, a.posts, stop, a.out, n=a.batches, eta=a.eta, zone=a.zone)
    elif a.analysis == "history-events":
        stop = stopwords(spark, a.stop_words)
        events.write_history_events(
            spark, a.posts, a.history, stop, a.out, eta=a.eta, align=a.align, zone=a.zone, n_days=a.n_days
        )
    elif a.analysis == "topics":
        took = topics.write_topics_json(
            spark, a.posts, a.stop_words, a.low, a.high, a.out, a.zone, a.drop_empty,
            k=a.topics, max_iter=a.iterations, vocabulary_size=a.vocabulary,
        )
        print(f"fit: {took:.1f} s")
    else:
        write_posts(posts_json(spark, a.posts, a.zone), a.out)


def main() -> None:
    spark = SparkSession.builder.appName("wordtide").getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
