"""Each registered query against its SQL twin at the smallest scale."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences, types

# What a fit of topics gives; what holds of any fit has SQL.
NO_SQL = {"lda_topics", "lda_post_topics", "lda_quality"}
ORACLES = entry.oracle_sql()
# The queries of wordtide.llm have their own tests.
OWN = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in OWN if n in ORACLES])
def test_query_equals_sql(spark, duck, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    _, _, text = differences(frame, duck, ORACLES[name])
    assert not text
    assert not types(frame, duck, ORACLES[name])


def test_only_topics_have_no_sql():
    assert set(OWN) - set(ORACLES) == NO_SQL


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["word", "d_morning", "d_afternoon", "d_evening", "d_night"]
    assert frame.count() > 0
