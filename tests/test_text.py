import pytest
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.operators import words

NBSP = chr(0xA0)


def one(spark, text, expression):
    frame = spark.createDataFrame([(text,)], "text STRING")
    return frame.select(expression.alias("x")).first().x


def test_basic_words(spark):
    text = "L'été… «hi» a&gt;b, #x @y 3.5" + NBSP + "z."
    got = one(spark, text, T.basic_words(F.col("text")))
    assert got == ["l", "été…", "«hi»", "a&gt", "b", "", "#x", "@y", "3", "5" + NBSP + "z", ""]


def test_basic_tokens_drop_empty_words(spark):
    frame = spark.createDataFrame([(1, "a,, b."), (2, ""), (3, None)], "post_id INT, text STRING")
    rows = words.basic_tokens(frame).collect()
    assert sorted((r.post_id, r.word) for r in rows) == [(1, "a"), (1, "b")]


LINKS = (
    "abc.soiré x.co foo.com(bar) see foo.fr, http://a.bc/d t.co https://t.co/AbC1 "
    r"https:\/\/t.co\/Zz9 {a}[b]"
)


def test_links_are_removed(spark):
    frame = spark.createDataFrame([(LINKS,)], "text STRING")
    clean = T.with_clean_text(frame, strip_fragments=False).first().text
    assert clean == "abc.soiré x.co (bar) see , http://a.bc/d t.co https://t.co/abc1  {a}[b]"


def test_link_guard_loses_no_match(spark):
    """The guarded replacement equals the unguarded one."""
    from wordtide.functions import patterns as P

    texts = [LINKS, "fin.bonjour", "a.bc", "ab.c", "www.x.yz", "no dots", "ab.cd.", "..", "x@y.zz"]
    frame = spark.createDataFrame([(t,) for t in texts], "text STRING")
    plain = frame.select(F.regexp_replace(F.lower("text"), f"{P.URL}|{P.SHORT_LINK}", "").alias("text"))
    guarded = T.with_clean_text(frame, strip_fragments=False)
    assert guarded.collect() == plain.collect()


def test_fragments_go_inside_words(spark):
    text = "fin.bonjour tous https://t.co/abc1 comme sport"
    frame = spark.createDataFrame([(text,)], "text STRING")
    assert T.with_clean_text(frame).first().text == "fin.bonjour tous ://t./abc1 mme spo"


def test_unicode_escapes(spark):
    frame = spark.createDataFrame([("a" + chr(92) + "u00e9b " + chr(92) + "u12 c",)], "text STRING")
    assert T.with_clean_text(frame).first().text == r"ab \u12 c"


def test_normalized_tokens(spark):
    frame = spark.createDataFrame([(1, "12 -3 a1 1a (Le) [monde] {x} 3.5 LE le")], "post_id INT, text STRING")
    rows = words.normalized_tokens(frame, ["le"]).collect()
    assert [r.word for r in rows] == ["a1", "1a", "monde", "x"]


def test_number_must_match_to_the_last_character(spark):
    frame = spark.createDataFrame([("12",), ("12" + chr(0x2028),), ("-1.5",), ("1.",)], "w STRING")
    assert [r.n for r in frame.select(T.is_number(F.col("w")).alias("n")).collect()] == [
        True, False, True, False,
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("a  b", ["a", "", "b"]),
        ("", [""]),
        ("a ", ["a"]),
        ("   ", []),
        (" a\nB!", ["", "a", "B!"]),
        ("\n", []),
        ("a\t", ["a\t"]),
    ],
)
def test_live_words(spark, text, expected):
    assert one(spark, text, T.live_words(F.col("text"))) == expected
