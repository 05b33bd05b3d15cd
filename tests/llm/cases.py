"""Small documents with the awkward rows every operator has to take."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, found STRING, row INT"


def words(seed, n, vocabulary=3000):
    pick = random.Random(repr(seed))
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def passages():
    """`(doc_id, text)`: passages shared across documents, inside one, cut, moved and repeated."""
    shared, other = words(1, 120), words(2, 60)
    text = lambda *parts: " ".join(w for p in parts for w in p)
    rows = [
        (10, text(words(3, 30), shared, words(4, 40))),
        (11, text(words(5, 7), shared[:80], words(6, 9))),
        (12, text(shared[50:], words(7, 20), shared[:50])),
        (13, text(shared[:49], words(8, 30), other)),
        (14, text(other, other, words(9, 10))),
        (15, text(words(10, 3), other[:50])),
        (16, text(other[5:], words(11, 4), other[:55])),
        (17, "same " * 200),
        (18, "same " * 130),
        (19, None),
        (20, ""),
        (21, " \t\n "),
        (22, text(shared)),
        (22, text(shared)),
        (23, "Á ç ñ  x\x0by \x1c z" + " ü" * 60),
        (24, "\nÁ ç ñ  x\x0by\r\n\x1c z" + "\tü" * 60),
        (25, text(words(12, 20_000, 10**6), shared)),
        (26, "x" * 300_000 + " " + text(other)),
        (None, text(shared)),
        (None, None),
        (5, text(words(13, 60))),
        (4, text(words(13, 60))),
        (3, text(words(13, 50))),
    ]
    return rows


def frame(spark, rows):
    """The rows as a documents table with two extra columns whose names operators use inside."""
    data = [(i, t, "en", "src0", len(t or ""), "own", 7) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)
