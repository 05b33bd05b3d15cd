import base64
import hashlib
import re

import pytest

from wordtide.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999:X>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def page_rows():
    html = [
        "<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", FAKE, "x\r\n\r\n" + FAKE * 3, "\r\n\r\nWARC/1.1\r\nContent-Length: 9999999\r\n\r\n",
        "WARC/1.1\r\n", "é\0ü" * 5, "long " * 40_000, "\r\n\r\n", "<p>a</p>", "tail\r\n\r\nWARC/1.0\r\n", FAKE,
    ]
    rows = [(i, f"http://x/{i}", h) for i, h in enumerate(html)]
    rows += [(12, None, "<p>a</p>"), (None, "u\r\nWARC-Type: x", "<p>a</p>"), (None, "u", "only"), (None, "u", "only"), (1, "", "other")]
    return rows


def frame(spark, rows):
    data = [(*r, "own", 1) for r in rows]
    return spark.createDataFrame(data, "page_id BIGINT, url STRING, html STRING, digest STRING, owner INT").repartition(3)


def expected(rows, least=0):
    found = []
    for page, _, html in rows:
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        size = len((html or "").encode())
        again = size >= least and ids and (page is None or page < max(ids)) and len([1 for r in rows if (r[2] or "") == (html or "")]) > 1
        found.append((page, size, digest(html), "revisit" if again else "response", max(ids) if again else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("least,size", [(0, 1 << 20), (0, 37), (3, 700)])
def test_round_trip(spark, tmp_path, least, size):
    rows = page_rows()
    back = warc.round_trip(frame(spark, rows), f"file://{tmp_path}/warc", least, size)
    got = back.collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == expected(rows, least)
    assert all(r.intact for r in got)


def test_false_candidates_are_found_and_rejected(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(frame(spark, page_rows()).coalesce(1), folder)
    found = warc.candidates(warc.files_of(spark, folder), 100)
    assert found.count() > len(page_rows())
    read = warc.records(spark, folder, 100).collect()
    assert len(read) == len(page_rows())
    payloads = {r.page_id: bytes(r.payload).decode() for r in read if r.record_type == "response"}
    assert payloads[14] == FAKE and payloads[10] == "long " * 40_000 and payloads[1] in ("<p>b</p>", "other")
    assert sorted(r.target for r in read if r.target.startswith("u"))[:2] == ["u", "u"]


def test_records_follow_the_format(spark, tmp_path):
    warc.write_archives(frame(spark, [(7, "http://x", "hi")]).coalesce(1), f"file://{tmp_path}/warc")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "warc").glob("part-*"))
    head, _, rest = raw.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)$", head)[1])
    assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith(b"\r\n\r\nhi")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_truncated_files_are_an_error(spark, tmp_path):
    warc.write_archives(frame(spark, [(7, "http://x", "hi"), (8, "", "ho")]).coalesce(1), f"file://{tmp_path}/warc")
    (part,) = (p for p in (tmp_path / "warc").glob("part-*") if p.stat().st_size)
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(part.read_bytes()[:-9])
    with pytest.raises(ValueError, match="chain of records"):
        warc.records(spark, f"file://{tmp_path}/cut")


def test_no_pages(spark, tmp_path):
    assert warc.round_trip(frame(spark, []), f"file://{tmp_path}/warc").count() == 0
