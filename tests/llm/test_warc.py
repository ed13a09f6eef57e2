import hashlib
from collections import defaultdict

import pytest

from touchline.llm import warc
from touchline.session import fresh_dir


@pytest.fixture
def pages(spark, tmp_path):
    def make(rows, name="pages"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "page_id long, html string").repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


def rows_of(spark, frame, **sizes):
    folder = fresh_dir(spark, "archives")
    names = warc.write_archives(frame, folder, **sizes)
    return warc.read_archives(names, folder, with_payload=True).collect()


def test_round_trip(spark, pages):
    big, small = "é<p>x</p>" * 900, "tiny"
    rows = [(i, big) for i in (3, 9, 5)] + [(1, small), (2, small), (4, None), (6, ""), (7, big + "!")]
    rows += [(20 + i, f"page {i} " * (40 * i)) for i in range(30)] + [(None, "x" * 1200), (60, "0\r\n\r\nWARC/1.1\r\n" * 200)]
    got = {r.page_id: r for r in rows_of(spark, pages(rows), segment=700, limit=4000)}
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, h in rows:
        groups[h or ""].append(i)
    for i, h in rows:
        body, r = (h or "").encode(), got[i]
        last = max(groups[h or ""]) if len(body) >= 1000 and i is not None else i
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if i == last else ("revisit", last))
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == body


def test_repeated_rows_and_empty_table(spark, pages):
    got = rows_of(spark, pages([(1, "y" * 1000)] * 3 + [(None, "y" * 1000)]))
    assert sorted(r.record_type for r in got) == ["response", "revisit", "revisit", "revisit"]
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}
    assert rows_of(spark, pages([], "none")) == []


def test_chunked_framing():
    for body in (b"", b"a", b"\r\n" * 9, b"0\r\n\r\n" * 5):
        assert warc.dechunked(warc.chunked(body, 4)) == body
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nab\r\n0\r\n\r\n")


def test_missing_segment_is_an_error(spark):
    columns = "kind string, origin string, number int, total long, uri string, digest string, payload_length long, refers_to string, block binary"
    whole = [("response", "a", 1, None, "u", "d", 4, None, b"ab"), ("continuation", "a", 2, 4, "u", None, None, None, b"cd")]
    assert bytes(warc.reassemble(spark.createDataFrame(whole, columns)).first().block) == b"abcd"
    for broken in (whole[:1], whole[1:]):
        with pytest.raises(Exception, match="missing or of the wrong length"):
            warc.reassemble(spark.createDataFrame(broken, columns)).collect()
