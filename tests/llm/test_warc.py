"""Archives and their index, against sorting and hashing in plain Python."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from ticketlens.llm import warc


@given(st.lists(st.lists(st.integers(0, 9)).map(sorted), max_size=9))
def test_loser_tree_merges(runs):
    merged = [(runs[r][k], r, k) for r, k in warc.LoserTree(runs).merge()]
    assert merged == sorted((x, r, k) for r, run in enumerate(runs) for k, x in enumerate(run))


def pages(spark):
    long_ = "<p>" + "copy " * 40 + "</p>"
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n" * 3
    rows = [
        (5, "http://www.b.example.org/x?a=1#top", long_), (3, "https://b.example.org/x?a=1", long_), (9, None, long_),
        (1, "http://a.example.org/", trap), (2, "http://a.example.org/", None), (4, "not a url", ""), (6, "http://A.example.org:80/", "short"),
        (7, "http://a.example.org/", "short"), (8, "http://a.example.org/ü", "größe" * 50), (3, "https://b.example.org/x?a=1", long_),
        (10, "http://z.org/\r\nX: y", trap), (11, "http://z.org/", "y" * 300_000),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, offset string").repartition(4)


def test_archives_come_back(spark):
    index = warc.archive_pages(pages(spark)).collect()
    expected = []
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages(spark).collect()]
    for page, payload in rows:
        first = min(p for p, other in rows if other == payload)
        revisit = len(payload) >= 100 and page != first
        expected.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in index]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_index_is_in_global_order(spark):
    table = warc.captures(pages(spark))
    from ticketlens.session import scratch_folder

    folder = scratch_folder(spark)
    warc.write_archives(table, folder, records_per_file=2)
    index = warc.merge_index(warc.read_archives(spark, folder), rows=12, range_rows=3)
    rows = sorted(index.collect(), key=lambda r: (r["range"], r["position"]))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in rows]
    assert len(keys) == 12 and keys == sorted(keys)
    assert len({r["archive"] for r in rows}) > 3
    assert {r["url_key"] for r in rows} >= {"org,example,b)/x?a=1", "org,example,a)/"}


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none).count() == 0
