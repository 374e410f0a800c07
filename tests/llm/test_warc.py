from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from hazardgrid.llm.warc import HEADS, Files, WarcReader, archived_pages, member, page_records, read_warc, record, records, write_warc

from .helpers import clashing, rows


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(pages):
    out = []
    for page, _, text in pages:
        payload = (text or "").encode()
        same = [p for p, _, t in pages if (t or "") == (text or "") and p is not None]
        first = min(same, default=None)
        revisit = first is not None and page != first
        out.append((page, len(payload), sha(payload), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


PAGES = [(5, "http://a/ü x", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (9, None, None), (3, "u\r\nWARC-Type: x", ""), (-4, "v", "x" * 100000), (8, "v", "\r\n\r\nWARC/1.1\r\n\r\n"), (7, "w", "<p>é</p>"), (None, "n", "only"), (None, "n", "<p>é</p>")]


@pytest.fixture()
def pages(spark):
    return clashing(spark.createDataFrame(PAGES, "page_id long, url string, html string"))


def test_round_trip(spark, pages, tmp_path):
    found = archived_pages(pages, f"file://{tmp_path}/a")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(rows(found, *names), key=str) == brute(PAGES)
    read = read_warc(spark, f"{tmp_path}/a", payload=True).collect()
    kept = {r["payload"] for r in read if r["warc_type"] == "response"}
    assert kept == {(t or "").encode() for _, _, t in PAGES}
    assert all((r["payload"] is None) == (r["warc_type"] == "revisit") for r in read)


def test_edges(spark, pages, tmp_path):
    assert rows(archived_pages(pages.limit(0), f"{tmp_path}/none")) == []
    twice = spark.createDataFrame([(1, "u", "a"), (1, "u", "a")], "page_id long, url string, html string")
    assert rows(archived_pages(twice, f"{tmp_path}/twice"), "page_id", "record_type") == [(1, "response")] * 2
    large = {r["record_id"] for r in page_records(pages, least=10).filter("warc_type = 'revisit'").collect()}
    assert len(large) == 0


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = [(r["page_id"], r["url"], r["html"]) for r in table.collect()]
    found = archived_pages(table)
    assert sorted(rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), key=str) == brute(pages)


def test_predicates_reach_the_files(spark, pages, tmp_path):
    write_warc(page_records(pages), f"{tmp_path}/a")
    some = read_warc(spark, f"{tmp_path}/a", payload=True).filter("warc_type = 'revisit' AND payload_bytes > 3 AND target_uri LIKE 'http%'")
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
    assert [r["target_uri"] for r in some.collect()] == ["http://a/ü x"]
    kept = read_warc(spark, f"{tmp_path}/a").filter("length(warc_type) = 7")
    assert kept.count() == 4 and "payload" not in kept.columns


def archive():
    return [record("response", f"<urn:{i}>", b"p" * n, f"http://x/{i}", "D", n, None, "2024-01-01T00:00:00Z") for i, n in enumerate((0, 5, 70000, 3))]


@pytest.mark.parametrize("data", [b"".join(archive()), b"".join(map(gzip.compress, archive())), b"".join(map(member, archive()))])
@pytest.mark.parametrize("payload", [True, False])
def test_archives_of_any_form(data, payload):
    file = io.BufferedReader(io.BytesIO(data), 64)
    found = list(records(file, len(data), payload=payload))
    assert [r[HEADS.index("record_id")] for r in found] == [f"<urn:{i}>" for i in range(4)]
    assert [r[HEADS.index("payload_bytes")] for r in found] == [0, 5, 70000, 3]
    assert [r[-1] for r in found] == ([b"p" * n for n in (0, 5, 70000, 3)] if payload else [None] * 4)
    wanted = list(records(io.BytesIO(data), len(data), lambda r: r["record_id"] == "<urn:3>", payload))
    assert len(wanted) == 1 and wanted[0][-1] == (b"ppp" if payload else None)


@pytest.mark.parametrize("pack", [bytes, gzip.compress, member])
@pytest.mark.parametrize(("block", "size", "body"), [
    (b"HTTP/1.1 200 OK\r\nA: b", 0, b""),  # cut off within its head
    (b"HTTP/1.1 200 OK\nContent-Length: 3\n\nabc", 3, b"abc"),
    (b"HTTP/1.1 200 OK\r\nContent-Length: abc\r\n\r\nabcd", 4, b"abcd"),
    (b"HTTP/1.1 200 OK\r\nContent-Length: -7\r\n\r\nab", 2, b"ab"),
    (b"HTTP/1.1 200 OK\r\n\r\n", 0, b""),
    (b"", 0, b""),
    (b"no head at all " * 200000, 0, b""),
])
def test_odd_http_blocks(pack, block, size, body):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <odd>\r\nContent-Type: application/http; msgtype=response\r\n" + f"Content-Length: {len(block)}\r\n\r\n"
    data = pack(head.encode() + block + b"\r\n\r\n") + pack(archive()[1])
    found = list(records(io.BytesIO(data), len(data), payload=True))
    assert [(r[HEADS.index("record_id")], r[HEADS.index("payload_bytes")], r[-1]) for r in found] == [("<odd>", size, body), ("<urn:1>", 5, b"p" * 5)]
    assert len(list(records(io.BytesIO(data), len(data)))) == 2


def test_members_are_plain_gzip():
    data = [member(b"a" * 1000), member(b"")]
    assert gzip.decompress(data[0]) == b"a" * 1000 and gzip.decompress(b"".join(data)) == b"a" * 1000


def test_unwanted_payloads_stay_unread():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    import os

    data = member(record("response", "<a>", os.urandom(1 << 20), "u", "D", 1 << 20, None, "d")) + member(record("response", "<b>", b"x", "u", "D", 1, None, "d"))
    file = Counted(data)
    assert len(list(records(file, len(data)))) == 2
    assert file.taken < 1 << 15


def test_files_are_planned_by_size(tmp_path):
    for i, n in enumerate((10, 10, 100, 10)):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * n)
    planned = WarcReader({"path": str(tmp_path), "split_bytes": "25"}).partitions()
    assert sorted(sum(s for _, s in p.files) for p in planned) == [10, 20, 100]
    assert [isinstance(p, Files) for p in planned] == [True] * 3


def test_what_lost_attempts_left_is_not_read(spark, pages, tmp_path):
    write_warc(page_records(pages), f"{tmp_path}/a")
    n = read_warc(spark, f"{tmp_path}/a").count()
    (tmp_path / "a" / "part-lost.warc.gz").write_bytes(b"broken")
    assert read_warc(spark, f"{tmp_path}/a").count() == n == len(PAGES)
