import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from titleloom.llm import warc
from titleloom.llm.common import working_path
from titleloom.llm.warc import archived_pages, member, page_records, read_warc, record, write_warc

SCHEMA = "page_id bigint, url string, html string, record_type string, payload string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>é" + "x" * 1200
    rows = [
        (1, "http://a/b c\r\nX: y", big), (5, None, big), (5, None, big), (3, "http://a", big), (None, "http://n", big),
        (7, "http://s", "short"), (8, "http://s", "short"), (9, "u", None), (10, "u", ""), (11, "u", "y" * 3_000_000),
        (12, "u", "z\r\n\r\nz" * 300), (13, "u", "x" * 999), (14, "u", "x" * 999), (15, "ü", "x" * 1000), (16, "ü", "x" * 1000),
    ]
    return spark.createDataFrame([(*r, "revisit", "p") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def archive(spark, pages):
    path = working_path(spark, "warc")
    write_warc(page_records(pages), path)
    return path


def test_round_trip(spark, pages, archive):
    rows = [(r.page_id, r.html or "") for r in pages.collect()]
    want = []
    for page, html in rows:
        data = html.encode()
        same = [p for p, h in rows if h == html and p is not None]
        revisit = len(data) >= 1000 and bool(same) and page != max(same)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    found = [tuple(r) for r in archived_pages(spark, archive).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_archives_are_plain_gzip_of_warc(archive):
    files = list(Path(archive.removeprefix("file://")).glob("*.warc.gz"))
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC/1.1\r\n") == 15
    assert b"X: y\r\n" not in text  # a line break of a URL makes no header


def test_predicates_reach_the_scan(spark, archive, pages):
    rows = read_warc(spark, archive).filter((F.col("record_type") == "response") & F.col("target_uri").startswith("http://s"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")  # nothing is left for Spark to filter
    assert rows.count() == 2


def test_unwanted_payloads_are_not_inflated(spark, archive, monkeypatch):
    reader = warc.WarcReader({"path": archive}, None)
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")])) == []
    inflated = []
    monkeypatch.setattr(warc.Records, "whole", lambda self, size: inflated.append(self) or b"")
    rows = sum(len(b) for part in reader.partitions() for b in reader.read(part))
    assert rows == archived_pages(spark, archive).filter("record_type = 'revisit'").count() and not inflated


def test_archives_of_others(spark, tmp_path):
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x-page:4>", "Content-Type": "application/http; msgtype=response"}
    one = record(fields, {"Content-Type": "text/plain", "Content-Length": "2"}, b"hi")
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(one) + member(one) + gzip.compress(one * 1))
    found = read_warc(spark, str(tmp_path)).orderBy("record_type").collect()
    assert [(r.record_type, r.payload_bytes, bytes(r.payload)) for r in found] == [("response", 2, b"hi")] * 3 + [("warcinfo", 3, b"a:b")]


def test_empty(spark):
    path = working_path(spark, "warc")
    write_warc(page_records(spark.createDataFrame([], SCHEMA)), path)
    assert archived_pages(spark, path).count() == 0


def foreign(n, **http):
    """Records of another writer, and what a reader has to find."""
    records, want = [], []
    for i in range(n):
        payload = (b"payload \r\n\r\nWARC/1.0 \x1f\x8b" + bytes([i % 251])) * (i * 37 % 90)
        fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:{i}>", "Content-Type": "application/http"}
        records.append(record(fields, {"Content-Type": "text/html"} | http, payload))
        want.append((f"<urn:{i}>", len(payload), payload))
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    return [info, *records], [(None, 4, b"a: b"), *want]


def found(spark, path, **options):
    reader = warc.register(spark).read.format("warc").options(**options)
    return reader.load(f"file://{path}").select("record_id", "payload_bytes", "payload")


def as_rows(frame):
    return sorted((r.record_id or "", r.payload_bytes, bytes(r.payload)) for r in frame.collect())


FORMS = {
    "plain.warc": lambda records: b"".join(records),
    "each.warc.gz": lambda records: b"".join(map(gzip.compress, records)),
    "three.warc.gz": lambda records: b"".join(gzip.compress(b"".join(records[i : i + 3])) for i in range(0, len(records), 3)),
    "one.warc.gz": lambda records: gzip.compress(b"".join(records)),
    "across.warc.gz": lambda records: b"".join(gzip.compress(b"".join(records)[i : i + 777]) for i in range(0, len(b"".join(records)), 777)),
    "skips.warc.gz": lambda records: b"".join(member(b"".join(records[i : i + 2])) for i in range(0, len(records), 2)),
    "mixed.warc.gz": lambda records: b"".join((member if i % 3 else gzip.compress)(one) for i, one in enumerate(records)),
}


@pytest.mark.parametrize("name", FORMS)
def test_archives_of_other_writers(spark, tmp_path, name):
    """Several records in a member, records over several members, and no members at all."""
    records, want = foreign(60)
    (tmp_path / name).write_bytes(FORMS[name](records))
    want = sorted((i or "", n, payload) for i, n, payload in want)
    assert as_rows(found(spark, tmp_path)) == want
    some = found(spark, tmp_path).filter("record_id IN ('<urn:7>', '<urn:59>')")
    assert as_rows(some) == [row for row in want if row[0] in ("<urn:7>", "<urn:59>")]
    none = found(spark, tmp_path, payload="false")
    assert sorted((r.record_id or "", r.payload_bytes) for r in none.collect()) == [row[:2] for row in want]


def test_coded_payloads_have_their_stored_size(spark, tmp_path):
    """Chunked and compressed responses: the HTTP header speaks of another length."""
    records, want = foreign(9, **{"Content-Length": "5", "Transfer-Encoding": "chunked"})
    (tmp_path / "a.warc.gz").write_bytes(FORMS["each.warc.gz"](records))
    assert as_rows(found(spark, tmp_path)) == sorted((i or "", n, payload) for i, n, payload in want)


def test_a_large_archive_is_read_by_several_tasks(spark, tmp_path):
    records, want = foreign(300)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(member, records)))
    (tmp_path / "b.warc.gz").write_bytes(FORMS["one.warc.gz"](records))
    for size in (200, 2000, 10_000):
        frame = found(spark, tmp_path, partitionBytes=str(size))
        assert frame.rdd.getNumPartitions() > 5
        assert as_rows(frame) == sorted(2 * [(i or "", n, payload) for i, n, payload in want])


def test_heads_without_bodies_and_blank_lines(spark, tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n"
    blocks = [b"", b"HTTP/1.1 204 No\r\nX: y", b"HTTP/1.1 200 OK\r\n\r\n", b"HTTP/1.1 200 OK\r\n\r\n\r\n\r\n"]
    text = b"\r\n".join(head % (i, len(block)) + block + b"\r\n\r\n" for i, block in enumerate(blocks)) + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(text)
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    assert as_rows(found(spark, tmp_path)) == [("<0>", 0, b""), ("<1>", 0, b""), ("<2>", 0, b""), ("<3>", 4, b"\r\n\r\n")]
    (tmp_path / "cut.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: resp")
    with pytest.raises(Exception, match="within its header"):
        found(spark, tmp_path).collect()
