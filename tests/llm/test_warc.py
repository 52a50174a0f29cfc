import base64
import gzip
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from tabsmith.llm import warc
from tabsmith.llm.common import prepare

COLUMNS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
PAGES = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "http://d/", "x" * 100_000),
         (6, "http://e/", "a\r\n\r\nb"), (None, "http://f/", "<p>é</p>"), (7, "http://a/", "lonely"), (8, "u", "same"), (8, "v", "same")]


@pytest.fixture
def pages(spark):
    prepare(spark)
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)


def _digest(text):
    return "sha1:" + base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, pages, tmp_path):
    path = warc.write_archives(pages, f"file://{tmp_path}/warc")
    got = warc.read_archives(spark, path, COLUMNS, verify=True).collect()
    assert len(got) == len(PAGES)
    largest = {}
    for i, _, html in PAGES:
        if i is not None:
            largest[html or ""] = max(largest.get(html or "", i), i)
    by_key = {(r["record_id"], r["target_uri"]): r for r in got}
    for i, url, html in PAGES:
        name = f"<urn:page:{'' if i is None else i}>"
        r = by_key[name, url and url.replace("\r", "%0D").replace("\n", "%0A")]
        first = largest[html or ""]
        assert r["payload_digest"] == _digest(html) and r["payload_length"] == len((html or "").encode())
        if i == first:
            assert r["record_type"] == "response" and bytes(r["payload"]).decode() == (html or "") and r["refers_to"] is None
        else:
            assert r["record_type"] == "revisit" and r["payload"] is None and r["refers_to"] == f"<urn:page:{first}>"


def test_filters_reach_the_reader(spark, pages, tmp_path):
    path = warc.write_archives(pages, str(tmp_path / "warc"))
    df = warc.read_archives(spark, path).filter((F.col("record_type") == "response") & F.col("target_uri").startswith("http://d"))
    assert [r["record_id"] for r in df.collect()] == ["<urn:page:5>"]
    reader = warc.WarcReader(None, {"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 3), In(("target_uri",), ("x",))]))
    assert [type(f) for f in rest] == [GreaterThan] and len(reader.tests) == 2


def test_unwanted_payloads_are_not_unpacked(monkeypatch):
    big = warc.member(warc.record({"record_type": "response", "record_id": "<a>", "payload": b"z" * 5_000_000}), 1)
    small = warc.member(warc.record({"record_type": "revisit", "record_id": "<b>", "payload": None}), 1)
    read = []

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

        def read(self, n=-1):
            data = super().read(n)
            read.append(len(data))
            return data

    incompressible = warc.member(warc.record({"record_type": "response", "record_id": "<c>", "payload": hashlib.shake_256(b"x").digest(3_000_000)}), 1)
    found = [h["warc-record-id"] for h, _ in warc.records(File(big + incompressible + small), True, lambda h: h["warc-type"] == "revisit", True)]
    assert found == ["<b>"] and sum(read) < 400_000


def test_other_writers_files(spark, tmp_path):
    prepare(spark)
    rows = [{"record_type": "response", "record_id": f"<{i}>", "payload": b"payload %d" % i * 3000} for i in range(3)]
    rows.insert(1, {"record_type": "revisit", "record_id": "<r>", "payload": None})
    folder = tmp_path / "others"
    folder.mkdir()
    (folder / "plain.warc").write_bytes(b"".join(map(warc.record, rows)))
    (folder / "members.warc.gz").write_bytes(b"".join(gzip.compress(warc.record(r)) for r in rows))
    got = warc.read_archives(spark, str(folder), "record_id string, payload binary").collect()
    assert len(got) == 8
    for r in got:
        if r["record_id"] != "<r>":
            assert bytes(r["payload"]) == b"payload %d" % int(r["record_id"][1]) * 3000
    assert warc.read_archives(spark, str(folder), "record_id string").filter("record_id = '<2>'").count() == 2
    assert sorted(r[0] for r in warc.read_archives(spark, str(folder), "record_id string, record_type string").select("record_id").collect()) == sorted(
        ["<0>", "<1>", "<2>", "<r>"] * 2)


def test_files_of_lost_tasks_are_not_read(spark, pages, tmp_path):
    path = warc.write_archives(pages, str(tmp_path / "warc"))
    (tmp_path / "warc" / "part-lost.warc.gz").write_bytes(warc.member(warc.record({"record_type": "response", "record_id": "<lost>", "payload": b""}), 1))
    assert warc.read_archives(spark, path).filter("record_id = '<lost>'").count() == 0
    assert len(json.loads((tmp_path / "warc" / warc.MANIFEST).read_text())) >= 1


def test_min_bytes_and_empty(spark, pages, tmp_path):
    path = warc.write_archives(pages, str(tmp_path / "a"), min_bytes=10_000)
    assert warc.read_archives(spark, path).filter("record_type = 'revisit'").count() == 0
    path = warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, path).count() == 0


def test_broken_digest_is_found(spark, tmp_path):
    prepare(spark)
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.warc").write_bytes(warc.record({"record_type": "response", "record_id": "<a>", "payload_digest": "sha1:NO", "payload": b"x"}))
    with pytest.raises(Exception, match="another digest"):
        warc.read_archives(spark, str(tmp_path / "x"), verify=True).collect()
