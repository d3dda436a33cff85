"""WARC archives: exact round trips, record structure, revisits."""

import base64
import gzip
import hashlib
import os

import pytest

from emberstat.llm import common
from emberstat.llm.warc import END, VERSION, read_archives, resolve_revisits, write_archives
from emberstat.session import scratch_path

SEP = END + VERSION
PAYLOADS = [None, "", "<p>a</p>", "<p>a</p>", "é漢😀", SEP, SEP * 3, f"x{SEP}y", f"x{END}WARC/1.1", END, f"{END}\r\nWARC/1.1\r\n", f"WARC/1.1\r\nWARC-Type: response{END}z",
            "x" * 3_000_000, "\r\n", "\n\n", "a\x00b", f"<p>a</p>{END}", "<p>a</p>"]


def sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://h/{i}" if i % 4 else None, p, "extra") for i, p in enumerate(PAYLOADS)]
    rows += [(None, "http://h/a b\r\nX: y", "<p>a</p>", "e"), (17, "http://h/17", "<p>a</p>", "e")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("parts", [1, 3])
def test_round_trip(spark, pages, parts):
    path = scratch_path(spark, "archives")
    write_archives(pages.repartition(parts), path)
    records = read_archives(spark, path)
    read = {(r["page_id"], r["record_id"]): r for r in records.collect()}
    assert len(read) == pages.count() and len({k for _, k in read}) == len(read)
    resolved = resolve_revisits(records).collect()
    text = {str(i): p or "" for i, p in enumerate(PAYLOADS)} | {None: "<p>a</p>"}
    last = {}
    for i, t in enumerate(PAYLOADS):
        last[t or ""] = str(i)
    for r in resolved:
        full = read[r["page_id"], r["record_id"]]
        t = text[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(t.encode()), sha(t))
        if r["record_type"] == "response":
            assert r["refers_to"] is None and full["payload"] == t and full["intact"] and r["page_id"] == last[t]
        else:
            assert full["payload"] is None and r["refers_to"] == last[t]
    assert sum(r["record_type"] == "response" for r in resolved) == len(last)  # each payload once, also with its page repeated
    urls = {r["url"] for r in resolved}
    assert "http://h/a b%0D%0AX: y" in urls and None in urls


def test_small_payloads_are_not_revisited(spark, pages):
    path = scratch_path(spark, "archives")
    write_archives(pages, path, least_bytes=9)
    kinds = {r["page_id"]: r["record_type"] for r in resolve_revisits(read_archives(spark, path)).filter("page_id < 4").collect()}
    assert set(kinds.values()) == {"response"}


def test_files_are_standard_records(spark, pages):
    path = scratch_path(spark, "archives")
    write_archives(pages.filter("page_id IN (2, 3)"), path)
    folder = path.removeprefix("file://").removeprefix("file:")
    data = b"".join(gzip.open(os.path.join(folder, f)).read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    records = [r for r in data.split(b"WARC/1.1\r\n") if r]
    assert len(records) == 2
    for r in records:
        head, _, block = r.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
        assert block[int(fields["Content-Length"]) :] == b"\r\n\r\n"
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Type"} <= set(fields)
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit") == ("WARC-Profile" in fields)


def test_empty_table_and_broken_archive(spark, pages):
    path = scratch_path(spark, "archives")
    write_archives(pages.limit(0), path)
    assert resolve_revisits(read_archives(spark, path)).count() == 0
    broken = scratch_path(spark, "broken")
    spark.createDataFrame([("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort",)], "value string").write.option("compression", "gzip").text(broken)
    with pytest.raises(Exception, match="ends within a record"):
        read_archives(spark, broken).collect()


def test_hot_groups_join_like_plain_ones(spark):
    rows = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id div 7) END AS k")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "rows").withColumn("twin", common.F.upper("k"))
    plain = {tuple(r) for r in rows.join(groups, "k").select("id", "k", "rows", "twin").collect()}
    split = common.join_groups(rows, groups, "k", "rows", 64, limit=0).select("id", "k", "rows", "twin").collect()
    assert len(split) == 20_000 and {tuple(r) for r in split} == plain
