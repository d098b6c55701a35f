import gzip
import hashlib

from pyspark.sql import functions as F

from pricelens.llm import warc as W


def test_ranges_join_neighbours_up_to_a_bound():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 500, 10), ("b", 510, 5)]
    assert [len(r) for r in W._ranges(rows, gap=5, most=100)] == [3, 1, 1]
    assert [len(r) for r in W._ranges(rows, gap=5, most=20)] == [2, 1, 1, 1]
    assert list(W._ranges([], 5, 5)) == []


def test_archives_are_plain_warc_and_round_trip(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    pages = pages.union(pages.select(F.col("page_id") + 1000, "url", "html"))
    index = W.write_archives(pages, folder=str(tmp_path / "w"))
    rows = {r["id"]: r for r in index.collect()}
    assert len(rows) == 500
    for r in list(rows.values())[::50]:
        with open(r["file"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            raw = gzip.decompress(f.read(r["length"]))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and r["url"].encode() in raw
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {int(r["id"]): r for r in W.read_records(index).collect()}
    for pid, r in got.items():
        assert r["payload_digest"] == hashlib.sha256(html[pid].encode()).hexdigest()
        assert r["payload_bytes"] == len(html[pid].encode())
        assert (r["type"], r["refers"]) == (("revisit", str(pid - 1000)) if pid >= 1000 else ("response", None))
        assert r["payload"] == (None if pid >= 1000 else bytearray(html[pid].encode()))


def test_a_selection_reads_only_its_records(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    index = W.write_archives(pages)
    assert {r["id"] for r in W.read_records(index.where("id in ('3', '77')")).collect()} == {"3", "77"}


def test_odd_rows_and_empty_table(spark):
    long = "x" * 150
    pages = spark.createDataFrame(
        [(1, "u", long, 9), (1, "v", long, 9), (2, None, long, 9), (None, "n\r\nline", long, 9),
         (3, "s", "short", 9), (4, "s", "short", 9), (5, None, None, 9), (6, "e", "", 9),
         (7, "é", "é" * 60, 9), (8, "big", "y" * 3_000_000, 9)],
        "page_id long, url string, html string, offset int")
    got = sorted(((r["id"], r["url"], r["type"], r["refers"], r["payload_bytes"]) for r in
                  W.read_records(W.write_archives(pages)).collect()), key=str)
    assert got == sorted([
        ("1", "u", "response", None, 150), ("1", "v", "response", None, 150), ("2", "", "revisit", "1", 150),
        (None, "n%0D%0Aline", "revisit", "1", 150), ("3", "s", "response", None, 5), ("4", "s", "response", None, 5),
        ("5", "", "response", None, 0), ("6", "e", "response", None, 0), ("7", "é", "response", None, 120),
        ("8", "big", "response", None, 3_000_000)], key=str)
    assert W.read_records(W.write_archives(pages.where("false"))).count() == 0
