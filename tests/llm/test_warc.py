import gzip

from pyspark.sql import functions as F

from hourlake.llm import common, warc

SCHEMA = "page_id long, url string, html string, archive string, largest long, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "p") for r in rows], SCHEMA)


ROWS = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "other é"), (4, "http://c/\r\nX: y", None), (5, "u", ""), (None, "n", "same"), (None, "m", "alone"), (3, None, "other é"), (9, "long", "x" * 3_000_000)]


def test_round_trip(spark, tmp_path):
    index = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/w")
    got = warc.read_archives(index).collect()
    assert len(got) == len(ROWS)
    for r in got:
        html = {h for i, u, h in ROWS if i == r["page_id"] and (i is not None or u == r["url"])}.pop() or ""
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == warc.digest_of(html.encode())
        if r["record_type"] == "response":
            assert r["payload"].decode() == html and r["refers_to"] is None
    kinds = {(r["page_id"], r["url"]): (r["record_type"], r["refers_to"]) for r in got}
    assert kinds[1, "http://a/"] == ("revisit", 2) and kinds[2, "http://b/"] == ("response", None) and kinds[None, "n"] == ("revisit", 2)
    assert kinds[4, "http://c/%0D%0AX: y"] == ("revisit", 5) and kinds[5, "u"] == ("response", None)
    assert kinds[3, None] == ("response", None) and kinds[None, "m"] == ("response", None)


def test_archives_are_whole_gzip_files(spark, tmp_path):
    index = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/w").collect()
    for path in (tmp_path / "w").iterdir():
        data = gzip.decompress(path.read_bytes())
        assert data.count(b"WARC/1.1\r\n") == sum(r["archive"].endswith(path.name) for r in index)
    one = index[0]
    assert warc.parse_record(open(one["archive"].removeprefix("file://"), "rb").read()[one["offset"] : one["offset"] + one["length"]])["page_id"] == one["page_id"]


def test_selection_and_least_payload(spark, tmp_path):
    index = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/w", least_payload=5)
    assert index.where("record_type = 'revisit'").count() == 0
    some = warc.read_archives(index.where("page_id in (1, 9)").union(index.where("page_id = 1")))
    assert sorted(r["page_id"] for r in some.select("page_id").collect()) == [1, 1, 9]
    assert warc.read_archives(index.limit(0)).count() == 0


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, ROWS).limit(0)).count() == 0


def test_shared_folder(spark):
    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert common.stored(spark.range(3).select(F.col("id")), "t").count() == 3
