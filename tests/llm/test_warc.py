import hashlib
import base64

from pyspark.sql import functions as F

from wayside.llm.warc import fetch_records, read_warc, with_revisits, write_warc


def rows():
    big = "<p>x</p>" * 60_000
    out = [(i, f"http://a/{i}?q= é%\r\n", f"<html>{i % 7}</html>", "junk") for i in range(60)]
    return out + [(100, None, None, "j"), (101, "u", "", None), (102, "u", big, ""), (103, "u", big + "y", ""), (None, "u", "<html>1</html>", ""), (104, "u", "a\r\n\r\nb", ""), (104, "u", "a\r\n\r\nb", "")]


def test_write_read_fetch(spark, tmp_path):
    data = rows()
    spark.createDataFrame(data, "page_id long, url string, html string, payload string").repartition(3).write.parquet(f"{tmp_path}/p")
    index = write_warc(with_revisits(spark.read.parquet(f"{tmp_path}/p")), frame_bytes=1000, bundle_bytes=300)
    got = read_warc(index).collect()
    assert len({r.record_id for r in got}) == len(data) and {r.record_id for r in got} == {r.record_id for r in index.collect()}
    tasks = read_warc(index).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == index.select("bundle").distinct().count() > 5
    first = {}
    for page, _, html, _ in data:
        k = html or ""
        if page is not None:
            first[k] = min(first.get(k, page), page)
    want = []
    for page, url, html, _ in data:
        raw = (html or "").encode()
        low = first[html or ""]
        want.append((page, url, "response" if page == low else "revisit", None if page == low else low, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), raw if page == low else None))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload))) for r in got)
    some = index.filter(F.col("page_id").isin(102, 5, 59))
    assert {(r.page_id, r.record_id) for r in fetch_records(some).collect()} == {(r.page_id, r.record_id) for r in some.collect()}


def test_min_bytes_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    assert {(r.page_id, r.revisit) for r in with_revisits(pages, 3).collect()} == {(1, False), (2, False), (3, False), (4, True)}
    assert read_warc(write_warc(with_revisits(pages.limit(0)))).count() == 0
