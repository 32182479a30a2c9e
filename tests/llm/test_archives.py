from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm import archives

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = i is not None and html in first and i > first[html]
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 5000)
    rng = random.Random(3)
    same = ["<p>é</p>" * 20, "x" * 100, "y" * 99, "WARC/1.1\r\n\r\n" * 20]
    rows = [(i, f"http://h/{i}\r\n x", rng.choice([*same, None, "", f"<i>{i}</i>" * rng.randint(0, 200)])) for i in range(300)]
    rows += [(-5, None, same[0]), (None, None, same[0]), (7, "u", "z" * 200), (7, "u", "z" * 200), (8, "u", "z" * 200), (9, "u", "big " * 500_000)]
    pages = spark.createDataFrame(rows, PAGES).repartition(4).withColumn("digest", F.lit("x")).withColumn("refers_to", F.lit("x"))
    assert found(archives.archive_pages(pages, folder=str(tmp_path / "w"))) == brute(rows)
    whole, members = list((tmp_path / "w/monolithic").glob("*.gz")), list((tmp_path / "w/records").glob("*.gz"))
    assert len(whole) == len(members) > 4
    count = 0
    for path in members:
        data, places = path.read_bytes(), [tuple(map(int, x.split())) for x in (path.parent / f"{path.name}.idx").read_text().splitlines()]
        assert sum(n for _, n in places) == len(data)
        for at, n in places:
            inflate = zlib.decompressobj(31)
            text = inflate.decompress(data[at:at + n])
            assert inflate.eof and not inflate.unused_data and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            count += 1
    assert count == len(rows)
    assert sorted(gzip.decompress(p.read_bytes()) for p in whole) == sorted(gzip.decompress(p.read_bytes()) for p in members)


def test_join_by_digest_and_empty(spark, monkeypatch):
    monkeypatch.setattr(archives, "broadcast_if_small", lambda df: df)
    rows = [(i, "u", "same " * 30) for i in range(20)]
    pages = spark.createDataFrame(rows, PAGES)
    assert found(archives.archive_pages(pages)) == brute(rows)
    assert archives.archive_pages(pages.limit(0)).count() == 0


def test_normaliser_reads_any_cut_and_refuses_damage():
    data = [archives.record("response", i, "u", b"x" * i * 50, "d", None, i * 50) for i in range(30)]
    whole = b"".join(data)
    for width in (1, 7, 1000, len(whole)):
        assert list(archives.records(iter([whole[k:k + width] for k in range(0, len(whole), width)]))) == data
    with pytest.raises(ValueError):
        list(archives.records(iter([whole[:-3]])))
    import io
    two = gzip.compress(whole[:500]) + gzip.compress(whole[500:])
    assert b"".join(archives.inflated(io.BytesIO(two))) == whole
    with pytest.raises(ValueError):
        list(archives.inflated(io.BytesIO(gzip.compress(whole)[:-20])))


def test_an_archive_is_a_task(spark):
    names = spark.range(1000).selectExpr("concat('pages-', id, '.warc.gz') AS archive").repartition(3)
    dealt = archives.one_a_task(names).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 600 and max(r["count"] for r in dealt) <= 3
