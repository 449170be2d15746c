import gzip
import hashlib
import io
import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from oracle_compare import duck, duck_digest, spark_digest
from strata.llm import warc
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_query_matches_oracle(spark):
    got = spark_digest(QUERIES["op4_warc"](spark, SF))
    assert got == duck_digest(duck(SF), ORACLE_SQL["op4_warc"])


def files(path):
    return {f: hashlib.sha256(open(f"{path}/{f}", "rb").read()).hexdigest()
            for f in os.listdir(path) if f.endswith(".warc.gz")}


def test_files_depend_on_the_rows_alone(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    m = warc.write(pages, a, shards=3, roll_bytes=20_000)
    warc.write(pages.repartition(7, F.rand(3)), b, shards=3, roll_bytes=20_000)
    assert files(a) == files(b)
    rows = m.collect()
    assert {r.file: r.sha256 for r in rows} == files(a)
    assert sum(r.records for r in rows) == 250 and len({r.shard for r in rows}) == 3
    assert max(r.part for r in rows) >= 2  # files were rolled
    assert not os.listdir(f"{a}/_temporary")
    # page ids ascend through the files in name order
    seen = []
    for f in sorted(files(a)):
        with gzip.open(f"{a}/{f}") as s:
            seen += [int(h["WARC-Page-ID"]) for h, _ in warc._records(s)]
    assert seen == sorted(seen)


def test_round_trip(spark, tmp_path):
    big = "x" * 2_000_000
    rows = [(1, "http://a/", "é" * 600, 0), (3, None, "é" * 600, 0), (2, "http://b\r\nX: y", "é" * 600, 0),
            (4, "u", "short", 0), (5, "u", "short", 0), (6, "u", None, 0), (7, "u", "", 0), (8, "u", big, 0),
            (None, "u", big, 0), (9, "u", "y" * 1000, 0), (9, "u", "y" * 1000, 0), (None, "v", "z" * 1000, 0),
            (10, "u", "\r\n\r\nWARC/1.1\r\n" * 100, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n int")
    path = str(tmp_path / "w")
    got = warc.read(warc.write(df, path, shards=2), path).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    text = {(k, h or "") for k, _, h, _ in rows}
    for r in got:
        if r.record_type == "response":
            assert (r.page_id, r.payload.decode()) in text
            assert r.payload_digest == hashlib.sha1(r.payload).hexdigest()
            assert r.payload_bytes == len(r.payload)
    kinds = {k: sorted((r.record_type, r.refers_to, r.payload_bytes) for r in v) for k, v in by.items()}
    assert kinds[1] == [("revisit", 3, 1200)] and kinds[2] == [("revisit", 3, 1200)]
    assert kinds[3] == [("response", None, 1200)] and kinds[4] == kinds[5] == [("response", None, 5)]
    assert kinds[6] == kinds[7] == [("response", None, 0)] and kinds[8] == [("response", None, 2_000_000)]
    assert kinds[9] == [("response", None, 1000)] * 2
    assert sorted(map(str, kinds[None])) == sorted(map(str, [("revisit", 8, 2_000_000), ("response", None, 1000)]))
    assert {r.url for r in by[2]} == {"http://b X: y"} and {r.url for r in by[3]} == {None}


def test_revisits_name_their_response_record(spark, tmp_path):
    """Readers that know the standard alone find the response of a revisit."""
    same = "é" * 600
    rows = [(1, "http://a/", same), (3, "http://c/\n1", same), (3, "http://b/", same), (2, None, same),
            (None, "http://n/", same), (7, "u", "z" * 1000), (8, None, "z" * 1000), (9, "v", "short"), (10, "v", "short")]
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), path, shards=2)
    heads = []
    for f in files(path):
        with gzip.open(f"{path}/{f}") as s:
            heads += [h for h, _ in warc._records(s)]
    response = {h["WARC-Record-ID"]: h for h in heads if h["WARC-Type"] == "response"}
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(heads) == len(rows) and len(revisits) == 4
    for h in revisits:
        to = response[h["WARC-Refers-To"]]
        assert to["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and to["WARC-Date"] == h["WARC-Refers-To-Date"]
        assert to["WARC-Page-ID"] == h["WARC-Refers-To-Page"]
        assert to.get("WARC-Target-URI") == h.get("WARC-Refers-To-Target-URI")


def test_empty_table_and_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a" * 3000)], "page_id long, url string, html string")
    none = str(tmp_path / "none")
    assert warc.read(warc.write(df.limit(0), none), none).count() == 0
    path = str(tmp_path / "d")
    m = warc.write(df, path)
    file = f"{path}/{m.first().file}"
    data = gzip.decompress(open(file, "rb").read()).replace(b"aaaa", b"bbbb", 1)
    out = gzip.compress(data)
    pafs.LocalFileSystem().open_output_stream(file).write(out)
    with pytest.raises(Exception, match="manifest|differs"):
        warc.read(m, path).collect()


def test_a_lost_attempt_leaves_nothing(spark, tmp_path):
    """Naming files again after a first try changes nothing."""
    df = spark.read.parquet(f"{SF}/pages.parquet")
    path = str(tmp_path / "p")
    m = warc.write(df, path, shards=2)
    fs, folder = pafs.FileSystem.from_uri(warc._where(spark, path))
    assert {r.file for r in m.collect()} == {os.path.basename(f.path) for f in fs.get_file_info(
        pafs.FileSelector(folder)) if f.path.endswith(".gz")}


def test_a_task_for_each_file(spark, tmp_path):
    """Files are read and named in as many tasks as there are, not in one."""
    df = spark.read.parquet(f"{SF}/pages.parquet")
    path = str(tmp_path / "p")
    m = warc.write(df, path, shards=8)
    assert m.count() == 8
    back = warc.read(m, path)
    assert back.rdd.getNumPartitions() == 8
    held = back.withColumn("t", F.spark_partition_id()).groupBy("t").agg(F.count_distinct("file")).collect()
    assert len(held) == 8 and {r[1] for r in held} == {1}
    assert back.count() == df.count()


def test_records_reader_rejects_other_data():
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc._records(io.BytesIO(b"hello\r\n")))
