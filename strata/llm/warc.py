"""A deterministic sharded WARC writer, and its reader.

Records are range-sorted by (page id, hash of the record). The ranges come
from the records with the smallest hashes, so they depend on the data alone
and not on how it is split into partitions. Each task writes its range as
gzip members, one per record, and starts a new file once the compressed size
passes a limit. Headers and digests are made anew from the rows.

Commit. A task writes under a temporary name that no other attempt uses and
reports its files as rows; Spark's own commit decides which attempt's rows
count, in a table of candidates. Only files listed there are then given their
final names (again a job, which may be repeated), and a manifest with every
file's name, records, size and digest is written last. Readers go by the
manifest, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep, pick, python_ready, uri_of as _where

# payloads of at least so many bytes are written once, their copies as revisits
REVISIT_BYTES = 1000
ROLL_BYTES = 64 << 20
SHARD_BYTES = 16 << 20
MAX_SHARDS = 4096
# tasks that read or name files, at most; beyond it a task takes several
MAX_SPREAD = 20_000
# hash-chosen records that the ranges are cut by, about
RANGE_SAMPLE = 20_000
DATE = "2020-01-01T00:00:00Z"
_URN = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def _record_id(page_id: int | None, digest: str, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_URN, f'{page_id}|{digest}|{url}')}>"


def _sha1_32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None,
           revisit_url: str | None = None) -> bytes:
    """One WARC record; of a revisit only the HTTP header is stored, and the
    id, date and url of the response record that it refers to."""
    digest = hashlib.sha1(payload).hexdigest()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit_of is not None else http + payload
    head = [("WARC-Type", "response" if revisit_of is None else "revisit"),
            ("WARC-Record-ID", _record_id(page_id, digest, url)), ("WARC-Date", DATE)]
    if url:
        head.append(("WARC-Target-URI", " ".join(url.split())))
    if revisit_of is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_id(revisit_of, digest, revisit_url)),
                 ("WARC-Refers-To-Date", DATE), ("WARC-Refers-To-Page", str(revisit_of))]
        if revisit_url:
            head.append(("WARC-Refers-To-Target-URI", " ".join(revisit_url.split())))
    if page_id is not None:
        head.append(("WARC-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", _sha1_32(payload)), ("WARC-Payload-Length", str(len(payload))),
             ("WARC-Block-Digest", _sha1_32(block)), ("Content-Type", "application/http;msgtype=response"),
             ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES, id_col: str = "page_id",
                 url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, html, revisit_of, revisit_url)``. Of the rows with equal
    payloads of at least ``least`` bytes, those with the largest page_id are
    responses (one, unless that id is repeated) and the rest revisit it; a row
    with a null page_id revisits too, unless all have none. revisit_url is that
    response's url, of repeated ids the greatest."""
    src = pick(pages, page_id=id_col, url=url_col, html=html_col)
    src = src.withColumn("page_id", F.col("page_id").cast("long"))
    digests = src.select("page_id", "url", F.octet_length(F.coalesce("html", F.lit(""))).alias("n"),
                         F.sha1(_payload(F.col("html"))).alias("digest")).where(F.col("n") >= least)
    first = (digests.groupBy("digest", "n").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("c"))
             .where("c > 1 and first.page_id is not null")
             .select("digest", "n", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")))
    first = keep(first, "copies")
    keyed = src.withColumn("d", F.sha1(_payload(F.col("html")))).withColumn(
        "n", F.octet_length(F.coalesce("html", F.lit(""))))
    joined = keyed.alias("k").join(F.broadcast(first) if _small(first) else first,
                                   (F.col("k.d") == first["digest"]) & (F.col("k.n") == first["n"]), "left")
    again = ~F.col("k.page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "k.page_id", "k.url", "k.html", F.when(again, F.col("first_id")).alias("revisit_of"),
        F.when(again, F.col("first_url")).alias("revisit_url"))


def _small(first: DataFrame, rows: int = 100_000, size: int = 32 << 20) -> bool:
    """Are there few enough groups of copies, with urls of few enough bytes, to
    send them to every task?"""
    n, held = first.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("first_url"), F.lit(0)))).first()
    return n <= rows and (held or 0) <= size


def _ranges(rows: DataFrame, shards: int, n_rows: int, sample: int = RANGE_SAMPLE) -> Column:
    """Shard number of a row, by cuts of (page_id, row hash) at equal shares of
    the bytes of about ``sample`` rows: those whose hash falls in the share
    sample / n_rows of all hashes, so no task sends more than its share.
    Repeated rows are added up before they come to the driver."""
    if shards == 1:
        return F.lit(0)
    below = -(1 << 63) + min((1 << 64) - 1, (1 << 64) * sample // max(1, n_rows))
    chosen = (rows.where(F.xxhash64("page_id", "h") <= F.lit(below).cast("long"))
              .groupBy("page_id", "h").agg(F.sum(F.col("bytes") + 500).alias("bytes")).collect())
    keys = sorted(((r.page_id is not None, r.page_id or 0, r.h), r.bytes) for r in chosen)
    total, done, cuts = sum(b for _, b in keys), 0, []
    for key, b in keys:
        if len(cuts) + 1 < shards and done >= total * (len(cuts) + 1) / shards:
            cuts.append(key)
        done += b
    if not cuts:
        return F.lit(0)

    def key_of(known: Column, page: Column, h: Column) -> Column:
        return F.struct(known.alias("known"), page.cast("long").alias("page"), h.cast("long").alias("h"))

    at = key_of(F.col("page_id").isNotNull(), F.coalesce("page_id", F.lit(0)), F.col("h"))
    places = F.array(*[key_of(F.lit(k), F.lit(p), F.lit(h)) for k, p, h in cuts])
    return F.size(F.filter(places, lambda c: c <= at))


def _spread(files: DataFrame) -> DataFrame:
    """Rows of files in as many partitions as files, up to ``MAX_SPREAD``, dealt
    by number: a list of files is tiny, so nothing else would split it. Large
    files go round first, so no task gets two of the largest."""
    many = min(MAX_SPREAD, max(1, files.count()))
    if many == 1:
        return files.coalesce(1)
    place = F.row_number().over(Window.orderBy(F.desc("bytes"), "file"))
    return files.withColumn("__place", place).repartitionById(
        many, F.pmod("__place", F.lit(many)).cast("int")).drop("__place")


def write(pages: DataFrame, path: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES,
          level: int = 6, least: int = REVISIT_BYTES, **columns: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path`` and
    return the manifest: (file, shard, part, records, bytes, sha256).

    A null html is an empty payload; null urls and ids leave their header out.
    Rows are sorted by (page_id, row hash), null ids first; repeated rows are
    written as often as they occur. An empty table gives an empty manifest.
    Equal tables give equal files, however they are partitioned."""
    spark = pages.sparkSession
    python_ready(spark, 128)
    rows = plan_records(pages, least, **columns)
    rows = rows.withColumn("h", F.xxhash64("url", "html")).withColumn(
        "bytes", F.octet_length(F.coalesce("html", F.lit(""))))
    n_rows, total = rows.agg(F.count("*"), F.sum(F.col("bytes") + 500)).first()
    if shards is None:
        shards = min(MAX_SHARDS, max(1, -(-int(total or 0) // SHARD_BYTES)))
    base = _where(spark, path)
    run_id = uuid.uuid4().hex

    def write_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(base)
        attempt = f"{folder}/_temporary/{run_id}/{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        fs.create_dir(attempt, recursive=True)
        done: list[tuple] = []
        out = name = digest = None
        now, part, records, size = None, 0, 0, 0

        def close() -> None:
            nonlocal out, records, size
            if out is not None:
                out.close()
                done.append((f"shard-{now:05d}-{part:05d}.warc.gz", name, now, part, records, size,
                             digest.hexdigest()))
            out, records, size = None, 0, 0

        for batch in batches:
            for shard, page, url, html, again, again_url in zip(*[c.to_pylist() for c in batch.columns]):
                if shard != now:
                    close()
                    now, part = shard, 0
                elif out is not None and size >= roll_bytes:
                    close()
                    part += 1
                if out is None:
                    name = f"{attempt}/{shard:05d}-{part:05d}"
                    out, digest = fs.open_output_stream(name, compression=None), hashlib.sha256()
                member = gzip.compress(record(page, url, (html or "").encode(), again, again_url), level, mtime=0)
                out.write(member)
                digest.update(member)
                size += len(member)
                records += 1
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*done)) or [[]] * 7, [
                pa.string(), pa.string(), *[pa.int64()] * 4, pa.string()])],
            ["file", "temporary", "shard", "part", "records", "bytes", "sha256"])

    dealt = (rows.withColumn("shard", _ranges(rows, shards, n_rows, max(RANGE_SAMPLE, 32 * shards)))
             .select("shard", "page_id", "url", "html", "revisit_of", "revisit_url", "h")
             .repartitionById(shards, F.col("shard"))
             .sortWithinPartitions("shard", "page_id", "h", "url", "html")
             .select("shard", "page_id", "url", "html", "revisit_of", "revisit_url"))
    written = keep(dealt.mapInArrow(write_range, "file string, temporary string, shard long, part long, "
                                    "records long, bytes long, sha256 string"), "warc-candidates")

    def name_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for file, temporary in zip(*[batch.column(i).to_pylist() for i in (0, 1)]):
                if fs.get_file_info(temporary).type == pafs.FileType.File:
                    fs.move(temporary, f"{folder}/{file}")
                elif fs.get_file_info(f"{folder}/{file}").type != pafs.FileType.File:
                    raise FileNotFoundError(file)  # else an earlier try moved it
            yield batch.select(["file", "shard", "part", "records", "bytes", "sha256"])

    schema = "file string, shard long, part long, records long, bytes long, sha256 string"
    _spread(written).mapInArrow(name_files, schema).write.parquet(f"{path}/_manifest")
    left = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_temporary/{run_id}")  # files of lost attempts
    left.getFileSystem(spark._jsc.hadoopConfiguration()).delete(left, True)
    return spark.read.schema(schema).parquet(f"{path}/_manifest")


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC file, one at a time."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b": ")
            head[k.decode()] = v.decode()
        yield head, stream.read(int(head["Content-Length"]))


def read(manifest: DataFrame, path: str, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files: file, page_id, url, payload_bytes,
    payload_digest (lower-case hex SHA-1 of the full payload), record_type,
    refers_to, payload (null for a revisit, and without ``payloads``).

    Files are checked against the manifest, and blocks and payloads against
    their headers; what differs raises an error."""
    base = _where(manifest.sparkSession, path)
    python_ready(manifest.sparkSession, 128)
    kinds = [("file", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for file, records, size in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2)]):
                rows: list[tuple] = []
                held = seen = 0
                if fs.get_file_info(f"{folder}/{file}").size != size:
                    raise ValueError(f"{file} has not the size in the manifest")
                with fs.open_input_stream(f"{folder}/{file}", compression=None) as raw, \
                        gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 16)) as stream:
                    for head, block in _records(io.BufferedReader(stream, 1 << 16)):
                        if _sha1_32(block) != head["WARC-Block-Digest"]:
                            raise ValueError(f"{file}: a block differs from its digest")
                        payload = None
                        if head["WARC-Type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if _sha1_32(payload) != head["WARC-Payload-Digest"]:
                                raise ValueError(f"{file}: a payload differs from its digest")
                        page, refers = head.get("WARC-Page-ID"), head.get("WARC-Refers-To-Page")
                        rows.append((file, page and int(page), head.get("WARC-Target-URI"),
                                     int(head["WARC-Payload-Length"]),
                                     base64.b32decode(head["WARC-Payload-Digest"][5:]).hex(),
                                     head["WARC-Type"], refers and int(refers),
                                     payload if payloads else None))
                        held += len(block)
                        seen += 1
                        if len(rows) >= 512 or held > 8 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [k for k, _ in kinds])
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{file} has {seen} records, the manifest {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [k for k, _ in kinds])

    return _spread(manifest.select("file", "records", "bytes")).mapInArrow(
        read_files, "file string, page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary")
