"""WARC archives and their two-level capture index (operator 4).

``write_archives`` writes one WARC/1.1 record per page as text files of whole records (the record end is the writer's
line separator), so any Hadoop file system takes them and a lost executor's files are written again.  Of pages with equal
payloads of at least ``least`` bytes the one with the smallest id is the response and the others are
revisit records that name it; every other page is a response.

``read_archives`` streams through each file, one record at a time, by its Content-Length.  ``build_index`` sorts the
captures by reversed-host URL key and page into compressed blocks and keeps a sparse directory of each block's first and last
key.  ``resolved`` follows every revisit to its response inside tasks: the distinct targets find their block by binary
search in the directory (broadcast: its entries and the length of a key are bounded), meet the block, find their capture by binary
search there, and read just its byte range; payload bytes and digest of a revisit come from that payload, which has to
be what the revisit says.  A response that a third of the pages repeat is one target.  ``lookup`` and ``read_record`` do the same
for a few URL keys from the driver.

Tasks open archives through Arrow's file systems (a shared mount, HDFS, object stores), since Spark's own binary source
reads whole files, 2 GB at most.

Edge cases: a null html is an empty payload; a null or empty url has the key ``)/``; a key beyond ``KEY_CHARS`` characters ends in
a digest of its whole; characters that would break a header are
percent-encoded; a null page id is written as ``null``; rows that repeat an id are separate records
(those that share the smallest id of equal payloads are all responses); a payload may be as long as Spark's strings, and a
task holds one; an empty table gives empty archives and an empty index; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import bounded_batches, kept, shuffle_parts

LEAST_BYTES = 100
RECORDS_PER_FILE = 2000
BLOCK_LINES = 3000
#: Entries of the directory at most: blocks grow beyond BLOCK_LINES where there are more captures.
DIRECTORY_ENTRIES = 1 << 16
KEY_CHARS = 256
END = "\r\n\r\n"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "refers_url string, file string, offset long, length long")
CAPTURES = ("url_key string, page_id long, url string, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, refers_key string, file string, offset long, length long")
BLOCKS = "number long, first_key string, first_page long, last_key string, last_page long, captures int, block binary"
TARGETS = "refers_key string, refers_to long, payload_digest string, payload_bytes long"
NAMES = [c.split()[0] for c in CAPTURES.split(", ")]
ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def rows_of(rows: list, schema: str) -> pa.Table:
    columns = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], ARROW[kind]) for i, (name, kind) in enumerate(columns)})


def url_key(url: Column) -> Column:
    """Reversed-host key: ``https://user@www.Example.com:443/A?b#c`` to ``com,example)/a?b``."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www\d*\.|:(80|443)?$", "")
    rest = F.lower(F.regexp_replace(u, r"^[^/?]*", ""))
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    return F.when(F.length(key) > KEY_CHARS, F.concat(F.substring(key, 1, KEY_CHARS - 41), F.lit("#"), F.sha1(key))).otherwise(key)


def safe(c: Column) -> Column:
    """Header values hold no control characters or spaces."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A"), " ", "%20"), r"[\x00-\x1F\x7F]", "%3F")


def write_archives(pages: DataFrame, least: int = LEAST_BYTES, folder: str | None = None) -> str:
    """Write a record per page; returns the folder of the .warc files.

    Payloads are joined only with their duplicates' smallest id: digests are pre-aggregated and only those of several pages
    stay, so a payload shared by a third of the pages is one row there.  That table is written first: its size is known when the
    join is planned, and while it is below Spark's broadcast threshold no payload is shuffled.
    """
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("html"), F.sha2(body.cast("binary"), 256).alias("digest"), F.octet_length(body).alias("size"))
    first = kept(rows.where(F.col("size") >= least).groupBy("digest")
             .agg(F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n")).where("n > 1").drop("n"), "revisited")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", ident(F.col("page_id"))),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", safe(F.col("url")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit & F.col("first_url").isNotNull(), line("WARC-Refers-To-Target-URI", safe(F.col("first_url")))).otherwise(F.lit("")),
        F.when(revisit, F.concat(line("WARC-Refers-To", ident(F.col("first_id"))),
                                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block)
    (rows.join(first, "digest", "left").select(record.alias("value")).write.format("text")
     .option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).save(folder))
    return folder


def records(data: bytes | io.BufferedIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive, given as bytes or a stream."""
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    at = 0
    while first := stream.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError(f"no record at {at}")
        fields, length = {}, len(first) + 2
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"record at {at} ends in its headers")
            name, _, value = line[:-2].decode().partition(": ")
            fields[name] = value
            length += len(line)
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield at, length + size, fields, block
        at += length + size + 4


def page_of(ident: str | None) -> int | None:
    return None if ident is None or ident == "<urn:page:null>" else int(ident[len("<urn:page:"):-1])


def content(head: dict[str, str], block: bytes) -> tuple[int, str]:
    """Size and digest of a record's payload: of a response those of what is stored, which has to be undamaged; of a revisit the stated ones."""
    http, _, payload = block.partition(b"\r\n\r\n")
    said = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] != "response":
        return int(http.rpartition(b": ")[2]), said
    if hashlib.sha256(payload).hexdigest() != said:
        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    return len(payload), said


def open_archive(path: str) -> pa.NativeFile:
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives; payload digests are computed from the stored payload where there is one."""
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                out = []
                with io.BufferedReader(open_archive(path), 1 << 20) as stream:
                    for at, length, head, block in records(stream):
                        out.append((page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), *content(head, block), head["WARC-Type"],
                                    page_of(head.get("WARC-Refers-To")), head.get("WARC-Refers-To-Target-URI"), path, at, length))
                yield from rows_of(out, RECORDS).to_batches()

    read = archive_files(spark, folder).mapInArrow(run, RECORDS)
    return (read.withColumn("url_key", url_key(F.col("url")))
            .withColumn("refers_key", F.when(F.col("record_type") == "revisit", url_key(F.col("refers_url"))))
            .select(*NAMES))


def build_index(captures: DataFrame, n_captures: int) -> DataFrame:
    """Blocks of captures in key order, numbered in that order: the upper level is each block's first and last key.

    Range partitions by key and page (and file and offset, which split a page that is repeated) are sorted and cut into compressed blocks.
    """
    spark = captures.sparkSession
    lines = max(BLOCK_LINES, -(-n_captures // DIRECTORY_ENTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[list] = []
        for b in batches:
            held += map(list, zip(*(c.to_pylist() for c in b.columns)))
            while len(held) >= lines:
                yield from _block(number, held[:lines])
                number, held = number + 1, held[lines:]
        if held:
            yield from _block(number, held)

    order = ["url_key", "page_id", "file", "offset"]
    return (captures.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
            .mapInArrow(run, BLOCKS))


def _block(number: int, rows: list[list]) -> list[pa.RecordBatch]:
    packed = zlib.compress("\n".join(json.dumps(r) for r in rows).encode(), 6)
    return rows_of([(number, *rows[0][:2], *rows[-1][:2], len(rows), packed)], BLOCKS).to_batches()


def unpack(block: bytes) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(block).decode().split("\n")]


def scan_index(blocks: DataFrame) -> DataFrame:
    """Every capture of the index, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for packed in b.column(0):
                yield from rows_of(unpack(packed.as_py()), CAPTURES).to_batches()

    return blocks.select("block").mapInArrow(run, CAPTURES)


def place(key: str, page: int | None) -> tuple[str, int]:
    """The index's order: by key, then page, nulls first."""
    return key, -(1 << 63) - 1 if page is None else page


class Directory:
    """The upper level: ``DIRECTORY_ENTRIES`` entries and one for each partition at most, of keys of ``KEY_CHARS`` at most."""

    def __init__(self, blocks: DataFrame):
        rows = sorted(map(tuple, blocks.select("number", "first_key", "first_page", "last_key", "last_page").collect()), key=lambda r: r[0])
        self.numbers = [r[0] for r in rows]
        self.first = [place(*r[1:3]) for r in rows]
        self.last = [place(*r[3:]) for r in rows]

    def blocks(self, low: tuple[str, int], high: tuple[str, int]) -> list[int]:
        """The blocks that may hold captures between two places."""
        return self.numbers[bisect.bisect_left(self.last, low):bisect.bisect_right(self.first, high)]


def fetch(found: list[tuple]) -> Iterator[tuple]:
    """Read the byte range of each (file, offset, length, target): the target with the size and digest of the payload there."""
    at, stream = None, None
    for file, offset, length, target in sorted(found, key=lambda f: f[:2]):
        if file != at:
            if stream is not None:
                stream.close()
            at, stream = file, open_archive(file)
        stream.seek(offset)
        (_, _, head, block), = records(stream.read(length) + END.encode())
        size, digest = content(head, block)
        if page_of(head["WARC-Record-ID"]) != target[1] or digest != target[2]:
            raise ValueError(f"record at {offset} of {file} is not what its revisits refer to")
        yield (*target[:2], digest, size)
    if stream is not None:
        stream.close()


def targets(blocks: DataFrame, captures: DataFrame) -> DataFrame:
    """The responses that revisits refer to, once each, found through the directory, their block and a range read."""
    directory = blocks.sparkSession.sparkContext.broadcast(Directory(blocks))
    asked = captures.where("record_type = 'revisit'").select("refers_key", "refers_to", "payload_digest").distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, page, digest in zip(*(c.to_pylist() for c in b.columns)):
                at = place(key, page)
                rows += [(n, key, page, digest) for n in directory.value.blocks(at, at)]
            yield from rows_of(rows, "number long, refers_key string, refers_to long, payload_digest string").to_batches()

    def probe(wanted: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if wanted.num_rows:
            rows = unpack(held["block"][0].as_py())
            own = [place(*r[:2]) for r in rows]
            for key, page, digest in zip(*(wanted[c].to_pylist() for c in ("refers_key", "refers_to", "payload_digest"))):
                at = place(key, page)
                own_page = (dict(zip(NAMES, r)) for r in rows[bisect.bisect_left(own, at):bisect.bisect_right(own, at)])
                hit = next((r for r in own_page if r["record_type"] == "response" and r["payload_digest"] == digest), None)
                if hit:
                    found.append((hit["file"], hit["offset"], hit["length"], (key, page, digest)))
        return rows_of(list(fetch(found)), TARGETS)

    routed = asked.mapInArrow(route, "number long, refers_key string, refers_to long, payload_digest string")
    read = routed.groupBy("number").cogroup(blocks.select("number", "block").groupBy("number")).applyInArrow(probe, TARGETS)
    return read.distinct()  # a page that is repeated may stand in two blocks


def resolved(blocks: DataFrame) -> DataFrame:
    """Every capture of the index, the revisits with payload size and digest of the response found for them."""
    captures = scan_index(blocks)
    again = captures.where("record_type = 'revisit'").withColumnRenamed("payload_bytes", "stated")
    again = again.join(targets(blocks, captures), ["refers_key", "refers_to", "payload_digest"], "left")
    lost = F.raise_error(F.concat(F.lit("no such response for the revisit of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    size = F.when(F.col("payload_bytes") == F.col("stated"), F.col("payload_bytes")).otherwise(lost.cast("long"))
    return captures.where("record_type = 'response'").unionByName(again.withColumn("payload_bytes", size).drop("stated"))


def lookup(blocks: DataFrame, keys: list[str]) -> list[dict]:
    """Captures of a few URL keys: binary search in the directory, then in the blocks it names; only these are read."""
    directory = Directory(blocks)
    span = {k: (place(k, None), (k, 1 << 63)) for k in set(keys)}
    wanted = sorted({n for low, high in span.values() for n in directory.blocks(low, high)})
    found = []
    for row in blocks.where(F.col("number").isin(wanted)).select("block").collect() if wanted else []:
        rows = unpack(row.block)
        own = [place(*r[:2]) for r in rows]
        for low, high in span.values():
            found += [dict(zip(NAMES, r)) for r in rows[bisect.bisect_left(own, low):bisect.bisect_right(own, high)]]
    return found


def read_record(spark: SparkSession, capture: dict) -> bytes:
    """The bytes of one record: a seek and a read of its range, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(capture["file"])
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        stream.seek(capture["offset"])
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(capture["length"])))
    finally:
        stream.close()


def archive_and_index(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write the archives, read them back, index the captures; returns the index's blocks, written as a table."""
    spark = pages.sparkSession
    folder = write_archives(pages, least)
    n = sum_records(spark, folder)
    out = f"{folder}-index"
    build_index(read_archives(spark, folder), n).write.parquet(out)
    return spark.read.parquet(out)


def sum_records(spark: SparkSession, folder: str) -> int:
    """An upper bound of the records written, from the number of files."""
    return archive_files(spark, folder).count() * RECORDS_PER_FILE
