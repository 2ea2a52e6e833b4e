"""Shared helpers: reading tables, Arrow batch limits, text chunks with a cache."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20
ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes too, so very long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def doc_text(docs: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` long and ``text`` (null: empty) alone, so further columns of any name do no harm."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def id_remainder(id_col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null id: crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: compressed, and its lineage ends there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.parquet(path)
    table.kept_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Remove tables of ``kept`` that nothing will read again: all that was made of them is written itself."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.kept_at)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def keep_rows(docs: DataFrame, decide, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text ``decide`` keeps: Arrow text column (no nulls) to a list of booleans."""
    bounded_batches(docs.sparkSession)
    docs.sparkSession.conf.set("parquet.block.size", str(ROW_GROUP_BYTES))  # whole rows: a writer holds a row group until it is full
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(at).cast(pa.string()).fill_null("")
            yield b.filter(pa.array(decide(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def pressed(x: np.ndarray) -> bytes:
    """Numbers with equal bytes side by side, compressed."""
    x = np.ascontiguousarray(x)
    return x.dtype.str.encode() + b":" + zstandard.ZstdCompressor(1).compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())


def read(data: bytes) -> np.ndarray:
    kind, _, rest = data.partition(b":")
    t = np.dtype(kind.decode())
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(rest), np.uint8).reshape(t.itemsize, -1).T).view(t).reshape(-1)


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of a non-decreasing sequence."""
    return np.diff(x, prepend=x[:1] * 0)


def utf8_buffer(col: pa.Array):
    """Bytes of all texts of an Arrow string column (no nulls) and the offsets between them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and off[-1] else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


class ChunkCache:
    """Splits a text before every single space that a non-space follows and caches each
    chunk's encoding.

    The byte-level pattern of the rank files always ends a match there (a space joins
    the word after it), so chunks can be encoded apart.  ``encode`` maps a list
    of chunk texts to a list of bytes.  The cache is emptied at ``limit`` entries,
    which bounds a worker's memory.
    """

    CUT = re.compile(r" (?=\S)")

    def __init__(self, encode, limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self.head: dict[str, bytes] = {}
        self.tail: dict[str, bytes] = {}

    def _fill(self, cache: dict[str, bytes], parts: list[str], lead: str) -> bool:
        """Encode the parts that are not cached; False if one of them is no whole chunk."""
        new = list(set(parts).difference(cache))
        if lead and any(not p or p[0].isspace() for p in new):
            return False
        if len(cache) + len(new) > self.limit:
            cache.clear()
            new = list(set(parts))
        cache.update(zip(new, self.encode([lead + p for p in new])))
        return True

    def __call__(self, text: str) -> bytes:
        first, *parts = text.split(" ")
        try:
            return self.head[first] + b"".join(map(self.tail.__getitem__, parts))
        except KeyError:  # cached parts never begin with a space, so a hit is a whole chunk
            pass
        if first not in self.head:
            self._fill(self.head, [first], "")
        if self._fill(self.tail, parts, " "):
            return self.head[first] + b"".join(map(self.tail.__getitem__, parts))
        first, *parts = self.CUT.split(text)
        self._fill(self.head, [first], "")
        if not self._fill(self.tail, parts, " "):
            raise AssertionError("a chunk begins with a space")
        return self.head[first] + b"".join(map(self.tail.__getitem__, parts))
