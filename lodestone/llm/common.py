"""Shared helpers of the training-data operators: table access, the cluster's shared folder, and word hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whitespace of every contract here: x20 and x09-x0D; words are maximal runs of anything else.
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def wide_batches(spark: SparkSession, rows: int = 1 << 16) -> Iterator[None]:
    """Batches of many rows for what runs inside: rows of a few numbers each."""
    before = spark.conf.get(ROWS, None)
    spark.conf.set(ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(ROWS) if before is None else spark.conf.set(ROWS, before)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what a Python worker holds at once: texts may be very long, so few rows and bytes go into a batch."""
    spark.conf.set(ROWS, str(rows))
    spark.conf.set(BYTES, str(4 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset and all run in one process (tests), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodestone-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found if "://" in found or found.startswith("file:") else f"file://{os.path.abspath(found)}"


def scratch(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/lodestone/{what}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "scratch_path", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def local_path(uri: str) -> str | None:
    """The mounted path of a file: URI; None for other stores."""
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else None


def remote(uri: str):
    """pyarrow's file system and path for a URI of another store (hdfs:, s3:, s3a:, gs:)."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri("s3://" + uri[6:] if uri.startswith("s3a://") else uri)


def open_out(uri: str):
    """A stream that writes a new file; its folder is made."""
    if path := local_path(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    fs, path = remote(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path)


def open_in(uri: str):
    """A file that can be read from any place."""
    if path := local_path(uri):
        return open(path, "rb")
    fs, path = remote(uri)
    return fs.open_input_file(path)


def listed(folder: str) -> list[tuple[str, int]]:
    """(URI, size) of a folder's files."""
    if path := local_path(folder):
        return sorted((f"{folder.rstrip('/')}/{x.name}", x.stat().st_size) for x in os.scandir(path) if x.is_file()) if os.path.isdir(path) else []
    import pyarrow.fs as pafs

    fs, path = remote(folder)
    return sorted((f"{folder.rstrip('/')}/{x.base_name}", x.size) for x in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if x.is_file)


def store_put(uri: str, data: bytes) -> None:
    with open_out(uri) as out:
        out.write(data)


def store_map(uri: str) -> np.ndarray:
    """The file's bytes: memory-mapped where the shared folder is mounted, read whole from other stores."""
    if path := local_path(uri):
        return np.memmap(path, dtype=np.uint8, mode="r")
    with open_in(uri) as f:
        return np.frombuffer(f.read(), dtype=np.uint8)


def trimmed_heap() -> None:
    """Give freed memory back to the system: workers stay for later stages, and an executor's limit counts all of them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where a lambda in body reads it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(c: Column) -> Column:
    """The words of a text; null counts as empty."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORD_BREAK, -1), lambda w: w != "")


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


mix64 = _mix
_BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
EXACT = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_LETTER = EXACT.copy()
_LETTER[65:91] = _LETTER[97:123]  # A-Z hash as a-z
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(n, _BLOCK)
    if n not in _POWERS:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        if n > _BLOCK:
            return both[0], both[1]
        _POWERS[n] = (both[0], both[1])
    return _POWERS[n]


def word_hash(word: bytes) -> int:
    """The hash that hash_words gives a single word."""
    return int(hash_words(pa.array([word.decode("utf-8", "replace")]))[0][0])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (null: empty) and each text's bounds in them, without copying texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count or pa.types.is_null(texts.type):
        texts = pc.fill_null(texts.cast(pa.string()), "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, bounds, data = texts.buffers()
    if bounds is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(bounds, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of each text, one after the other, and each text's bounds among them.

    A polynomial over random letter values modulo 2**64, taken from prefix sums and finalised with the length: all
    words of a batch at once. Two of a thousand million different words share a hash with probability 0.03.
    """
    raw, at = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    solid = ~_IS_SPACE[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = at[(at > 0) & (at < len(raw))]
    begin[inner] |= solid[inner]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] |= solid[inner - 1]
    ends = np.flatnonzero(last) + 1
    return hash_spans(raw, starts, ends, _LETTER), np.searchsorted(starts, at)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = EXACT) -> np.ndarray:
    """64-bit hashes of spans of bytes that follow one another, each by its letters' values."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, side="right")))
        hi = ends[j - 1]
        power, inverse = _powers(int(hi - lo) + 1)
        sums = np.zeros(int(hi - lo) + 1, dtype=np.uint64)
        np.cumsum(letters[raw[lo:hi]] * power[: hi - lo], dtype=np.uint64, out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
        i = j
    return _mix(out)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[0], start[0] + 1, ... of size[0] items, then those of start[1], and so on."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[first], (np.add.reduceat(c, first) if len(first) else c)
