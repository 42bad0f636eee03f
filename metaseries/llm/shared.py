"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where a session on one machine has none (tests), a local folder is set; on a
    cluster that is an error, as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    held = context.getCheckpointDir()
    if held is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        held = context.getCheckpointDir()
    return held


#: Bytes of an Arrow batch that goes to a Python worker while a table is stashed.
BATCH_BYTES = "4m"
_batch_setting = "spark.sql.execution.arrow.maxBytesPerBatch"


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage at a copy that outlives the executors, and unlike a
    checkpoint the copy is columnar, so later steps read only what they need. During
    the write Python workers get batches of few bytes, however long the texts are.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stash-{uuid.uuid4().hex}"
    before = spark.conf.get(_batch_setting, None)
    spark.conf.set(_batch_setting, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_batch_setting) if before is None else spark.conf.set(_batch_setting, before)
    return spark.read.schema(df.schema).parquet(path)


def private(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo: the fold that a document belongs to."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; short ones are remembered, up to a fixed number of them."""

    limit, longest = 100_000, 40

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


_hashes = WordHashes()
#: What tasks remember from text to text, to be dropped when one ends.
_remembered: list[Callable[[], None]] = [_hashes.clear]
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def remembered(forget: Callable[[], None]) -> None:
    """Have ``forget`` called when a task of this worker ends."""
    _remembered.append(forget)


def forget_all() -> None:
    """Drop what is remembered and give the freed memory back."""
    for forget in _remembered:
        forget()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _tidied(run, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        yield from run(slices(batches))
    finally:
        forget_all()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over small slices of its batches; at its task's end all that was remembered goes.

    Python workers are used again by later stages, so what one stage keeps would stand
    beside what the next one needs.
    """
    return partial(_tidied, run)


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A to Z lower-cased."""
    return text.lower().split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))


#: Odd factors of the places in a window.
_factors = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words (64 at most); of the whole where it is shorter."""
    n = len(hashes)
    k = min(width, n)
    if not n:
        return hashes
    out = hashes[: n - k + 1] * _factors[0]
    for j in range(1, k):
        out += hashes[j : n - k + 1 + j] * _factors[j]
    return mix(out + np.uint64(k))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in batches of few rows and bytes, so that a task holds few of them as Python objects.

    A row of more bytes is a batch of its own.
    """
    for batch in batches:
        ends = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
                ends += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            elif pa.types.is_list(column.type):
                ends += 8 * pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(ends), 0
        while at < batch.num_rows:
            full = int(np.searchsorted(ends, size + (ends[at - 1] if at else 0), side="right"))
            to = max(at + 1, min(at + rows, full))
            yield batch.slice(at, to - at)
            at = to


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows: the check before a broadcast."""
    return df.limit(bound + 1).count() <= bound


def without(docs: DataFrame, ids: DataFrame, id_col: str, bound: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``.

    Up to ``bound`` ids are broadcast, so the texts stay where they lie; more are
    shuffled. Rows with a null id stay.
    """
    name = private("gone")
    gone = stash(ids.toDF(name).where(F.col(name).isNotNull()).distinct())
    if row_count_at_most(gone, bound):
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")


def text_mark(text: Column) -> Column:
    """64 bits that tell texts of one id apart."""
    return F.xxhash64(text.cast("binary"))


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, bound: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose id and ``text_mark`` are in the two columns of ``gone``.

    Null ids count as equal. Up to ``bound`` rows are broadcast, more are shuffled.
    """
    own, mark = private("id"), private("mark")
    gone = stash(gone.toDF(own, mark).distinct())
    if row_count_at_most(gone, bound):
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col(own)) & (text_mark(F.col(text_col)) == F.col(mark)), "left_anti")


def letters_in(text: bytes) -> bool:
    """Whether the text holds any letter of any script."""
    return bool(re.search(rb"[A-Za-z]", text)) or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))
