"""Packing of token sequences by best-fit decreasing.

Documents are tokenised where they lie. Overlong ones are first cut into full
windows; what remains is shorter than a window. Pieces are dealt over buckets by a
hash, and each bucket is packed by itself: longest piece first, each into the open
window with the least room that still takes it, found in a segment tree indexed by
remaining capacity. As each bucket holds some thousand pieces, its
own last windows hardly matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, LongType, StructField, StructType

from .shared import private, stash, tidy
from .tokens import END_ID, TokenCache

WINDOW = 1024
#: Pieces that a bucket holds on average.
PER_BUCKET = 5_000


class OpenWindows:
    """Open windows by remaining capacity: a segment tree over capacities 0 to ``size``."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.held[room].append(window)
        at = self.leaves + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the tightest window with room for ``need``: (room, window)."""
        at = self.leaves + need
        if not self.count[at]:
            # up to the first subtree to the right that is not empty, then down its left edge
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.held[room].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; lengths from 1 to ``size``, in falling order."""
    open_windows, made = OpenWindows(size), 0
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        found = open_windows.take(need) if need < size else None
        if found is None:
            found, made = (size, made), made + 1
        room, at = found
        window[i], offset[i] = at, size - room
        if room > need:
            open_windows.add(room - need, at)
    return window, offset


def token_pieces(docs: DataFrame, size: int = WINDOW, tokenizer: str | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document's ids: ``doc_id, start, length, doc_tokens, ids_crc32[, ids]``.

    The ids of a whole text are followed by one end id; a null or empty text gives
    that id alone. Pieces start at multiples of ``size``. ``ids`` holds the piece's
    ids as little-endian unsigned 32-bit values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TokenCache.of(tokenizer)
        for batch in batches:
            row, start, length, total, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                held = cache.encode(text or "") + END_ID.to_bytes(4, "little")
                n = len(held) // 4
                for at in range(0, n, size):
                    piece = held[4 * at : 4 * (at + size)]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    total.append(n)
                    crc.append(zlib.crc32(piece))
                    if with_ids:
                        ids.append(piece)
            out = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, total, crc))]
            names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def pack(pieces: DataFrame, size: int = WINDOW, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; other columns stay as they are.

    ``pieces`` must be a table or checkpoint (its row numbers deal the pieces over
    the buckets, so no id can make a bucket large) with ``doc_id, start, length``,
    1 <= length <= ``size``. A bucket is sorted by length, then the other columns;
    wholly equal rows are interchangeable. An empty table gives no rows.
    """
    buckets, bucket = max(1, round(pieces.count() / per_bucket)), private("bucket")
    order = [("length", "descending"), *((f.name, "ascending") for f in pieces.schema if f.name != "length" and isinstance(f.dataType, AtomicType))]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.drop_columns([bucket]).sort_by(order)
        window, offset = best_fit_decreasing(table.column("length").to_numpy(), size)
        return table.append_column("sequence_id", pa.array(window * buckets + key[0].as_py())).append_column("offset", pa.array(offset))

    result = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    dealt = pieces.withColumn(bucket, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)))
    return dealt.groupBy(bucket).applyInArrow(run, result)


def query(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    pieces = stash(token_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
