"""Near-duplicate groups by HyperMinHash: bands of compressed registers, then estimate, then proof.

A register holds what is least among the hashes of its bucket, compressed to the number
of leading zeros and the ten bits after the first one (Yu and Weber 2020). Registers of
two sets agree as often as the sets are similar, and seldom else. A document is filed
under each band of registers; documents that meet are compared by an estimate from
their registers that is corrected for chance agreements, and only what passes it with
room for its error is verified on the whole shingle sets.

Buckets of a small set would be empty, so sets are put in classes by size (a factor of
two), and a class fixes how many buckets one pass of hashing fills and how many passes
are made with other hashes; a set that may link with sets of the next class is filed
there too. The number of bands is such that of pairs at the threshold itself fewer than
one in ten million doesn't meet; pairs above it miss less often still.

Groups of copies, hot keys and crowds that meet but don't link are handled by
``linked_groups``: copies of a set are filed once, members are compared with the first
of a key, and crowds are joined on their rarest shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jaccard_join import HOT_PARTS, hot_keys, linked_groups, only, parity_bits, shingle_set
from .shared import mix, stash, tidy, without

SHINGLE, PERCENT = 3, 85
#: Registers of a band, and the share of pairs at the threshold that no band may find.
BAND, MISSED = 7, 1e-7
#: Bits of a register after its leading zeros; hashes of a bucket at least, on average.
MANTISSA, FILL = 10, 8
#: Registers that are kept for the estimate, and its error in standard deviations.
KEPT, DEVIATIONS = 140, 6.0

_seeds = mix(np.arange(1, 1 << 11, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def bands(percent: int) -> int:
    """Bands that miss a pair at the threshold with a probability of MISSED at most."""
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** BAND)))


def buckets_of(size_class: int, count: int) -> int:
    """Buckets that one pass over a set of the class (2^class shingles or more) fills."""
    return min(count, max(1, (1 << size_class) // FILL))


def registers(shingles: np.ndarray, size_class: int, count: int) -> np.ndarray:
    """``count`` registers of a set as one of the class; 0 is an empty bucket."""
    buckets = buckets_of(size_class, count)
    passes = -(-count // buckets)
    hashes = mix(shingles[None, :] ^ _seeds[:passes, None])
    hashes.sort(axis=1)
    scaled = (hashes >> np.uint64(32)) * np.uint64(buckets)
    bucket = (scaled >> np.uint64(32)).astype(np.int64) + np.arange(passes)[:, None] * buckets
    bucket = bucket.ravel()
    least = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    place = (scaled.ravel()[least] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    length = np.frexp(place.astype(np.float64))[1].astype(np.int64)  # bits up to the first one
    after = ((place << (33 - length)) & 0xFFFFFFFF) >> (32 - MANTISSA)
    out = np.zeros(passes * buckets, dtype=np.uint16)
    out[bucket[least]] = ((33 - length) << MANTISSA | after).astype(np.uint16)
    return out[:count]


def band_keys(held: np.ndarray, size_class: int) -> np.ndarray:
    """One 64-bit key a band of registers; classes and bands share none."""
    rows = held.reshape(-1, BAND).astype(np.uint64)
    place = np.arange(len(rows), dtype=np.uint64) + np.uint64(size_class << 32)
    return mix((rows * (_seeds[:BAND] | np.uint64(1))).sum(axis=1, dtype=np.uint64) ^ mix(place + np.uint64(1)))


@lru_cache(4096)
def chance(load: float) -> float:
    """How often registers of buckets with other hashes agree, ``load`` hashes a bucket on average."""
    start = np.ldexp(1.0, -np.arange(1, 33))[:, None] * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))[None, :]
    width = np.ldexp(1.0, -np.arange(1, 33) - MANTISSA)[:, None]
    return float(((np.exp(-load * start) * -np.expm1(-load * width)) ** 2).sum())


def estimate(one: np.ndarray, other: np.ndarray, load: float) -> tuple[float, int]:
    """The similarity of two sets from registers of one class, without agreements by chance, and the registers that tell it."""
    used = int(np.count_nonzero(one | other))
    if not used:
        return 0.0, 0
    agreed = int(np.count_nonzero((one == other) & (one != 0))) / used
    by_chance = chance(round(load, 1))
    return (agreed - by_chance) / (1 - by_chance), used


def sketches(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, mark1, mark2, keys, own, above`` of each whole text; equal sets have equal marks.

    ``own`` and ``above`` are the first registers in the set's class and, where it may
    link with sets of the next, in that.
    """
    count = bands(percent) * BAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width)
                n = len(s)
                if not n:
                    rows.append((0, 0, 0, np.empty(0, np.int64), None, None))
                    continue
                at = n.bit_length() - 1
                held = [registers(s, at, count)]
                if n * 100 // percent >= 2 << at:
                    held.append(registers(s, at + 1, count))
                keys = np.concatenate([band_keys(r, at + k) for k, r in enumerate(held)]).view(np.int64)
                own, above = [r[:KEPT].tobytes() for r in held] + [None] * (2 - len(held))
                rows.append((n, int(np.bitwise_xor.reduce(s).view(np.int64)), int(mix(s).sum(dtype=np.uint64).view(np.int64)), keys, own, above))
            n, mark1, mark2, keys, own, above = zip(*rows, strict=True) if rows else ((),) * 6
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            filed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(mark1, pa.int64()), pa.array(mark2, pa.int64()), filed, pa.array(own, pa.binary()), pa.array(above, pa.binary())],
                names=["doc_id", "n", "mark1", "mark2", "keys", "own", "above"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(tidy(run), f"doc_id {kind}, n long, mark1 long, mark2 long, keys array<long>, own binary, above binary")


def likely(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b)`` without those that sizes or estimates rule out."""
    count, bar = bands(percent) * BAND, percent / 100
    pairs = stash(pairs)
    about = only(table.select("doc_id", "n", "own", "above"), pairs, "doc_id")
    side = lambda k, c: about.select(F.col("doc_id").alias(c), *[F.col(x).alias(f"{x}{k}") for x in ("n", "own", "above")])
    # the class of the larger set; its exponent by the binary numeral's length
    size_class = lambda n: F.length(F.bin(n)) - 1
    of = size_class(F.greatest("n1", "n2"))
    held = lambda k: F.when(size_class(F.col(f"n{k}")) == of, F.col(f"own{k}")).otherwise(F.col(f"above{k}"))
    sized = pairs.join(side(1, "a"), "a").join(side(2, "b"), "b").where(F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for total, of, one, other in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                load = total / 2 / buckets_of(of, count)
                found, used = estimate(np.frombuffer(one, np.uint16), np.frombuffer(other, np.uint16), load)
                passed.append(used > 0 and found >= bar - DEVIATIONS * math.sqrt(bar * (1 - bar) / used))
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    kind = table.schema["doc_id"].dataType.simpleString()
    rows = sized.select("a", "b", (F.col("n1") + F.col("n2")).alias("total"), of.alias("of"), held(1).alias("one"), held(2).alias("other"))
    return rows.mapInArrow(tidy(run), f"a {kind}, b {kind}").distinct()


def fine_sketches(docs: DataFrame, crowd: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, bits`` of a crowd's documents, for their join on shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array([parity_bits(s) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "n", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = only(docs, crowd.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")), id_col)
    found = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, n long, bits array<long>")
    return stash(found)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the smallest id reachable by
    links, and the document of that id is kept. A text with fewer words is one shingle;
    without words, or null, its set is empty and links with nothing. Rows that share an
    id share a component. Rows without id are in the component of an equal set with one,
    else in none, and kept is null. An empty table gives no rows; only the id and text
    columns are read.
    """
    table = stash(sketches(docs, width, percent, id_col, text_col))
    same = ["n", "mark1", "mark2"]
    classes = stash(table.where("n > 0").groupBy(same).agg(F.min("doc_id").alias("rep")))
    copies = table.where("n > 0").select("doc_id", *same).join(classes, same).where(F.col("doc_id") != F.col("rep")).select("doc_id")
    copies = copies.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
    rows = without(table.where("n > 0 and doc_id is not null"), copies, "doc_id").select("doc_id", F.explode("keys").alias("key"))
    hot = docs.sparkSession.createDataFrame(pd.DataFrame({"hot": hot_keys(table, 16, 16)}), "hot long")  # HOT_KEYS at most
    part = F.when(F.col("hot").isNotNull(), 1 + F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PARTS))).otherwise(0)
    filed = rows.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left").select("doc_id", "key", part.cast("int").alias("part"))
    every = linked_groups(filed, docs, lambda pairs: likely(pairs, table, percent), lambda crowd: fine_sketches(docs, crowd, width, id_col, text_col), width, percent, id_col, text_col)
    named = classes.join(every.withColumnRenamed("id", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    found = table.select("doc_id", *same).join(named, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, with the one of each that is kept."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
