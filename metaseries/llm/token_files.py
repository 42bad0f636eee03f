"""Token counts of documents in flat, unindexed token files.

A token file is nothing but ids of two bytes each, little-endian, with an
end-of-document id after each document: no header, no index, no record length. Files
are read as blocks; in each block a vectorised search finds the end ids, and the
document that a block's edge cuts is stitched by a prefix scan over the blocks'
totals. Files are written by Spark's own text writer, whose "line separator" is the
end id's two bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .shared import shared_folder, stash, tidy
from .tokens import SPECIAL, TokenCache

#: The end-of-document id: the vocabulary's own, which no text gives.
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 19
#: Texts in a file, so that files stay far below the 2 GB of one row.
RECORDS_A_FILE = 50_000


def write_token_files(docs: DataFrame, path: str, end: int = END_OF_DOCUMENT, tokenizer: str | None = None, text_col: str = "text", folders: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> None:
    """Write each text's ids and the end id, a file a task and ``RECORDS_A_FILE`` texts.

    With ``folders`` the files lie in a folder for each value of these columns, and the
    texts of a file are in the order of the columns ``order``; else in that of ``docs``.

    A null or empty text is an end alone. A special token's name in a text is written as
    ordinary text's ids. A text that still gives the end id, or ids of 65536 or more,
    is refused: the job fails.
    """
    carried = [*folders, *order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TokenCache.of(tokenizer)
        for batch in batches:
            held = [two_byte_ids(text or "", cache, end) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), *batch.columns[1:]], names=["value", *carried])

    ends = end.to_bytes(2, "little").decode("latin-1")
    texts = docs.select(F.col(text_col), *carried)
    kinds = "".join(f", {c} {texts.schema[c].dataType.simpleString()}" for c in carried)
    written = texts.mapInArrow(tidy(run), f"value binary{kinds}")
    if carried:
        written = written.sortWithinPartitions(*carried)
    writer = written.select(F.col("value").cast("string"), *folders).write.option("encoding", "ISO-8859-1").option("lineSep", ends).option("maxRecordsPerFile", RECORDS_A_FILE)
    (writer.partitionBy(*folders) if folders else writer).text(path)


def two_byte_ids(text: str, cache: TokenCache, end: int) -> bytes:
    """A text's ids in two bytes each; an error where they can't stand in a token file."""
    for encoded in (lambda: cache.encode(text), lambda: b"".join(map(cache.whole, _parts(text)))):
        ids = np.frombuffer(encoded(), dtype="<u4")
        if not len(ids) or (ids.max() < 1 << 16 and not (ids == end).any()):
            return ids.astype("<u2").tobytes()
    raise ValueError(f"a text gives the end id {end} or an id of 65536 or more")


def _parts(text: str) -> list[str]:
    """A text cut inside the special token's name, so that it is ordinary text."""
    first, *rest = text.split(SPECIAL)
    out = [first]
    for r in rest:
        out += [SPECIAL[:2], SPECIAL[2:] + r]
    return [p for p in out if p]


def read_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, bytes`` of the token files under ``path``; ``file`` is the path below it.

    Spark's reader gives a file as one row, so a file may have 2 GB at most; those of
    ``write_token_files`` are bounded by ``RECORDS_A_FILE``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    width = 2 * block_tokens
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("length") / width).cast("int") - 1))
    # the blocks are cut before they are spread out, so that no row of theirs holds a whole file
    blocks = F.transform(starts, lambda b: F.substring("content", b * width + 1, F.lit(width)))
    depth = len(path.rstrip("/").split("/")) if "://" not in path else len(path.split("://", 1)[1].rstrip("/").split("/"))
    below = F.split(F.regexp_replace("path", "^[a-z0-9]+:(//)?", ""), "/")
    return files.where("length > 0").select(F.array_join(F.slice(below, F.lit(depth + 1), F.size(below)), "/").alias("file"), F.posexplode(blocks).alias("block", "bytes"))


def count_tokens(blocks: DataFrame, end: int = END_OF_DOCUMENT) -> DataFrame:
    """``file, document, first_token, n_tokens`` of each document in ``blocks``.

    ``document`` numbers a file's documents from 0; ``first_token`` is the place of its
    first id in the file; ``n_tokens`` leaves out the end id. Ids after a file's last
    end are a document without end, counted too. An odd last byte is no id. No files,
    or empty ones, give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, ends = [], []
            for held in batch.column(2).to_pylist():
                ids = np.frombuffer(held[: len(held) // 2 * 2], dtype="<u2")
                tokens.append(len(ids))
                ends.append(np.flatnonzero(ids == end).astype(np.int64))
            at = np.cumsum([0, *map(len, ends)], dtype=np.int32)
            found = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ends) if ends else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), found], names=["file", "block", "tokens", "ends"])

    # one row a block: its ends are part of the row, so the scan needs no second pass
    found = blocks.mapInArrow(run, "file string, block int, tokens long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_end = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1))
    scanned = (
        found.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .withColumn("passed", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
        .withColumn("previous", F.coalesce(F.max(last_end).over(before), F.lit(-1)))
    )
    # the place of each end in the file, led by the end before the block
    places = F.concat(F.array("previous"), F.transform("ends", lambda e: e + F.col("base")))
    whole = scanned.select("file", "passed", places.alias("places"), F.posexplode("ends").alias("i", "end")).select(
        "file",
        (F.col("passed") + F.col("i")).alias("document"),
        (F.element_at("places", F.col("i") + 1) + 1).alias("first_token"),
        (F.element_at("places", F.col("i") + 2) - F.element_at("places", F.col("i") + 1) - 1).alias("n_tokens"),
    )
    totals = scanned.groupBy("file").agg(F.sum("tokens").alias("t"), F.sum(F.size("ends")).cast("long").alias("document"), F.coalesce(F.max(last_end), F.lit(-1)).alias("e"))
    open_ended = totals.where("t > e + 1").select("file", "document", (F.col("e") + 1).alias("first_token"), (F.col("t") - F.col("e") - 1).alias("n_tokens"))
    return whole.unionByName(open_ended)


def query(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, read back from flat token files of them.

    A token file holds texts of one piece of a Parquet file, in the order of its rows.
    As the pieces of a file follow each other, a document's number among all of them is
    its row number in the Parquet file, whichever way the file was split to be read. A
    document without count is an error.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = {"source": F.xxhash64("_metadata.file_path"), "start": F.col("_metadata.file_block_start"), "row": F.col("_metadata.row_index")}
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs.select("text", *[c.alias(k) for k, c in place.items()]), path, folders=("source", "start"), order=("row",))
    part = lambda k: F.regexp_extract("file", f"(?:^|/){k}=(-?[0-9]+)/", 1).cast("long").alias(k)
    counted = stash(count_tokens(read_blocks(spark, path)).select("file", part("source"), part("start"), "document", "first_token", "n_tokens"))
    # few rows: one a file
    before = Window.partitionBy("source").orderBy("start", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = counted.groupBy("source", "start", "file").agg(F.count(F.lit(1)).alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = counted.join(files, "file").select("source", (F.col("base") + F.col("document")).alias("row"), "file", "document", "first_token", "n_tokens")
    names = docs.select("doc_id", place["source"].alias("source"), place["row"].alias("row"))
    n = F.when(F.col("n_tokens").isNull(), F.raise_error(F.lit("a document is not in the token files")).cast("long")).otherwise(F.col("n_tokens"))
    return names.join(found, ["source", "row"], "left").select("doc_id", "file", "document", "first_token", n.alias("n_tokens"))
