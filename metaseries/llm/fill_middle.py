"""Fill-in-the-middle transformation over a succinct index of each text's tokens.

A token is a run of white space and the word after it, or white space at the end of the
text. Its end is one bit of a packed bit vector over the text's bytes; a directory holds
the number of ends before each block. The directory's total is the number of tokens n,
and a cut after k tokens is found by select: the block by binary search in the
directory, the byte and the bit in it by the counts of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stash, tidy

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts of 100 that are transformed, and of these those with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
#: Bytes of the bit vector (eight text bytes each) that one entry of the directory covers.
BLOCK = 64

_white = np.zeros(256, dtype=bool)
_white[[0x20, *range(0x09, 0x0E)]] = True
_ones = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class Ends:
    """Rank and select over the bytes of a text at which tokens end."""

    def __init__(self, text: bytes):
        white = _white[np.frombuffer(text, dtype=np.uint8)]
        ends = np.ones(len(white), dtype=bool)
        # a word ends before white space, white space only with the text
        ends[:-1] = ~white[:-1] & white[1:]
        self.bits = np.packbits(ends)
        counts = _ones[self.bits]
        whole = np.zeros(-(-len(counts) // BLOCK) * BLOCK, dtype=np.uint8)
        whole[: len(counts)] = counts
        #: ends before each block, and in all
        self.directory = np.concatenate([[0], np.cumsum(whole.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))])

    def __len__(self) -> int:
        return int(self.directory[-1])

    def cut(self, k: int) -> int:
        """The number of bytes that the first ``k`` tokens take."""
        if not 0 <= k <= len(self):
            raise IndexError(k)
        if k == 0:
            return 0
        block = int(np.searchsorted(self.directory, k, side="left")) - 1
        inside = np.cumsum(_ones[self.bits[block * BLOCK : (block + 1) * BLOCK]], dtype=np.int64)
        left = k - int(self.directory[block])
        at = int(np.searchsorted(inside, left, side="left"))
        left -= int(inside[at - 1]) if at else 0
        byte = block * BLOCK + at
        bit = int(np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1]))[left - 1])
        return byte * 8 + bit + 1


def code_points(text: bytes) -> int:
    """Characters of UTF-8 bytes: those that don't continue another."""
    return int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers that the seed and the document's id fix."""
    held = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(held[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(text: bytes, numbers: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> tuple[int, str, int | None, int | None, bytes]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    p, s, m = (mark.encode() for mark in marks)
    n = 0
    if text:
        ends = Ends(text)
        n = len(ends)
    if not text or p in text or s in text or m in text or numbers[2] % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    start, end = ends.cut(first), ends.cut(second)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if numbers[3] % 100 < suffix_first:
        form, output = "spm", s + suffix + p + prefix + m + middle
    else:
        form, output = "psm", p + prefix + s + suffix + m + middle
    return n, form, code_points(prefix), code_points(middle), output


def restore(output: bytes, form: str, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> bytes:
    """The text that ``transform`` made ``output`` of; from the output and its form alone.

    No part holds a mark and every mark begins with a sign that it doesn't hold again,
    so the first place at which a mark is found is the mark.
    """
    p, s, m = (mark.encode() for mark in marks)
    if form == "plain":
        return output
    rest, _, middle = output.partition(m)
    if form == "spm":
        suffix, _, prefix = rest.removeprefix(s).partition(p)
    else:
        prefix, _, suffix = rest.removeprefix(p).partition(s)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``output`` is the whole transformed text as binary (UTF-8). A null text counts as
    empty; an empty one, and one that holds a mark, stays as it is (form plain). A row
    without id is drawn for like one with an empty id, and rows of one id and text get
    one result each. An empty table gives no rows; only the id and text columns are read.
    Each row is done where it lies, without a shuffle.
    """
    if any(mark.count(mark[:1]) != 1 or any(mark in other for other in marks if other is not mark) for mark in marks) or len(set(marks)) != 3:
        raise ValueError("marks must differ, and each must hold its first sign once")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [transform(text or b"", draws(doc_id, seed), rate, suffix_first, marks) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            n, form, prefix, middle, output = zip(*found, strict=True) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("binary").alias("text"), F.col(id_col).alias("doc_id"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")


def with_digests(made: DataFrame, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``fill_in_middle``'s rows with ``output_sha256`` and ``restored_sha256`` in place of the output."""
    names = [c for c in made.columns if c != "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha256 = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            held = batch.select(names)
            outputs, forms = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            digests = pa.array(map(sha256, outputs), pa.string())
            restored = pa.array((sha256(restore(o, f, marks)) for o, f in zip(outputs, forms, strict=True)), pa.string())
            yield pa.RecordBatch.from_arrays([*held.columns, digests, restored], names=[*names, "output_sha256", "restored_sha256"])

    kinds = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in names)
    return made.mapInArrow(tidy(run), f"{kinds}, output_sha256 string, restored_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's transformed text and of the text rebuilt from it."""
    return stash(with_digests(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


SQL = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id::varchar) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens
  from documents
), drawn as (
  select *, len(tokens) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from texts
), cut as (
  select doc_id, text, n,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form,
         coalesce(array_to_string(tokens[1:least(h1 % (n + 1), h2 % (n + 1))], ''), '') as prefix,
         coalesce(array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], ''), '') as middle,
         coalesce(array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], ''), '') as suffix
  from drawn
), made as (
  select *, case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                 else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end as output
  from cut
)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
       case when form <> 'plain' then length(middle)::bigint end as middle_chars,
       sha256(output) as output_sha256,
       sha256(case form when 'plain' then output
              when 'spm' then split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<P>', 1), '<S>', 2)
              else split_part(split_part(output, '<S>', 1), '<P>', 2) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1) end) as restored_sha256
from made
"""
