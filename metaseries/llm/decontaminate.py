"""Benchmark decontamination by template windows.

Words of a text are made canonical: numbers, runs of names and units of measure become
typed placeholders, other words are lower-cased without outer punctuation. Windows of
these templates are hashed and joined between documents and benchmark items, so a
question with other numbers or names still meets its template. Windows of the words
themselves are joined as well, without regard to case and lines, so a copy needs no
slots. An alignment of a document to an item takes in all windows at nearby shifts, so
words may be put in or left out. It counts when it covers enough of the item's windows
and its slots are consistent, each of the item's values standing for one value of the
document, or when verbatim windows alone cover enough.

A window with few literal words says little, so such windows are only hashed verbatim.
Documents' windows pass a bitmap of fixed size, made from the benchmark, before the
join; the join itself is exact and shuffles only what passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mix, remembered, stash, text_mark, tidy, windows, without_rows

WIDTH = 6
#: Literal words that a window needs to be hashed as a template.
LITERALS = 4
#: Shifts are grouped in ranges as long as the item, of this many words at least.
LEAST_RANGE = 8
#: Items with fewer words are no evidence.
LEAST_WORDS = 4
COVERAGE = 0.5
#: Bits of the bitmap that documents' windows must pass: its size does not depend on the data.
BITMAP_BITS = 1 << 23

# fixed values: units of measure that follow a number
UNITS = frozenset(
    b"mm cm m km in ft yd mi mg g kg t lb oz ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    b"usd eur dollar dollars euro euros cent cents percent % degrees meter meters metre metres mile miles inch inches foot feet gram grams kilogram kilograms liter liters litre litres".split()
)
NUMBER, NAME, UNIT = 1, 2, 3
_number = re.compile(rb"[+-]?[$]?\d[\d.,:/]*%?")
_outer = b".,;:!?()[]{}\"'`*#&%$|-"
_ends = (b".", b"!", b"?", b":")
_marks = mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0x51ED270B))


class WordKinds(dict):
    """Number of each word seen, up to a fixed number of words; by number its hash and traits."""

    limit = 100_000

    def __init__(self):
        super().__init__()
        self.hash, self.kind, self.ends, self.value = [], [], [], []

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_outer) or word
        shape = bare.decode("utf-8", "replace")
        lowered = shape.lower().encode()
        self.hash.append(xxhash.xxh3_64_intdigest(lowered))
        self.kind.append(NUMBER if _number.fullmatch(bare) else UNIT if lowered in UNITS else NAME if len(shape) > 1 and shape[0].isupper() and shape[1:].islower() else 0)
        self.ends.append(word.rstrip(b"\"')]").endswith(_ends))
        self.value.append(lowered)
        self[word] = len(self.hash) - 1
        return self[word]

    def forget(self) -> None:
        self.clear()
        self.__init__()

    def fresh(self) -> None:
        if len(self) >= self.limit:
            self.forget()


_kinds = WordKinds()
remembered(_kinds.forget)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind and sentence end of all words seen, by number."""
    return np.array(_kinds.hash, dtype=np.uint64), np.array(_kinds.kind, dtype=np.int8), np.array(_kinds.ends, dtype=bool)


def coded_texts(texts: list[bytes | None]) -> tuple[list[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each text's ``word_codes``, and the tables that the numbers point into."""
    _kinds.fresh()
    return [word_codes(text or b"") for text in texts], _tables()


def word_codes(text: bytes) -> np.ndarray:
    """Numbers of a text's words; where its lines end does not matter."""
    return np.array(list(map(_kinds.__getitem__, text.split())), dtype=np.int64)


def template(codes: np.ndarray, hashes: np.ndarray, kinds: np.ndarray, ends: np.ndarray, opens: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: hash of its canonical form, slot kind (0: none), its first word's place; of each word its verbatim hash.

    A token is a word, or a run of name words. A sentence's first word is no name; the
    text's first word opens a sentence if ``opens``.
    """
    n = len(codes)
    verbatim, kind = hashes[codes], kinds[codes]
    first = np.zeros(n + 1, dtype=bool)
    first[1:] = ends[codes]
    first[0] = opens
    slot = np.where((kind == NUMBER) | ((kind == NAME) & ~first[:n]), kind, 0)
    slot[1:] = np.where((kind[1:] == UNIT) & (kind[:-1] == NUMBER), UNIT, slot[1:])
    goes_on = np.zeros(n, dtype=bool)
    goes_on[1:] = (slot[1:] == NAME) & (slot[:-1] == NAME)
    heads = np.flatnonzero(~goes_on)
    own = slot[heads]
    return np.where(own > 0, _marks[np.maximum(own, 1) - 1], verbatim[heads]), own, heads, verbatim


def template_windows(shown: np.ndarray, slot: np.ndarray, width: int, literals: int = LITERALS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first token of the windows of ``width`` tokens that have both slots and enough literals."""
    if len(shown) < width:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    count = np.concatenate([[0], np.cumsum(slot == 0)])
    held = count[width:] - count[:-width]
    at = np.flatnonzero((held >= min(literals, width - 1)) & (held < width))
    return windows(shown, width)[at], at


def verbatim_windows(verbatim: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of ``width`` words; none where there are fewer words."""
    return ~windows(verbatim, width) if len(verbatim) >= width else np.empty(0, dtype=np.uint64)


def _slots(slot: np.ndarray, heads: np.ndarray, codes: np.ndarray, at: int, width: int) -> list[str]:
    """The slot values in a window of tokens, each led by its place."""
    ends = [*heads[at + 1 : at + width + 1].tolist(), len(codes)]
    return [f"{j}:" + b" ".join(_kinds.value[c] for c in codes[heads[at + j] : ends[j]].tolist()).decode("utf-8", "replace") for j in range(width) if slot[at + j]]


def _item_windows(codes: np.ndarray, tables: tuple, width: int) -> Iterator[tuple[int, int, int, bool, int, list[int], list[str]]]:
    """``hash, pos, width, exact, total, covers, slots`` of an item's windows.

    The places that count are the words from which on there are ``width`` tokens. In a
    document the item's first word may stand within a sentence, so it is read both ways.
    """
    if len(codes) < LEAST_WORDS:
        return
    counted = None
    for opens in (True, False):
        shown, slot, heads, verbatim = template(codes, *tables, opens)
        w = min(len(shown), width)
        token = np.searchsorted(heads, np.arange(len(codes)), side="right") - 1
        if counted is None:
            # a short item is one window, all of its words
            counted = int((token <= len(shown) - w).sum()) if len(codes) > width else 1
            v = min(len(codes), width)
            for at, h in enumerate(verbatim_windows(verbatim, v)[:counted].view(np.int64).tolist()):
                inside = [t for t in range(token[at], token[at + v - 1] + 1) if slot[t]]
                values = [f"{j}:" + b" ".join(_kinds.value[c] for c in codes[heads[t] : heads[t + 1] if t + 1 < len(heads) else len(codes)].tolist()).decode("utf-8", "replace") for j, t in enumerate(inside)]
                yield h, at, v, True, counted, [at], values
        found, tokens = template_windows(shown, slot, w)
        for h, t in zip(found.view(np.int64).tolist(), tokens.tolist(), strict=True):
            covers = [x for x in np.flatnonzero(token == t).tolist() if x < counted]
            if covers:
                yield h, int(heads[t]), w, False, counted, covers, _slots(slot, heads, codes, t, w)


def _item_rows(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded, tables = coded_texts(batch.column(1).to_pylist())
            rows = [(i, *r) for i, codes in enumerate(coded) for r in _item_windows(codes, tables, width)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))],
                names=["id", "hash", "pos", "width", "exact", "total", "covers", "slots"],
            )

    kind = benchmark.schema[id_col].dataType.simpleString()
    texts = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(tidy(run), f"id {kind}, hash long, pos int, width int, exact boolean, total int, covers array<int>, slots array<string>")


def _document_rows(docs: DataFrame, id_col: str, text_col: str, template_widths: list[int], verbatim_widths: list[int], keep) -> DataFrame:
    """``id, mark, hash, pos, width, slots`` of the documents' windows that ``keep`` lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, hashes, pos, width, slots = [], [], [], [], []
            coded, tables = coded_texts(batch.column(1).to_pylist())
            for i, codes in enumerate(coded):
                shown, slot, heads, verbatim = template(codes, *tables)
                for w in verbatim_widths:
                    found = verbatim_windows(verbatim, w)
                    at = keep(found)
                    if len(at):
                        row += [i] * len(at)
                        hashes += found[at].view(np.int64).tolist()
                        pos += at.tolist()
                        width += [w] * len(at)
                        slots += [[]] * len(at)
                for w in template_widths:
                    found, tokens = template_windows(shown, slot, w)
                    for j in keep(found).tolist():
                        t = int(tokens[j])
                        row.append(i)
                        hashes.append(int(found[j].view(np.int64)))
                        pos.append(int(heads[t]))
                        width.append(w)
                        slots.append(_slots(slot, heads, codes, t, w))
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(2).take(row), pa.array(hashes, pa.int64()), *(pa.array(x, pa.int32()) for x in (pos, width)), pa.array(slots, pa.list_(pa.string()))],
                names=["id", "mark", "hash", "pos", "width", "slots"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), text_mark(F.col(text_col)).alias("mark"))
    return texts.mapInArrow(tidy(run), f"id {kind}, mark long, hash long, pos int, width int, slots array<string>")


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it.

    Columns ``doc_id, item_id, matched_windows, item_windows, coverage, verbatim`` of
    the best alignment; ``verbatim`` is false for a re-parameterised item. Items with
    under ``LEAST_WORDS`` words, and null or empty texts, match nothing; items shorter
    than ``width`` are one window. Repeated rows count once. Rows that share an id are
    judged by their own texts, and the best of them is told; so are rows without id. Texts
    of any length are read whole; empty tables give no rows.
    """
    names = ("matched_windows", "item_windows", "coverage", "verbatim")
    best = F.max(F.struct(*names)).alias("best")
    found = found_items(docs, benchmark, width, coverage, id_col, text_col, item_col, item_text_col)
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", *(f"best.{n}" for n in names))


def found_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """What ``leaks`` gives, for each text of an id apart: with ``mark``, the text's ``text_mark``."""
    items = stash(_item_rows(benchmark, item_col, item_text_col, width).dropDuplicates(["id", "hash", "pos"]))
    bits = np.zeros(BITMAP_BITS, dtype=bool)
    widths = sorted((r.width, r.exact) for r in items.select("width", "exact").distinct().collect())  # at most ``width`` of each kind
    marks = items.select(F.pmod("hash", F.lit(BITMAP_BITS)).cast("int").alias("bit")).distinct().toPandas()["bit"].to_numpy()  # at most BITMAP_BITS
    bits[marks] = True
    packed = np.packbits(bits)

    def keep(found: np.ndarray) -> np.ndarray:
        at = found % np.uint64(BITMAP_BITS)
        return np.flatnonzero(packed[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & 1)

    rows = _document_rows(docs, id_col, text_col, [w for w, exact in widths if not exact], [w for w, exact in widths if exact], keep)
    met = rows.alias("d").join(items.alias("b"), ["hash", "width"])
    value = lambda x: F.regexp_replace(x, "^[0-9]+:", "")
    # verbatim windows pair equal words; of template windows the slots stand in the same places
    pairs = F.when(F.col("b.exact"), F.transform("b.slots", lambda x: F.struct(value(x).alias("item"), value(x).alias("doc")))).otherwise(
        F.zip_with(F.col("b.slots"), F.col("d.slots"), lambda x, y: F.struct(value(x).alias("item"), value(y).alias("doc")))
    )
    # one shift alone, and ranges of shifts that lap over by half, so that any two within half a range share one
    shift, length = F.col("d.pos") - F.col("b.pos"), F.greatest(F.lit(LEAST_RANGE), F.col("b.total"))
    spans = F.array(*(F.struct(F.lit(i).alias("by"), F.floor(x).cast("long").alias("at")) for i, x in enumerate((shift, shift / length, shift / length + 0.5))))
    aligned = (
        met.select(F.col("d.id").alias("doc_id"), "d.mark", F.col("b.id").alias("item_id"), F.explode(spans).alias("span"), "b.covers", "b.exact", F.col("b.total").alias("item_windows"), pairs.alias("pairs"))
        .groupBy("doc_id", "mark", "item_id", "span", "item_windows")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("covers")))).alias("matched_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("exact"), F.col("covers")))))).alias("exact_windows"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        )
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["item"]))
    consistent = F.size(values) == F.size("pairs")
    # where the slots contradict each other, only verbatim windows count
    aligned = aligned.withColumn("matched_windows", F.when(consistent, F.col("matched_windows")).otherwise(F.col("exact_windows"))).withColumn("coverage", F.col("matched_windows") / F.col("item_windows"))
    verbatim = ~F.exists("pairs", lambda p: ~p["item"].eqNullSafe(p["doc"]))
    best = F.max(F.struct("matched_windows", "item_windows", "coverage", verbatim.alias("verbatim")))
    return (
        aligned.where(F.col("coverage") >= coverage)
        .groupBy("doc_id", "mark", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "mark", "item_id", "best.matched_windows", "best.item_windows", "best.coverage", "best.verbatim")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in whose text a benchmark item is found; all columns stay.

    Of rows that repeat an id, or have none, only those with an item in their own text go.
    """
    return without_rows(docs, found_items(docs, benchmark, id_col=id_col, text_col=text_col).select("doc_id", "mark"), id_col, text_col)


def query(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
