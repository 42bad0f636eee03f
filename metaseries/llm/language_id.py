"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from a bounded sample
of labelled texts. A text is compressed piece by piece with each dictionary; the
language with the smallest total wins, and the margin to the next one says how far
to trust it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .shared import id_remainder, letters_in, tidy

#: The bound of the sample: documents of a language, passages of each, and characters of a passage.
SAMPLE_DOCS, PASSAGES, PASSAGE_CHARS = 400, 4, 1024
DICTIONARY_BYTES = 98_304
PIECE_BYTES = 1024
LEVEL = 6
#: Sharpness of the score: how fast a language loses weight with its relative size.
SHARPNESS = 60.0
#: Relative margin under which a prediction counts as narrow.
MIN_MARGIN = 0.01
UNKNOWN = "und"

_plain = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """ASCII letters in lower case and all other scripts' bytes, parted by single spaces."""
    return b" ".join(text.translate(_plain).split())


def dictionary(texts: Iterable[list[bytes]], size: int = DICTIONARY_BYTES) -> bytes:
    """A first passage of each text, then a second one and so on, each of an even share of ``size``.

    Texts come as lists of passages. A passage that is already there is passed over, so
    what many texts share stands in the dictionary once.
    """
    texts = [[plain(p) for p in passages] for passages in texts]
    share = max(128, size // max(1, len(texts)))
    out, filled, seen = [], 0, {b""}
    for turn in range(max(map(len, texts), default=0)):
        for passages in texts:
            part = passages[turn][:share] if turn < len(passages) else b""
            if part not in seen and filled < size:
                seen.add(part)
                out.append(part)
                filled += len(part) + 1
    return b" ".join(out)[:size]


def fit_dictionaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """A dictionary for each language, from passages of at most ``per_language`` texts of it.

    Texts of any length are in the sample, and its passages stand anywhere in them. Sample
    and places are fixed by hashes of the id, so they are the same at each run. The
    ranking is cut to the sample in each task before anything is shuffled. Null and empty
    texts are passed over; rows that repeat an id are texts of their own.
    """
    # one row a language; the more frequent language wins a tie
    often = {r[0]: r[1] for r in docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col)).count().collect()}
    if not often:
        return {}
    order = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30))
    # about four times the sample passes this cut; the ranking then makes its bound exact
    shares = F.create_map(*[F.lit(x) for lang, n in often.items() for x in (lang, int(min(1.0, 4 * per_language / n) * (1 << 30)))])
    room = F.greatest(F.lit(1), F.length("text") - PASSAGE_CHARS + 1)
    passage = lambda i: F.substring(F.col("text"), F.pmod(F.xxhash64(F.col("id"), F.lit(i)), room).cast("int") + 1, F.lit(PASSAGE_CHARS)).cast("binary")
    pick = Window.partitionBy("lang").orderBy("order", "id")
    sample = (
        docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), order.alias("order"))
        .where(F.col("order") <= shares[F.col("lang")])
        .where("text is not null and length(text) > 0")
        .withColumn("rank", F.row_number().over(pick))
        .where(F.col("rank") <= per_language)
        .select("lang", "rank", F.array(*[passage(i) for i in range(PASSAGES)]).alias("passages"))
    )
    by_lang: dict[str, list] = {}
    for row in sample.collect():
        by_lang.setdefault(row.lang, []).append((row.rank, [bytes(p) for p in row.passages]))
    found = {lang: dictionary([t for _, t in sorted(rows)]) for lang, rows in by_lang.items()}
    return {lang: found[lang] for lang in sorted(found, key=lambda x: (-often[x], x)) if found[lang]}


@lru_cache(maxsize=8)
def _coders(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    coders = []
    for content in dictionaries:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))
    return coders


def sizes(text: bytes, coders: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed size of the whole text with each dictionary."""
    text = plain(text)
    pieces = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)] or [b""]
    return np.array([sum(len(c.compress(p)) for p in pieces) for c in coders], dtype=float)


def predict(text: bytes | None, langs: list[str], coders: list) -> tuple[str, float, float]:
    """Language, score from 0 to 1, relative margin to the second."""
    if text is None or not langs or not letters_in(text):
        return UNKNOWN, 0.0, 0.0
    s = sizes(text, coders)
    best = int(s.argmin())
    weight = np.exp(-SHARPNESS * (s / s[best] - 1))
    second = float(np.delete(s, best).min()) if len(s) > 1 else 2 * s[best]
    return langs[best], float(weight[best] / weight.sum()), float((second - s[best]) / second)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_best, score, margin, lang`` over whole texts.

    ``lang_best`` is the language of the smallest encoding (of equal ones, the most
    frequent), or ``und`` where the text is null, empty or has no letter; ``lang`` is
    the same but ``und`` where the margin is under ``min_margin``. Without any
    dictionary all is ``und``. Long texts are compressed whole, piece by piece; rows that
    repeat an id are predicted each. Only the id and the text are read.
    """
    langs, contents = list(dictionaries), tuple(dictionaries.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(contents)
        for batch in batches:
            found = [predict(t.as_py(), langs, coders) for t in batch.column(1)]
            best, score, margin = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            lang = [b if m >= min_margin else UNKNOWN for b, m in zip(best, margin, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(lang, pa.string())],
                names=["doc_id", "lang_best", "score", "margin", "lang"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, lang_best string, score double, margin double, lang string"
    )


def held_out(doc_id: str = "doc_id"):
    return id_remainder(F.col(doc_id), 4) == 2


def query(spark, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from the folds that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, fit_dictionaries(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "margin", (F.col("lang") == F.col("lang_best")).alias("confident"))
