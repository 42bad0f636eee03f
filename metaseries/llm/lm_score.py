"""Language-model scores of whole texts.

A text is its lower-cased words, each led by a space, as subword ids of a public
tokenizer, and one end. A causal self-attention model predicts every id, all pieces of
a word, from the ids before it; overlapping windows score each id once. ``score`` is the model's log probability of the
text; ``base_score`` is that of its words by their counts alone.

Texts are read once: their ids are stashed, with the counts of words and ids of each
task. The model is trained on all positions of all training texts, in rounds: a
document's hash says in which round and which bucket of about ``BUCKET`` positions it is
learnt. All buckets of a round are trained from the same weights, wherever they lie, each
with a rate that falls to almost nothing, and then averaged by their positions; a task
hands out one sum of weights, however many buckets it learnt. As buckets hold their documents in the order of their
hashes, the model does not depend on how the input is split.

The most frequent words' counts - a fixed number of them at most - are broadcast, so
most words are counted where they lie; only rarer ones are shuffled to join their counts.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import attention
from .attention import END, Vocabulary
from .shared import id_remainder, mix, stash, tidy
from .tokens import TokenCache

#: Words whose counts are broadcast, at most.
HEAD_WORDS = 1 << 18
#: Positions of a bucket, about.
BUCKET = 1 << 21
#: The first round's positions, about, and its least share; the second round has a quarter of the rest.
FIRST, FIRST_SHARE = 1 << 21, 1 / 16
RATES = (3e-2, 2e-2, 1.5e-2)
#: Windows of a batch in each round.
BATCHES = (attention.BATCH, 2 * attention.BATCH, 2 * attention.BATCH)
#: Batches that a bucket of the first round is trained for, at least, by going over it again.
LEAST_BATCHES = 1600
#: Windows that are put in another order and trained on together.
MIXED = 1 << 14
#: Tasks of a round for each slot, at most.
TASKS = 4
#: Parts that a round's share of the documents is counted in.
PARTS = 1 << 16
DOCUMENT, WORD, PIECE = 0, 1, 2
LN10 = float(np.log(10))


class Lexicon(dict):
    """Number of each word seen since the last ``take``; by number its subword ids and count."""

    limit = 300_000

    def __init__(self, cache: TokenCache):
        super().__init__()
        self.cache = cache
        self.forget()

    def forget(self) -> None:
        """Start with no words."""
        self.clear()
        self.pieces: list[bytes] = []
        self.flat, self.size, self.count = np.zeros(0, dtype="<u2"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        text = word.decode("utf-8", "replace")
        if text.isalpha():
            own = self.cache.after_space(text)
        elif (stem := text.rstrip(string.punctuation)).isalpha() and (known := self.get(stem.encode())) is not None:
            own = self.pieces[known] + self.cache.marks[text[len(stem) :]]
        else:
            own = self.cache[text]
        self.pieces.append(own)
        return code

    def texts(self, found: list[list[bytes]], learnt: list[bool]) -> list[np.ndarray]:
        """Each text's ids and its end, from its words; words of ``learnt`` texts are counted."""
        codes = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(found)), dtype=np.int64)
        return self._joined(codes, np.fromiter(map(len, found), dtype=np.int64, count=len(found)), np.array(learnt, dtype=bool))

    def whole(self, texts: pa.Array, learnt: np.ndarray) -> list[np.ndarray]:
        """``texts`` of whole texts (binary, none null): words between ASCII white space, A to Z lower-cased."""
        if not len(texts):
            return []
        texts = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
        found = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # bytes as they are, also where they are no UTF-8
        each = found.flatten().dictionary_encode()
        # white space at a text's start or end leaves an empty word
        known = np.array([self[w] if w else -1 for w in each.dictionary.cast(pa.binary()).to_pylist()], dtype=np.int64)
        codes = known[each.indices.to_numpy()] if len(each) else known
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
        real = codes >= 0
        return self._joined(codes[real], np.bincount(owner[real], minlength=len(texts)), learnt)

    def _joined(self, codes: np.ndarray, length: np.ndarray, learnt: np.ndarray) -> list[np.ndarray]:
        """The ids of texts of so many words each."""
        if new := self.pieces[len(self.size) :]:
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(new), dtype="<u4").astype("<u2")])
            self.size = np.concatenate([self.size, np.fromiter(map(len, new), dtype=np.int64, count=len(new)) // 4])
        first = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(len(length)), length)
        seen = np.bincount(codes[learnt[owner]], minlength=len(self.size))
        seen[: len(self.count)] += self.count
        self.count = seen
        n = self.size[codes]
        before = np.cumsum(n) - n  # ids before each word
        # ids of all texts, with room for an end behind each text
        out = np.full(int(n.sum()) + len(length), END, dtype="<u2")
        at = np.arange(int(n.sum()))
        out[at + np.repeat(owner, n)] = self.flat[at + np.repeat(first[codes] - before, n)]
        ends = np.cumsum(np.bincount(owner, n, len(length)).astype(np.int64) + 1)
        return np.split(out, ends[:-1]) if len(length) else []

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and count of the words counted, and the count of each id; all words are forgotten."""
        flat, size = self.flat.astype(np.int64), self.size
        hashes = word_hashes(flat, np.cumsum(size) - size)
        pieces = np.bincount(flat, np.repeat(self.count, size), attention.IDS).astype(np.int64)
        known = self.count > 0
        out = hashes[known], self.count[known], pieces
        self.forget()
        return out


_of_id = mix(np.arange(attention.IDS, dtype=np.uint64) + np.uint64(1 << 20))
_of_place = mix(np.arange(64, dtype=np.uint64)) | np.uint64(1)


def word_hashes(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The hash of each word, a run of ids from one start to the next."""
    if not len(starts):
        return np.empty(0, dtype=np.int64)
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    factor = _of_place[place & 63]
    far = np.flatnonzero(place > 63)
    factor[far] = mix(place[far].astype(np.uint64)) | np.uint64(1)
    factor *= _of_id[ids]
    return mix(np.add.reduceat(factor, starts)).view(np.int64)


END_HASH = int(word_hashes(np.array([END]), np.array([0]))[0])


def word_leads(tokenizer: str | None) -> np.ndarray:
    """Whether an id begins a word: only a word's first id has the space; the end is a word."""
    cache = TokenCache.of(tokenizer)
    out = np.zeros(attention.IDS, dtype=bool)
    out[[i for piece, i in cache.tokenizer.get_vocab().items() if piece.startswith(cache.space)]] = True
    out[END] = True
    return out


def tokenised(docs: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Rows of three kinds: ``DOCUMENT`` with ``doc_id, mark, train, ids`` of each text,
    and ``WORD`` and ``PIECE`` with ``key, c`` of a task's training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, ends, kind = Lexicon(TokenCache.of(tokenizer)), 0, None

        def counted(ends: int) -> pa.RecordBatch:
            keys, c, pieces = lexicon.take()
            pieces[END] += ends
            seen = np.flatnonzero(pieces)
            keys, c = np.concatenate([keys, [END_HASH] if ends else [], seen]).astype(np.int64), np.concatenate([c, [ends] if ends else [], pieces[seen]]).astype(np.int64)
            kinds = np.full(len(keys), PIECE, dtype=np.int32)
            kinds[: len(keys) - len(seen)] = WORD
            none = [pa.nulls(len(keys), t) for t in (kind, pa.int64(), pa.bool_(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(kinds), *none, pa.array(keys), pa.array(c)], names=names)

        for batch in batches:
            kind = batch.column(0).type
            learnt = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            texts = lexicon.whole(pc.fill_null(batch.column(3), b""), learnt)
            ends += int(learnt.sum())
            n = batch.num_rows
            held = pa.array([t.tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, DOCUMENT, dtype=np.int32)), *batch.columns[:3], held, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            if len(lexicon) >= lexicon.limit:
                yield counted(ends)
                ends = 0
        if kind is not None:
            yield counted(ends)

    names = ["kind", "doc_id", "mark", "train", "ids", "key", "c"]
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("mark"), F.coalesce(F.expr(train), F.lit(False)).alias("train"), text.alias("text"))
    return rows.mapInArrow(tidy(run), f"kind int, doc_id {docs.schema[id_col].dataType.simpleString()}, mark long, train boolean, ids binary, key long, c long")


def head_words(counts: DataFrame, most: int = HEAD_WORDS) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes in order and counts of the most frequent words, ``most`` at most, and the
    least count among them. The cut is taken from a histogram, so nothing is sorted."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()  # some hundred rows
    held, least = 0, None
    for r in sorted(rows, key=lambda r: -r.level):
        held += r.n
        if held > most:
            break
        least = r.least
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), 1 << 62
    head = counts.where(F.col("c") >= least).select("key", "c").toPandas().sort_values("key")
    return head["key"].to_numpy(), head["c"].to_numpy(), least


def rounds_of(positions: int) -> list[tuple[int, int, int]]:
    """First and last part (not included) and buckets of each round over so many positions.

    Several buckets of a first round have ``LEAST_BATCHES`` batches each, so that none is gone over again.
    """
    first = max(FIRST_SHARE, min(1.0, FIRST / max(1, positions)))
    cuts = sorted({0, round(first * PARTS), round((first + (1 - first) / 4) * PARTS), PARTS})
    whole = max(BUCKET, LEAST_BATCHES * BATCHES[0] * attention.CONTEXT)
    own = [positions * (b - a) / PARTS for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(a, b, max(1, round(n / BUCKET) if a else int(n / whole))) for a, b, n in zip(cuts, cuts[1:], own, strict=False)]


def bucket_batches(texts: Iterator[np.ndarray], seed: int, least: int, size: int = attention.BATCH) -> Iterator[np.ndarray]:
    """The windows of a bucket's texts in batches, mixed within runs of ``MIXED`` windows.

    A bucket of under ``least`` batches is gone over again until there are as many.
    """
    rng, left, made, again, over = np.random.default_rng(seed), [], 0, [], False

    def mixed(rows: np.ndarray) -> Iterator[np.ndarray]:
        rows = rows[rng.permutation(len(rows))]
        for at in range(0, len(rows), size):
            yield rows[at : at + size]

    held, waiting = 0, []

    def cut() -> np.ndarray:
        rows = np.concatenate([*left, attention.training_windows(waiting)])
        left.clear()
        waiting.clear()
        return rows

    for text in texts:
        waiting.append(text)
        held += -(-len(text) // attention.CONTEXT)
        if held >= MIXED:
            every = cut()
            for at in range(0, held - MIXED + 1, MIXED):
                for out in mixed(every[at : at + MIXED]):
                    yield out
                    made += 1
                if made < least:
                    again.append(every[at : at + MIXED])
            left.append(every[held - held % MIXED :])
            held %= MIXED
    rest = cut()
    again.append(rest)
    while True:
        for out in mixed(rest):
            yield out
            made += 1
            if over and made >= least:
                return
        if made >= least or not made:
            return
        rest, over = np.concatenate(again), True


def fit(texts: DataFrame, vocabulary: Vocabulary, positions: int) -> dict[str, np.ndarray]:
    """The model's weights, trained in rounds on all of ``texts (mark, ids)``."""
    weights = attention.initial(vocabulary)
    context = texts.sparkSession.sparkContext
    part = F.pmod(F.col("mark"), F.lit(PARTS)).cast("int")
    for number, (low, high, buckets) in enumerate(rounds_of(positions)):
        begun = context.broadcast((weights, vocabulary))
        rate, size, least = RATES[number], BATCHES[number], LEAST_BATCHES if number == 0 else 0
        steps = max(least, round(positions * (high - low) / PARTS / buckets / (size * attention.CONTEXT)), 1)

        def run(batches: Iterator[pa.RecordBatch], begun=begun, rate=rate, size=size, least=least, steps=steps) -> Iterator[pa.RecordBatch]:
            start, words_of = begun.value
            rows = ((b, np.frombuffer(ids, dtype="<u2")) for batch in batches for b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            total, n, ahead = None, 0, next(rows, None)
            while ahead is not None:
                bucket, own = ahead[0], 0

                def texts_of(bucket=bucket) -> Iterator[np.ndarray]:
                    nonlocal ahead, own
                    while ahead is not None and ahead[0] == bucket:
                        own += len(ahead[1])
                        yield ahead[1]
                        ahead = next(rows, None)

                after, _ = attention.train(start, words_of, map(attention.batch, bucket_batches(texts_of(), bucket, least, size)), rate, steps)
                total, n = (0 if total is None else total) + attention.flat(after).astype(float) * own, n + own
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), n, dtype=np.int64))], names=["i", "w", "n"])

        # a bucket's documents stand together, in the order of their hashes
        bucket = F.pmod(F.shiftrightunsigned("mark", 16), F.lit(buckets)).cast("int")
        dealt = texts.where((part >= low) & (part < high)).select(bucket.alias("bucket"), "ids", "mark")
        dealt = dealt.repartition(min(buckets, TASKS * context.defaultParallelism), "bucket").sortWithinPartitions("bucket", "mark").select("bucket", "ids")
        found = stash(dealt.mapInArrow(tidy(run), "i int, w double, n long"))
        mean = found.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).toPandas().sort_values("i")  # one row a weight
        if len(mean):
            weights = attention.unflat(mean["w"].to_numpy(), weights)
        begun.destroy()
    return weights


def score(docs: DataFrame, train: str = "true", id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, head: int = HEAD_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` is a SQL condition on the rows that are learnt from. ``base_score`` is the
    log10 probability of the words under counts alone, (c + 1) / (N + V + 1);
    ``score`` that of all its subword ids under the attention model. Null and empty texts are an end alone.
    Without training texts all counts are 0 and ids are equally likely. Repeated rows
    are scored each; an empty table gives no rows; only id and text are read.
    """
    table = stash(tokenised(docs, train, id_col, text_col, tokenizer))
    every = table.where(F.col("kind") == DOCUMENT)
    counts = stash(table.where(F.col("kind") == WORD).groupBy("key").agg(F.sum("c").alias("c")))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(sums.n), int(sums.v)
    pieces = {r.key: r.c for r in table.where(F.col("kind") == PIECE).groupBy("key").agg(F.sum("c").alias("c")).collect()}  # one row a subword id
    vocabulary = Vocabulary.from_counts(pieces)
    model = fit(every.where("train").select("mark", "ids"), vocabulary, sum(pieces.values()))
    head_hash, head_count, least = head_words(counts, head)
    held = docs.sparkSession.sparkContext.broadcast((model, vocabulary, head_hash, head_count))
    size = float(total + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, words_of, hashes, count = held.value
        scorer, leads, hashes, count = attention.Scorer(weights, words_of), word_leads(tokenizer), np.append(hashes, 1 << 62), np.append(count, 0)
        for batch in batches:
            texts = [np.frombuffer(t, dtype="<u2") for t in batch.column(1).to_pylist()]
            ids = np.concatenate(texts).astype(np.int64)
            starts = np.flatnonzero(leads[ids])
            found = word_hashes(ids, starts)
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            hit = hashes[at] == found
            logs = np.log((np.where(hit, count[at], 0) + 1.0) / size)
            # of each text, its words' place in ``starts``; the end is a word, so none is without
            first = np.searchsorted(starts, np.cumsum([0, *map(len, texts)]))
            ahead = np.cumsum([0, *map(len, texts[:-1])])
            sums = [np.add.reduceat(logs, first[:-1]) / LN10, np.add.reduceat(attention.position_logs(scorer, texts), ahead) / LN10]
            ends = pa.array(np.concatenate([[0], np.cumsum(~hit)])[first], pa.int32())
            rare = pa.ListArray.from_arrays(ends, pa.array(found[~hit]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(np.add.reduceat(hit.astype(np.int64), first[:-1])), *map(pa.array, sums), rare], names=names)

    names = ["doc_id", "n_tokens", "known", "logs", "score", "rare"]
    kind = every.schema["doc_id"].dataType.simpleString()
    scored = every.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, known long, logs double, score double, rare array<long>")
    scored = stash(scored.withColumn("row", F.monotonically_increasing_id()))
    # a rare word stands as never met, with a count of 0; those that were met are put right
    rare = scored.select("row", F.explode("rare").alias("key"))
    met = rare.join(counts.where(F.col("c") < least), "key")
    more = met.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("more_logs"), F.count(F.lit(1)).alias("more_known"))
    return (
        scored.drop("rare")
        .join(more, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("base_score"),
            "score",
        )
    )


def held_out(doc_id: str = "doc_id"):
    return id_remainder(F.col(doc_id), 7) == 2


TRAIN = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 7, 0) <> 2"


def query(spark, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; learnt from the folds that are not held out."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), TRAIN).withColumn("held_out", held_out())
