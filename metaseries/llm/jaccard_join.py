"""Exact Jaccard join of word-shingle sets over parity sketches.

A set's sketch has a number of words that its size band fixes. Each shingle XORs its
64-bit hash into one of them, so a shingle that two sets share cancels out, and the
number of words in which two sketches differ - their Hamming distance - is at most
the size of the sets' symmetric difference. Jaccard similarity of at least t percent
bounds that difference by (100 - t) / (100 + t) of both sizes together. By the
pigeonhole principle two such sets agree in one of any (bound + 1) words of the
sketch; so each set is filed under (bound + 1) words, and only sets that meet in a word are
compared. A second sketch of one bit per shingle turns down most of the others; what
is left is verified on the shingle sets themselves.

Passages that many documents share make words that many sets have. Such hot words are
passed over: a set is filed under its first (bound + 1) words that are neither empty
nor hot. As a word is hot for all sets that have it, the same argument holds. Which
words are hot is told from a sample of the documents; this choice bears on the cost,
not on the result. A set with too few other words is filed under all it has.

A band is a factor of two in size. A set that may link with larger ones of the next
band is filed there too, so no pair is lost between bands.

Equal sets are one class and filed once. Under each word the members are compared
with its first member only (a hot word's are dealt over several firsts); components of
these links come first, and then just those pairs that meet in a word but are still in
different components. So a group of near copies costs its size, not its square, and no
link between components is lost.

Where many sets of different components are filed under one word - they share a passage
but are too different to link - pairs would grow with the square of their number. Such
sets are joined on their shingles themselves, the rarer first: sets that link share one
of their first ones, and those before it count against the pair (see ``_by_shingles``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .components import components
from .shared import mix, private, row_count_at_most, stash, tidy, windows, without, word_hashes, words

SHINGLE, PERCENT = 4, 85
#: Least 64-bit words of the fine sketch that turns pairs down; over 1023 shingles it doubles with the set.
FINE_WORDS = 16
#: Ids up to this number may be broadcast to pick the texts to verify.
BROADCAST_IDS = 1_000_000
#: Members of a key up to which it is joined with itself.
FEW = 24
#: Parts that a hot key's members are dealt over, each with a first of its own.
HOT_PARTS = 64
#: Hot words that are passed over, at most.
HOT_KEYS = 500_000


def shingle_set(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; none for an empty or null text."""
    return np.unique(windows(word_hashes(words(text or b"")), width))


def most_apart(n: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of a set of ``n`` and one that links with it."""
    return (100 - percent) * (n + n * 100 // percent) // (100 + percent)


def sketch_words(band: int, percent: int) -> int:
    """Words of the sketches of a band: some more than the bound of its largest pairs."""
    return max(16, 1 + (2 * (100 - percent) * (2 << band) * 5) // ((100 + percent) * 4))


def sketch_keys(shingles: np.ndarray, percent: int = PERCENT) -> tuple[list[np.ndarray], list[int]]:
    """The keys of a set's sketch in each of its bands, and how many each part has.

    Of each band first those of words with shingles, in order, then those of empty words.
    """
    n = len(shingles)
    if not n:
        return [], []
    own = n.bit_length() - 1
    bands = [own, own + 1] if n * 100 // percent >= 2 << own else [own]
    keys, parts = [], []
    for band in bands:
        m = sketch_words(band, percent)
        at = (mix(shingles ^ np.uint64(0xA5A5A5A5)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        word, value = at[first], np.bitwise_xor.reduceat(shingles[order], first)
        empty = np.ones(m, dtype=bool)
        empty[word] = False
        empty = np.flatnonzero(empty)
        place = mix(np.concatenate([word, empty]).astype(np.uint64) + np.uint64(band << 32))
        keys.append(mix(np.concatenate([value, np.zeros(len(empty), np.uint64)]) ^ place))
        parts += [len(word), len(empty)]
    return keys, parts


def filing_keys(keys: np.ndarray, parts: list[int], n: int, hot: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys that a set of ``n`` is filed under, given its sketches' keys and whether each is hot.

    Of each band the first (bound + 1) that are neither empty nor hot. A set with fewer
    is filed under all its words that are not empty, the hot ones too: of as many words
    as the bound and one more, one agrees with any set it links with. Only a set whose
    words that are not empty are fewer still is filed under the empty ones as well.
    """
    need, at, out = most_apart(n, percent) + 1, 0, []
    for full, empty in zip(parts[::2], parts[1::2], strict=True):
        cold = np.flatnonzero(~hot[at : at + full])[:need]
        if len(cold) == need:
            out.append(keys[at : at + full][cold])
        else:
            out.append(keys[at : at + full + (empty if full < need else 0)])
        at += full + empty
    return np.concatenate(out)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """The fine sketch: of each bit, the parity of the shingles that fall on it.

    It widens by powers of two with the set, and a wide one folds: the halves' XOR is
    the sketch of half the width.
    """
    words = FINE_WORDS << max(0, len(shingles).bit_length() - 10)
    bits = np.bincount((mix(shingles ^ np.uint64(0x5A5A5A5A)) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, mark1, mark2, keys, parts, bits`` of each whole text; equal sets have equal marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, marks1, marks2, keys, parts, bits = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width)
                n.append(len(s))
                marks1.append(int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)
                marks2.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                own, sizes = sketch_keys(s, percent)
                keys.append(np.concatenate(own).view(np.int64) if own else np.empty(0, np.int64))
                parts.append(sizes)
                bits.append(parity_bits(s))
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            filed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            ends = np.cumsum([0, *map(len, bits)], dtype=np.int32)
            fine = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bits) if bits else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(marks1, pa.int64()), pa.array(marks2, pa.int64()), filed, pa.array(parts, pa.list_(pa.int32())), fine], names=["doc_id", "n", "mark1", "mark2", "keys", "parts", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(tidy(run), f"doc_id {kind}, n long, mark1 long, mark2 long, keys array<long>, parts array<int>, bits array<long>")


def hot_keys(table: DataFrame, share: int = 4, often: int = 3, most: int = HOT_KEYS) -> np.ndarray:
    """Keys that ``often`` documents or more of a sample (one in ``share``) have: at most
    ``most`` of them, the more frequent first."""
    sample = table.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select(F.explode("keys").alias("key"))
    counts = stash(sample.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= often))
    level = F.floor(F.log2(F.col("c").cast("double")) * 4).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()  # some hundred rows
    held, least = 0, None
    for r in sorted(rows, key=lambda r: -r.level):
        held += r.n
        if held > most:
            break
        least = r.least
    if least is None:
        return np.empty(0, np.int64)
    return np.sort(counts.where(F.col("c") >= least).select("key").toPandas()["key"].to_numpy())


def filed_under(table: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    """``doc_id, key, part`` of the keys that each set is filed under; hot keys have several parts, others part 0."""
    held = table.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            keys = np.asarray(batch.column(2).flatten())
            ends = np.cumsum([0, *batch.column(2).value_lengths().to_pylist()])
            is_hot = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), dtype=bool)
            found = [
                filing_keys(keys[ends[i] : ends[i + 1]], parts, n, is_hot[ends[i] : ends[i + 1]], percent)
                for i, (n, parts) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True))
            ]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            filed = np.concatenate(found) if found else np.empty(0, np.int64)
            # a set's part is told by its own first key, so it is the same at each run
            part = np.repeat(np.array([1 + int(keys[ends[i]]) % HOT_PARTS for i in range(len(found))], dtype=np.int64), [len(f) for f in found])
            if len(known):
                part[known[np.minimum(np.searchsorted(known, filed), len(known) - 1)] != filed] = 0
            else:
                part[:] = 0
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(filed), pa.array(part.astype(np.int32))], names=["doc_id", "key", "part"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "n", "keys", "parts").mapInArrow(tidy(run), f"doc_id {kind}, key long, part int")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Those of ``pairs (a, b)`` whose shingle sets are similar enough, by the sets themselves."""
    sets = stash(shingle_sets(only(docs, pairs, id_col), width, id_col, text_col))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("s"))
        .where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent)
        .select("a", "b")
        .distinct()
    )


def shingle_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id, shingles`` of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            held = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), held], names=["id", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(tidy(run), f"id {kind}, shingles array<long>")


def _near(percent: int) -> Column:
    """Whether a pair (n1, bits1), (n2, bits2) can link, by sizes and fine sketches."""
    sizes = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
    width = F.least(F.size("bits1"), F.size("bits2"))

    def folded(bits: str) -> Column:
        # sets that can link are within a factor of two, so one fold is enough
        both = F.zip_with(F.slice(bits, F.lit(1), width), F.slice(bits, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > width, both).otherwise(F.col(bits))

    apart = F.aggregate(F.zip_with(folded("bits1"), folded("bits2"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(sizes, apart * (100 + percent) <= (F.col("n1") + F.col("n2")) * (100 - percent)).otherwise(False)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the smallest id reachable by
    links. A text with fewer words is one shingle; without words, or null, its set is
    empty and links with nothing. Rows that share an id share a component. Rows without
    id are in the component of an equal set with one, else in none (null). An empty
    table gives no rows; only the id and text columns are read.
    """
    table = stash(sketches(docs, width, percent, id_col, text_col))
    same = ["n", "mark1", "mark2"]
    classes = stash(table.where("n > 0").groupBy(same).agg(F.min("doc_id").alias("rep")))
    # copies of a set are not filed; these are few or many, and only their ids are joined
    copies = table.where("n > 0").select("doc_id", *same).join(classes, same).where(F.col("doc_id") != F.col("rep")).select("doc_id")
    copies = copies.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
    filed = filed_under(without(table.where("n > 0 and doc_id is not null"), copies, "doc_id"), hot_keys(table), percent)
    about = table.select("doc_id", "n", "bits")
    every = linked_groups(filed, docs, lambda pairs: _turned_down(pairs, about, percent), lambda crowd: about, width, percent, id_col, text_col)
    named = classes.join(every.withColumnRenamed("id", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    return table.select("doc_id", *same).join(named, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def linked_groups(filed: DataFrame, docs: DataFrame, likely: Callable[[DataFrame], DataFrame], about: Callable[[DataFrame], DataFrame], width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, component`` of the documents that link, given the keys that each is filed under.

    Documents link only if they meet in ``filed (doc_id, key, part)``; part is 0 but for
    hot keys. ``likely`` turns pairs ``(a, b)`` down that can't link; ``about`` gives
    ``doc_id, n, bits`` of a crowd's documents. All that is left is verified.
    """
    # under each key and part, every member but the first, with the first; then a hot key's parts' firsts with the key's
    first = lambda *by: F.first("doc_id").over(Window.partitionBy(*by).orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = stash(filed.withColumn("first", first("key", "part")).where("doc_id <> first or part > 0"))
    between = met.where("doc_id = first").withColumn("first", first("key")).where("doc_id <> first")
    met = stash(met.where("doc_id <> first").unionByName(between).select("doc_id", "key", "first"))

    stars = met.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = stash(verified(stash(likely(stars)), docs, width, percent, id_col, text_col))
    joined = components(links)

    # what meets under a key but is in another component than the key's first member
    where = joined.withColumnRenamed("id", "doc_id")
    held = (
        met.join(where, "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .join(where.select(F.col("doc_id").alias("first"), F.col("component").alias("of_first")), "first", "left")
        .withColumn("of_first", F.coalesce("of_first", "first"))
    )
    held = stash(held)
    apart = held.where("component <> of_first").select("key", "doc_id", "component")
    if apart.isEmpty():
        every = joined
    else:
        keys = apart.select("key").distinct()
        # all members of these keys
        members = held.select("key", "doc_id", "component").unionByName(held.select("key", F.col("first").alias("doc_id"), F.col("of_first").alias("component"))).distinct().join(keys, "key", "left_semi")
        members = stash(members)
        counted = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("count")), "key")
        done = met.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
        pairs = _across(counted.where(F.col("count") <= FEW))
        more = stash(verified(stash(likely(pairs.join(done, ["a", "b"], "left_anti"))), docs, width, percent, id_col, text_col))
        links = links.unionByName(more)
        crowd = stash(counted.where(F.col("count") > FEW).select("doc_id").distinct())
        if not crowd.isEmpty():
            links = links.unionByName(_by_shingles(crowd, links, docs, about(crowd), width, percent, id_col, text_col))
        every = components(links)
    return every


def _across(members: DataFrame) -> DataFrame:
    """Pairs of members (key, doc_id, component) of one key that are in different
    components; for keys of few members."""
    side = lambda k: members.select("key", F.col("doc_id").alias(f"i{k}"), F.col("component").alias(f"c{k}"))
    return side(1).join(side(2), "key").where("c1 <> c2 and i1 < i2").select(F.col("i1").alias("a"), F.col("i2").alias("b")).distinct()


def _by_shingles(crowd: DataFrame, links: DataFrame, docs: DataFrame, about: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links between the sets of ``crowd (doc_id)`` that are in different components of ``links``.

    Shingles are put in one order, those that fewer sets have first (Chaudhuri, Ganti and
    Kaushik 2006; Xiao et al. 2008). Take the first shingle that two sets share: what
    either has before it is not in the other, so both numbers together are at most the
    symmetric difference, and with it bounded. So a set is filed under its first shingles
    only, and under one of them it can link only if it has few enough before. Members
    that are left are compared with the one that has the fewest before, then those still
    in other components than that one with the members of other components than theirs.
    """
    ends = crowd.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    sets = stash(shingle_sets(only(docs, ends, id_col), width, id_col, text_col).dropDuplicates(["id"]))
    rows = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = stash(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    # of a set, its shingles in the order; those of one set alone come first
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("c", F.lit(1)).alias("c"), "shingle")))
    ordered = rows.join(often, "shingle", "left").groupBy("id", "n").agg(order.alias("order"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    placed = ordered.select("id", "n", F.posexplode(F.slice("order", F.lit(1), length)).alias("u", "x")).where("x.c > 1").select("id", "n", "u", F.col("x.shingle").alias("shingle"))
    placed = stash(placed)
    fewest = placed.groupBy("shingle").agg(F.min(F.struct("u", "id")).alias("first"))
    apart = F.floor((100 - percent) * (F.col("n") + F.floor(F.col("n") * 100 / percent)) / (100 + percent))
    left = placed.join(fewest, "shingle").where((F.col("id") == F.col("first.id")) | (F.col("u") + F.col("first.u") <= apart))
    left = stash(left.select("shingle", "id", "n", "u", F.col("first.id").alias("first")))

    def found(pairs: DataFrame) -> DataFrame:
        return stash(verified(stash(_turned_down(pairs.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct(), about, percent)), docs, width, percent, id_col, text_col))

    def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
        of = stash(components(links)).select("id", "component")
        first = of.select(F.col("id").alias("first"), F.col("component").alias("of_first"))
        return rows.join(of, "id", "left").join(first, "first", "left").withColumn("component", F.coalesce("component", "id")).withColumn("of_first", F.coalesce("of_first", "first"))

    stars = found(labelled(left, links).where("component <> of_first").select(F.col("id").alias("i"), F.col("first").alias("j")))
    now = stash(labelled(left, links.unionByName(stars)).join(only(about, ends, "doc_id").select(F.col("doc_id").alias("id"), "bits"), "id"))
    side = lambda d, k: d.select(*[F.col(c).alias(f"{c}{k}") for c in ("shingle", "id", "n", "u", "bits", "component")])
    # what lies behind the shared shingle differs by its length at least
    apart = F.col("u1") + F.col("u2") + F.abs(F.col("n1") - F.col("u1") - F.col("n2") + F.col("u2"))
    near = F.when(apart * (100 + percent) <= (F.col("n1") + F.col("n2")) * (100 - percent), _near(percent)).otherwise(False)
    # all of it is part of the join, so that only pairs that pass leave it
    pairs = side(now.where("component <> of_first"), 1).join(side(now, 2), (F.col("shingle1") == F.col("shingle2")) & (F.col("component1") != F.col("component2")) & near)
    return stars.unionByName(found(pairs.select(F.col("id1").alias("i"), F.col("id2").alias("j"))))


def _turned_down(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b)`` without those that sizes or fine sketches rule out."""
    pairs = stash(pairs)
    about = only(about, pairs, "doc_id")
    side = lambda k, c: about.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    return pairs.join(side(1, "a"), "a").join(side(2, "b"), "b").where(_near(percent)).select("a", "b").distinct()


def only(rows: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is an end of a pair; up to BROADCAST_IDS ids are broadcast, more are shuffled."""
    end = private("end")
    ids = stash(pairs.select(F.explode(F.array("a", "b")).alias(end)).distinct())
    few = F.broadcast(ids) if row_count_at_most(ids, BROADCAST_IDS) else ids
    return rows.join(few, F.col(id_col) == F.col(end), "left_semi")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id.

    Of rows that repeat the kept id with the same text one stays.
    """
    found = near_duplicates(docs, width, percent, id_col, text_col)
    kept = without(docs, found.where(F.col("doc_id") != F.col("component_id")).select("doc_id"), id_col)
    n, name = private("n"), private("again")
    repeated = stash(docs.groupBy(id_col).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(F.col(id_col).alias(name)))
    if repeated.isEmpty():
        return kept
    again = F.col(id_col).eqNullSafe(F.col(name))
    return kept.join(repeated, again, "left_anti").unionByName(kept.join(repeated, again, "left_semi").dropDuplicates([id_col, text_col]))


def query(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
