"""The corpus operators on small tables: brute force, held-out accuracy, edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metaseries.llm import attention, decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, lm_score, packing, quality, token_files, tokens, url_rules
from metaseries.llm.shared import windows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, hash string, row string, n string, key string, host string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "dela", "épée", "the", "of", "12", "Anna", "km"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(60)
    texts = [None, "", " ", "\n", "a", "a b c", "A B C", "!!! 123", "  two  spaces  ", "x\n\nx\nx", base, base.upper(), base + " tail", base + "\nline", say(9000), "<|endoftext|> in text", "tail\t"]
    rows = [(i, t, "en" if i % 3 else None, "s1" if i % 4 else None, i, "k", "h", "r", "n", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, base, "en", "s1", 1, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


# 1
def test_language_of_held_out_documents(spark, docs):
    found = language_id.query(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 20 and sum(r.lang == r.lang_pred for r in found) >= 0.9 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(odd, none):
    model = language_id.fit_dictionaries(odd)
    assert list(model) == ["en"]
    found = language_id.identify(odd, model).collect()
    assert len(found) == odd.count()
    assert all((r.lang_best == "und") == (not any(c.isalpha() for c in (t or ""))) for r, t in zip(found, [x.text for x in odd.collect()], strict=True))
    assert language_id.fit_dictionaries(none) == {} and language_id.identify(none, {}).count() == 0
    assert {r.lang_best for r in language_id.identify(odd, {}).collect()} == {"und"}


def test_dictionaries_are_cut_from_all_of_long_texts(spark):
    rng = random.Random(6)
    words_of = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(400)] for _ in range(2)]
    header = "shared header " * 400
    say = lambda one, n: " ".join(rng.choice(words_of[one]) for _ in range(n))
    rows = [(i, header + say(i % 2, 6000), "one" if i % 2 else "two") for i in range(40)]
    found = language_id.fit_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert all(60_000 < len(d) <= language_id.DICTIONARY_BYTES for d in found.values())
    assert all(d.count(b"shared header") * 14 < 0.4 * len(d) for d in found.values())
    asked = spark.createDataFrame([(1, say(1, 50), None), (2, say(0, 50), None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_best for r in language_id.identify(asked, found).collect()} == {1: "one", 2: "two"}


def test_predictions_step_by_step(spark, docs):
    """Each text's language is that of the smallest sum of piece sizes, recomputed without the operator."""
    import zstandard

    found = language_id.fit_dictionaries(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, found).collect()}
    coders = {}
    for lang, content in found.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coders[lang] = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
    for d in docs.collect():
        kept = " ".join(re.sub("[^a-z\x80-\U0010ffff]", " ", lowered(d.text)).split(" ")).encode()
        kept = b" ".join(x for x in kept.split(b" ") if x)
        if not any(c.isalpha() for c in d.text):
            assert rows[d.doc_id].lang_best == "und"
            continue
        sizes = {lang: sum(len(c.compress(kept[i : i + 1024])) for i in range(0, len(kept), 1024)) for lang, c in coders.items()}
        best = min(sizes.values())
        assert sizes[rows[d.doc_id].lang_best] == best
        second = sorted(sizes.values())[1]
        assert rows[d.doc_id].margin == pytest.approx((second - best) / second)
        assert (rows[d.doc_id].lang == "und") == (rows[d.doc_id].margin < language_id.MIN_MARGIN)


# 2
def check_packing(rows, size=1024):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length >= 1
            at += length
        assert at <= size
    return by_sequence


def test_packing_round_trip(spark, docs):
    rows = packing.query(spark, SF).collect()
    sequences = check_packing(rows)
    total = sum(r.length for r in rows)
    assert len(sequences) <= total / 1024 * 1.03 + 1
    cache = tokens.TokenCache.of()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = cache.whole(d.text) + (0).to_bytes(4, "little")
        own = sorted(pieces[d.doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(r.length for r in own[:i]) for i in range(len(own))]
        assert all(r.doc_tokens * 4 == len(ids) and r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in own)


def test_packing_edges(odd, none):
    from metaseries.llm.shared import stash

    pieces = stash(packing.token_pieces(odd, with_ids=True))
    rows = packing.pack(pieces, per_bucket=3).collect()
    check_packing(rows)
    assert sum(r.length for r in rows) == sum(len(tokens.TokenCache.of().whole(r.text or "")) // 4 + 1 for r in odd.collect())
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(stash(packing.token_pieces(none))).count() == 0


def test_best_fit_takes_the_tightest_window():
    window, offset = packing.best_fit_decreasing(np.array([7, 6, 5, 3, 2, 1, 1]), 10)
    # 3 fits the room of 3, 4 or 5; 2 then the 2 left; each 1 the tightest left
    assert (window.tolist(), offset.tolist()) == ([0, 1, 2, 0, 1, 1, 1], [0, 0, 0, 7, 6, 8, 9])
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 65, 500))[::-1]
    window, offset = packing.best_fit_decreasing(lengths, 64)
    fill: dict[int, int] = {}
    for w, o, n in zip(window.tolist(), offset.tolist(), lengths.tolist(), strict=True):
        room = {k: 64 - v for k, v in fill.items() if 64 - v >= n}
        assert o == fill.get(w, 0)
        assert (w not in fill and not room) or 64 - fill[w] == min(room.values())
        fill[w] = o + n


def test_tokens_equal_the_tokenizer_s():
    cache, rng = tokens.TokenCache.of(), random.Random(1)
    parts = ["a", "B", "é", "1", "²", "½", "_", ".", "!", "'", " ", "\n", "\t", " ", "漢", "👍", "don't", " the", "  ", "\x00", "ª"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert cache.encode(text) == cache.whole(text)


# 3
def test_exact_dedup_edges(odd, none):
    found = exact_dedup.exact_dedup(odd).collect()
    groups = {}
    for r in odd.collect():
        groups.setdefault(hashlib.sha256(lowered(r.text).encode()).hexdigest(), []).append(r.doc_id)
    assert len(found) == odd.count()
    for digest, ids in groups.items():
        own = [r for r in found if r.text_sha256 == digest]
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in own)
        keep = max((i for i in ids if i is not None), default=None)
        assert all(r.group_size == len(ids) and r.keep_id == keep for r in own)
        assert [r.doc_id for r in own if r.kept] == [keep]
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_of_a_hot_text(spark):
    rows = [(i, "same" if i % 2 else str(i)) for i in range(5000)]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), tracked=64)
    assert found.where("kept").count() == 2501 and found.where("group_size = 2500 and keep_id = 4999").count() == 2500


# 4
def test_token_counts(spark, docs):
    found = {r.doc_id: r.n_tokens for r in token_files.query(spark, SF).collect()}
    assert found == {d.doc_id: len(tokens.TokenCache.of().whole(d.text)) // 4 for d in docs.collect()}


def test_separator_scan_stitches_blocks(spark, tmp_path):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 5, 4000).astype("<u2")
    ids[ids == 4] = 9
    (tmp_path / "part-00000-x").write_bytes(ids.tobytes())
    (tmp_path / "part-00001-x").write_bytes(b"")
    (tmp_path / "part-00002-x").write_bytes(np.full(1000, 7, dtype="<u2").tobytes())
    rows = token_files.count_tokens(token_files.read_blocks(spark, str(tmp_path), block_tokens=64), end=9).collect()
    ends = np.flatnonzero(ids == 9)
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    own = sorted((r for r in rows if "00000" in r.file), key=lambda r: r.document)
    assert [r.n_tokens for r in own[: len(ends)]] == lengths.tolist()
    assert sum(r.n_tokens for r in own) + len(ends) == 4000
    assert [(r.first_token, r.n_tokens) for r in rows if "00002" in r.file] == [(0, 1000)]


def test_token_file_edges(spark, odd, none, tmp_path):
    token_files.write_token_files(odd.coalesce(1), str(tmp_path / "a"))
    rows = token_files.count_tokens(token_files.read_blocks(spark, str(tmp_path / "a"), 100)).orderBy("document").collect()
    assert len(rows) == odd.count()
    token_files.write_token_files(none, str(tmp_path / "b"))
    assert token_files.count_tokens(token_files.read_blocks(spark, str(tmp_path / "b"))).count() == 0


def test_token_counts_do_not_depend_on_how_files_are_split(spark, tmp_path):
    rows = [(i, " ".join(["word"] * (i % 17)), "x") for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "documents.parquet"))
    expected = {i: len(tokens.TokenCache.of().whole(t)) // 4 for i, t, _ in rows}
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for before, after in (("128m", "3k"), ("3k", "128m"), ("5k", "3k")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            found = token_files.query(spark, str(tmp_path))
            spark.conf.set("spark.sql.files.maxPartitionBytes", after)
            found = {r.doc_id: r.n_tokens for r in found.collect()}
            assert found == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_texts_with_the_end_id_are_refused(spark, tmp_path):
    table = spark.createDataFrame([("the end",)], "text string")
    end = int(np.frombuffer(tokens.TokenCache.of().whole("the end"), dtype="<u4")[-1])
    with pytest.raises(Exception, match="gives the end id"):
        token_files.write_token_files(table, str(tmp_path / "a"), end=end)


# 5
def brute_components(rows, width, percent):
    sets = [frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if (w := words(t)) else frozenset() for _, t in rows]
    label = {i: i for i, _ in rows if i is not None}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i, j = rows[a][0], rows[b][0]
            both = len(sets[a] & sets[b])
            if both and i is not None and j is not None and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in label}, sets


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    rows, at = [], 0
    for _ in range(25):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([1, 3, 5, 9, 30, 120, 400]))]
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = f"w{rng.randint(0, 4000)}"
            rows.append((at, " ".join(own)))
            at += 1
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(at + i, passage + " " + " ".join(f"q{rng.randint(0, 9999)}" for _ in range(60))) for i in range(60)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80)):
        expected, sets = brute_components(rows, width, percent)
        found = {r.doc_id: r for r in jaccard_join.near_duplicates(table, width, percent).collect()}
        assert {i: r.component_id for i, r in found.items()} == expected
        assert all(found[i].n_shingles == len(s) for (i, _), s in zip(rows, sets, strict=True))


def test_crowds_around_a_passage_against_brute_force(spark, monkeypatch):
    """Sets that share most of a passage, at all distances from it, with hardly a word of their own."""
    rng = random.Random(8)
    monkeypatch.setattr(jaccard_join, "FEW", 2)
    rows = []
    for c in range(3):
        passage = [f"p{c}x{i}" for i in range(80)]
        for _ in range(60):
            own = passage[rng.randint(0, 6) : 80 - rng.randint(0, 6)]
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"u{rng.randint(0, 30)}"
            rows.append((len(rows), " ".join(own + [f"q{rng.randint(0, 200)}" for _ in range(rng.randint(0, 25))])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    expected, _ = brute_components(rows, 5, 80)
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(table, 5, 80).collect()}
    assert found == expected and 3 < len(set(expected.values())) < 180
    # all of them at once, without what the sketches found
    crowd, none = table.select("doc_id"), spark.createDataFrame([], "a long, b long")
    about = jaccard_join.sketches(table, 5, 80, "doc_id", "text").select("doc_id", "n", "bits")
    links = jaccard_join._by_shingles(crowd, none, table, about, 5, 80, "doc_id", "text").collect()
    label = {i: i for i, _ in rows}
    for _ in range(len(rows)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert label == expected


def test_near_duplicate_edges(odd, none):
    found = jaccard_join.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    expected, _ = brute_components([(r.doc_id, r.text) for r in odd.collect()], 4, 85)
    assert all(r.component_id == expected[r.doc_id] for r in found if r.doc_id is not None)
    assert jaccard_join.near_duplicates(none).count() == 0
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 10").count() == 1 and kept.where("doc_id in (6, 12)").count() == 0


def test_filing_keys_keep_the_promise():
    """Two sets within the bound share a key, whichever keys are hot."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7, 20, 63, 64, 130, 700):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = a.copy()
            d = jaccard_join.most_apart(len(a))
            drop = rng.integers(0, d // 2 + 1)
            b = np.unique(np.concatenate([b[drop:], rng.integers(0, 1 << 63, min(drop, d - drop)).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 85 * (len(a) + len(b) - both):
                continue
            filed = []
            for s in (a, b):
                keys, parts = jaccard_join.sketch_keys(s)
                keys = np.concatenate(keys)
                filed.append(set(jaccard_join.filing_keys(keys, parts, len(s), keys % np.uint64(3) == 0).tolist()))
            assert filed[0] & filed[1]


def test_fine_sketches_fold():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 1100).astype(np.uint64))
    b = a[: len(a) - 90]
    x, y = (np.unpackbits(jaccard_join.parity_bits(s).view(np.uint8)) for s in (a, b))
    assert len(x) == 2 * len(y) == 2048
    assert ((x[:1024] ^ x[1024:]) ^ y).sum() <= len(a) - len(b)


# 6
def test_line_dedup_edges(odd, none, spark, monkeypatch):
    out = line_dedup.dedup_lines(odd, ratio=0.2, least_pages=2)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "lines_dropped"]
    rows = odd.collect()
    hosts = Counter(r.source for r in rows)
    seen = Counter((r.source, x) for r in rows if r.text is not None for x in {y.strip(" ") for y in r.text.split("\n")} if x)
    cut = {k for k, n in seen.items() if n >= 2 and n > 0.2 * hosts[k[0]]}
    expected = Counter((r.doc_id, None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in cut)) for r in rows)
    found = Counter((r.doc_id, r.text, r.lines_dropped) for r in out.collect())
    assert Counter((i, t) for (i, t, _), n in found.items() for _ in range(n)) == expected
    assert line_dedup.dedup_lines(none).count() == 0
    monkeypatch.setattr(line_dedup, "HOST_ROWS", 0)
    again = line_dedup.dedup_lines(odd, ratio=0.2, least_pages=2)
    assert again.columns == out.columns and Counter((r.doc_id, r.text, r.lines_dropped) for r in again.collect()) == found
    assert line_dedup.dedup_lines(none).count() == 0


# 7
ITEM = "A train leaves Paris at 9 km per hour and Anna walks 12 miles before the train arrives in the old town of stone"


def test_decontamination_catches_other_numbers_and_names(spark, odd, none):
    filler = "some quite unrelated words stand here and there without any meaning at all "
    texts = {
        1: filler + ITEM,
        2: filler + ITEM.replace("12", "55").replace("9", "81").replace("Anna", "Rose"),
        3: filler + ITEM.replace("train leaves", "boat leaves").replace("walks", "swims").replace("arrives", "goes").replace("stone", "x"),
        4: filler,
        5: ITEM.upper().lower(),
    }
    items = [(7, ITEM), (8, "He has 3 apples and gives 3 pears to all of them today"), (9, None), (10, ""), (11, "too short"), (7, ITEM)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts[6] = "He has 5 apples and gives 5 pears to all of them today"
    texts[7] = "He has 5 apples and gives 4 pears to all of them today"
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(table, benchmark).collect()}
    assert {k[0] for k in found} >= {1, 2, 6} and not {3, 4, 7} & {k[0] for k in found}
    assert found[1, 7].verbatim and not found[2, 7].verbatim
    kept = decontaminate.decontaminate(table, benchmark)
    assert 4 in {r.doc_id for r in kept.collect()} and 1 not in {r.doc_id for r in kept.collect()}
    assert decontaminate.leaks(odd, benchmark).count() == 0
    assert decontaminate.leaks(none, benchmark).count() == 0 and decontaminate.leaks(odd, benchmark.where("false")).count() == 0
    assert decontaminate.decontaminate(odd, benchmark).columns == odd.columns


def test_decontamination_catches_other_spellings_wraps_and_lengths(spark):
    copies = {
        1: ITEM.lower(),
        2: ITEM.upper(),
        3: ITEM.replace(" Paris", "\nParis").replace(" Anna", "\nAnna"),
        4: ITEM.replace("12 miles", "about 12 miles"),
        5: ITEM.replace("Anna", "Mary Ann"),
        6: ITEM.replace(" Paris", "\nRome").replace(" Anna", "\nRose"),
        7: "no full stop here\n" + ITEM.replace("12 miles", "about 15 miles").replace("Anna", "Mary Ann"),
    }
    others = {
        20: ITEM.replace("train leaves", "boat leaves").replace("walks", "swims").replace("arrives", "goes").replace("stone", "x").upper(),
        21: "Tom Hill has 5 apples and gives 4 pears to all of them today",
        22: " ".join(sorted(ITEM.split())),
    }
    items = spark.createDataFrame([(7, ITEM), (8, "He has 3 apples and gives 3 pears to all of them today")], "item_id long, text string")
    table = spark.createDataFrame(list((copies | others).items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(table, items).collect()}
    assert set(found) == {(i, 7) for i in copies}
    assert all(found[i, 7].coverage == 1 and found[i, 7].verbatim for i in (1, 2, 3)) and not found[5, 7].verbatim
    assert {r.doc_id for r in decontaminate.decontaminate(table, items).collect()} == set(others)


def plain_slots(item, text):
    """By brute force: the places where the item's template stands in the text, as (item value, text value) pairs.

    Words are compared one by one without case and outer marks; where the item has a
    number or name, the text must have one too.
    """
    number = re.compile(r"[+-]?[$]?\d[\d.,:/]*%?")
    kind = lambda w: 1 if number.fullmatch(w) else 2 if w[:1].isupper() and w[1:].islower() else 0
    bare = lambda t: [w.strip(".,;!?") for w in t.split()]
    own, words_of = bare(item), bare(text)
    for at in range(len(words_of) - len(own) + 1):
        pairs = set()
        for i, (a, b) in enumerate(zip(own, words_of[at:], strict=False)):
            if i and kind(a) and kind(a) == kind(b):
                pairs.add((a.lower(), b.lower()))
            elif a.lower() != b.lower():
                break
        else:
            yield pairs


SLOTTED = {
    1: "The bus to Bern leaves at {a} and the next one goes at {b} from the new hall near the river bank",
    2: "On {a} the mill of Anna ground {b} sacks of wheat and then {b} sacks of rye before the miller went home",
    3: "Mix them in the ratio {a} and let them stand for {b} before the broth of {c} is poured over the dish",
    4: "He bought it for {a} less {b} and sold it again for {c} within the same year of the old town fair",
}
VALUES = {
    1: ["10:30", "11:30", "9:15", "8:45", "7:30", "6:30"],
    2: ["2020/01/31", "1999/12/24", "12", "7", "365"],
    3: ["1:3", "2:5", "10:30", "3", "4"],
    4: ["$10.50", "5%", "12,000", "$99", "7.5%", "40"],
}


def test_slots_against_brute_force(spark):
    """Times, dates, ratios, prices and repeated values: what is found, what is not, and whether it is verbatim."""
    rng = random.Random(9)
    names = ["Ruth", "Otto", "Bern", "Anna"]
    items = {1: SLOTTED[1].format(a="10:30", b="11:30"), 2: SLOTTED[2].format(a="2020/01/31", b="12"), 3: SLOTTED[3].format(a="1:3", b="4", c="Otto"), 4: SLOTTED[4].format(a="$10.50", b="5%", c="12,000")}
    texts = {}
    for i in range(240):
        k = 1 + i % 4
        filled = SLOTTED[k]
        for slot in ("{a}", "{b}", "{b}", "{c}"):
            # each place for itself, so that repeated ones agree now and then
            filled = filled.replace(slot, rng.choice(names if k == 3 and slot == "{c}" else VALUES[k]), 1)
        filled = filled.replace("Anna", rng.choice(names)).replace("Bern", rng.choice(names))
        if i % 6 == 5:
            left = filled.split()
            rng.shuffle(left)
            filled = " ".join(left)
        texts[i] = "some words before it. " + filled + ". some words after it"
    expected = {}
    for i, t in texts.items():
        for k, item in items.items():
            for pairs in plain_slots(item, t):
                if len({a for a, _ in pairs}) == len(pairs):
                    expected[i, k] = all(a == b for a, b in pairs)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.verbatim for r in decontaminate.leaks(table, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert 100 < len(expected) < 220 and len(set(expected) & {(i, 2) for i in texts}) < 40
    # an item whose slots contradict each other may still be told by its verbatim windows
    half = {(i, k) for (i, k) in set(found) - set(expected) if any(items[k].lower().split()[j : j + 13] == texts[i].lower().split()[j + 4 : j + 17] for j in range(12))}
    assert set(found) - half == set(expected)
    assert {key: v for key, v in found.items() if key in expected} == expected


def test_rows_that_repeat_an_id_are_judged_by_their_own_texts(spark):
    rows = [(1, ITEM), (1, "a clean text with some words"), (None, "before " + ITEM), (None, "another clean text"), (2, None), (2, ITEM), (2, ITEM)]
    table = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, mark long, slots string")
    kept = decontaminate.decontaminate(table, spark.createDataFrame([(7, ITEM)], "item_id long, text string"))
    assert kept.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, "a clean text with some words"), (None, "another clean text"), (2, None)])
    from metaseries.llm.quality import keep_good

    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    assert keep_good(table, labels, threshold=0.0).count() == len(rows) and keep_good(table, labels, threshold=1.1).count() == 0


def test_names_that_operators_use_for_themselves_may_be_columns(spark):
    names = ["_id", "_gone", "_n", "_again", "_cut", "_host", "_lines_cut", "bucket", "id", "mark", "key", "part", "n", "u", "shingle", "component", "label"]
    rows = [(i, f"some words of text number {i} " + "and more of them " * (i % 3), "s", *[i] * len(names)) for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` long" for c in names))
    assert jaccard_join.keep_one(table).columns == table.columns
    assert line_dedup.dedup_lines(table).columns == [*table.columns, "lines_dropped"]
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert decontaminate.decontaminate(table, benchmark).count() == 12
    assert quality.keep_good(table, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), threshold=0.0).columns == table.columns
    from metaseries.llm.shared import stash

    pieces = stash(packing.token_pieces(table).withColumn("bucket", packing.F.lit("mine")))
    assert {r.bucket for r in packing.pack(pieces).collect()} == {"mine"}


def test_decontamination_finds_planted_items(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    texts = {d.doc_id: " ".join(d.text.split()) for d in docs.collect()}
    planted = {(i, b.item_id) for i, t in texts.items() for b in items if " ".join(b.text.split()) in t}
    assert planted <= {(r.doc_id, r.item_id) for r in decontaminate.query(spark, SF).collect()}


# 8
def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.query(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 10 and sum((r.score >= 0.5) == (r.quality == 1) for r in rows) >= 0.85 * len(rows)


def test_quality_edges(odd, none, spark):
    labels = spark.createDataFrame([(10, 1), (10, 1), (14, 0), (None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    rows = quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality.classify(none, labels).count() == 0
    assert quality.classify(odd, labels.where("false")).count() == odd.count()


def test_quality_step_by_step(spark, docs):
    """Every document's score from its text and the labels, recomputed with plain covariances and determinants."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {d.doc_id: d.text for d in docs.collect()}
    x = {i: np.array(quality.statistics(t.encode())) for i, t in texts.items()}
    learnt = {c: np.array([x[i] for i, q in labels.items() if q == c and zlib.crc32(str(i).encode()) % 4 != 2]) for c in (0, 1)}
    eye, total = np.eye(len(quality.FEATURES)) * quality.LEAST, sum(map(len, learnt.values()))
    scatter = {c: (s - s.mean(0)).T @ (s - s.mean(0)) for c, s in learnt.items()}
    pooled = sum(scatter.values()) / total + eye
    logs = {}
    for c, s in learnt.items():
        cov = (1 - quality.TO_POOLED) * scatter[c] / len(s) + quality.TO_POOLED * pooled
        cov = (1 - quality.TO_DIAGONAL) * cov + quality.TO_DIAGONAL * np.diag(np.diag(cov)) + eye
        prior = math.log((len(s) + 1) / (total + 2)) - 0.5 * np.linalg.slogdet(cov)[1]
        logs[c] = {i: prior - 0.5 * (v - s.mean(0)) @ np.linalg.inv(cov) @ (v - s.mean(0)) for i, v in x.items()}
    for r in quality.query(spark, SF).collect():
        expected = 1 / (1 + math.exp(min(500, logs[0][r.doc_id] - logs[1][r.doc_id])))
        assert r.score == pytest.approx(expected, abs=1e-7) and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_statistics_of_a_small_text():
    s = dict(zip(quality.FEATURES, quality.statistics(b"Aa bb aa aa.\n\n1! ccc"), strict=True))
    share = lambda part, whole, usual, weight: math.asin(math.sqrt((part + weight * usual) / (whole + weight)))
    assert s["log_words"] == pytest.approx(math.log(7)) and s["log_word_length"] == pytest.approx(math.log(114 / 26)) and s["log_line_words"] == pytest.approx(math.log(56 / 4))
    assert s["upper_share"] == pytest.approx(share(1, 14, 0.02, 100)) and s["digit_share"] == pytest.approx(share(1, 14, 0, 100)) and s["symbol_share"] == pytest.approx(share(1, 14, 0, 100))
    assert s["stop_share"] == pytest.approx(share(6, 6, 0.35, 20)) and s["top_share"] == pytest.approx(share(2, 6, 0.05, 20)) and s["repeat_share"] == pytest.approx(share(0, 6, 0, 20))
    assert s["variety"] == pytest.approx(math.log(25) / math.log(26)) and s["log_longest_word"] == pytest.approx(math.log(13)) and s["line_variety"] == pytest.approx(share(2, 2, 1, 2))


def test_more_labels_than_are_broadcast(spark, docs, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    few = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    monkeypatch.setattr(quality.labelled_statistics, "__defaults__", ("doc_id", "text", "quality", 0))
    assert {r.doc_id: r.score for r in quality.classify(docs, labels).collect()} == pytest.approx(few, abs=1e-9)


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(0)
    p = len(quality.FEATURES)
    a, b = rng.normal(0, 1, (400, p)), rng.normal(1, 2, (400, p))
    model = quality.solve({0: (400, a.sum(0), a.T @ a), 1: (400, b.sum(0), b.T @ b)}, 0.0, 0.0)
    x = rng.normal(0.5, 1.5, (20, p))
    logs = []
    for s in (a, b):
        cov = np.cov(s.T, bias=True) + np.eye(p) * quality.LEAST
        off = x - s.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


# 9
def test_scores_against_counts(spark, docs):
    rows = {r.doc_id: r for r in lm_score.query(spark, SF).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    texts = {d.doc_id: words(d.text) for d in docs.collect()}
    c = Counter(w for i, t in texts.items() if not held(i) for w in t)
    c["\0end"] = sum(not held(i) for i in texts)
    total, distinct = sum(c.values()), len(c)
    for i, t in texts.items():
        own = [*t, "\0end"]
        base = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in own)
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(own), sum(c[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base, abs=1e-6)


def test_model_beats_counts_on_both_folds(spark):
    sums = lm_score.query(spark, "/root/testdata/sf0.1").groupBy("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()
    assert len(sums) == 2 and all(r.score > r.base for r in sums)


def test_scores_step_by_step(spark, docs, monkeypatch):
    """Scores of whole texts, position by position, from the weights that were trained."""
    fit, held = lm_score.fit, {}

    def keep(texts, vocabulary, positions):
        held["v"], held["p"] = vocabulary, fit(texts, vocabulary, positions)
        return held["p"]

    monkeypatch.setattr(lm_score, "fit", keep)
    monkeypatch.setattr(lm_score, "LEAST_BATCHES", 30)
    few = docs.where("doc_id < 30")
    texts = {d.doc_id: words(d.text) for d in few.collect()}
    rows = lm_score.score(few, "doc_id % 3 <> 0").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lm_score.Lexicon(tokens.TokenCache.of(None)).texts([[w.encode() for w in texts[r.doc_id]]], [False])[0].tolist()
        assert r.score == pytest.approx(plain_log10(held["p"], held["v"], ids, attention.CONTEXT, attention.STRIDE), rel=1e-5)


def plain_log10(p, v, ids, context, stride):
    """The model's log10 probability of a text's ids, position by position."""
    x, total = [attention.END, *ids[:-1]], 0.0
    for t, target in enumerate(ids):
        # the last window that begins early enough to have scored t is the first to reach it
        w = 0 if t < context else -(-(t - context + 1) // stride)
        seen = x[w * stride : t + 1]
        h = np.array([p["embed"][v.row[i]] + p["place"][j] for j, i in enumerate(seen)], dtype=float)
        q, k, u = np.split(h @ p["qkv"], 3, axis=1)
        a = np.exp(k @ q[-1])
        r = h[-1] + (a / a.sum()) @ u @ p["out"]
        y = r + np.maximum(r @ p["up"], 0) @ p["down"]
        z = y @ p["head"] + p["bias"]
        total += z[v.of[target]] - np.log(np.exp(z).sum())
        c = v.of[target] - v.alone
        if v.within[target] >= 0:
            z = p["tail"][c] @ y + p["tail_bias"][c]
            total += z[v.within[target]] - np.log(np.exp(z).sum())
        elif v.row[target] == len(v.seen):
            total += v.unseen_log
    return total / np.log(10)


def small_model(rng, ids=400, singles=5, cluster=64):
    v = attention.Vocabulary.from_counts({i: int(n) for i, n in enumerate(rng.integers(1, 50, ids))} | {attention.END: 9}, singles, cluster)
    p = attention.initial(v)
    return v, {k: w + rng.normal(0, 0.2, w.shape).astype(np.float32) for k, w in p.items()}


def test_sums_step_by_step():
    rng = np.random.default_rng(4)
    v, p = small_model(rng)
    texts = [np.append(rng.integers(0, 430, n), attention.END) for n in (0, 1, 5, 31, 32, 33, 54, 55, 56, 57, 200)]
    expected = [plain_log10(p, v, t.tolist(), attention.CONTEXT, attention.STRIDE) for t in texts]
    for order in (1, -1):
        own = texts[::order]
        found = attention.position_logs(attention.Scorer(p, v), own) / np.log(10)
        assert np.add.reduceat(found, np.cumsum([0, *map(len, own[:-1])]))[::order] == pytest.approx(expected, rel=1e-5)


def test_all_ids_together_are_certain():
    rng = np.random.default_rng(5)
    v, p = small_model(rng, ids=70, singles=5, cluster=16)
    seen = [*v.seen.tolist(), 3000]
    x = np.tile(rng.integers(0, 70, (1, 7)), (len(seen), 1))
    logs = attention.Scorer(p, v).log_probabilities(x, np.tile(np.array(seen)[:, None], (1, 7)), 0)
    every = np.exp(logs.astype(float))
    every[-1] *= attention.IDS - len(v.seen)  # an unseen id stands for all of them
    assert every.sum(axis=0) == pytest.approx(np.ones(7), abs=1e-4)


def test_training_windows_cover_all_positions():
    sizes = (1, 5, 31, 32, 33, 64, 700)
    texts = [np.arange(n) + 1000 * i for i, n in enumerate(sizes)]
    rows = attention.training_windows(texts)
    assert rows[:, 1:][rows[:, 1:] >= 0].tolist() == np.concatenate(texts).tolist()
    before = np.concatenate([[attention.END, *t[attention.CONTEXT - 1 : len(t) - 1 : attention.CONTEXT]] for t in texts])
    assert rows[:, 0].tolist() == before.tolist()


def test_buckets_train_on_every_window():
    texts = [np.arange(n) for n in (3, 700, 40, 0 + 1)]
    every = Counter(map(tuple, attention.training_windows(texts).tolist()))
    once = Counter(tuple(r) for b in lm_score.bucket_batches(iter(texts), 1, 0) for r in b.tolist())
    assert once == every
    more = Counter(tuple(r) for b in lm_score.bucket_batches(iter(texts), 1, 3) for r in b.tolist())
    assert more == Counter({k: 3 * n for k, n in every.items()})
    for positions in (0, 10, 10**7, 10**9, 10**12):
        parts = lm_score.rounds_of(positions)
        assert [a for a, _, _ in parts] == [0, *[b for _, b, _ in parts[:-1]]] and parts[-1][1] == lm_score.PARTS


def test_first_round_of_large_corpora_goes_over_nothing_again():
    for positions in (10**8, 2 * 10**8, 10**9, 10**11):
        low, high, buckets = lm_score.rounds_of(positions)[0]
        assert buckets == 1 or positions * (high - low) / lm_score.PARTS / buckets >= lm_score.LEAST_BATCHES * attention.BATCH * attention.CONTEXT


def test_training_takes_the_steps_of_adam_over_clusters_of_their_own_width():
    """Means of gradients and of their squares, kept for the rows that occur; no cluster is filled up to the widest."""
    rng = np.random.default_rng(9)
    v = attention.Vocabulary.from_counts({i: 900 - i for i in range(800)} | {attention.END: 9})
    p = attention.initial(v)
    texts = [np.append(rng.integers(0, 820, n), attention.END) for n in rng.integers(1, 90, 60)]
    batches = [attention.batch(attention.training_windows(texts[at : at + 6])) for at in range(0, 60, 6)]
    expected = {k: w.astype(float) for k, w in p.items()}
    m, s = ({k: np.zeros(w.shape) for k, w in p.items()} for _ in range(2))
    for step, batch in enumerate(batches, 1):
        _, grad = attention.gradients({k: w.astype(np.float32) for k, w in expected.items()}, v, *batch)
        for k, w in expected.items():
            at, g = grad[k] if k in attention.ROWS else (slice(None), grad[k])
            m[k][at] = 0.9 * m[k][at] + 0.1 * g
            s[k][at] = 0.99 * s[k][at] + 0.01 * g * g
            w[at] -= 1e-2 * (1 - (step - 1) / 20) * (m[k][at] / (1 - 0.9**step)) / (np.sqrt(s[k][at] / (1 - 0.99**step)) + 1e-8)
    found, _ = attention.train(p, v, batches, 1e-2, 20)
    for k, w in expected.items():
        off = np.abs(np.subtract(found[k], w, where=np.isfinite(w), out=np.zeros(w.shape)))
        assert np.array_equal(np.isfinite(found[k]), np.isfinite(w)) and np.mean(off) < 1e-5 and np.mean(off > 1e-3) < 1e-3
    widths = [w.shape[1] for w in attention._in_groups(p, v)]
    assert widths == [width for _, _, width in v.groups] and min(widths) == attention.NARROW < max(widths)


def test_lexicon_gives_the_tokenizer_s_ids_and_all_counts():
    cache, rng = tokens.TokenCache.of(), random.Random(2)
    vocabulary = ["the", "of", "don't", "a,b", "\u00a0x", "\u00e9p\u00e9e", "12", "<|endoftext|>", "!!", "_"]
    texts = [[rng.choice(vocabulary).encode() for _ in range(rng.randint(0, 9))] for _ in range(50)]
    lexicon = lm_score.Lexicon(cache)
    ids = lexicon.texts(texts[:30], [True] * 30) + lexicon.texts(texts[30:], [False] * 20)
    for words_of, found in zip(texts, ids, strict=True):
        whole = b"".join(cache.whole(" " + w.decode()) for w in words_of)
        assert found.tolist() == [*np.frombuffer(whole, dtype="<u4").tolist(), attention.END]
    leads = lm_score.word_leads(None)
    assert [int(leads[t].sum()) for t in ids] == [len(t) + 1 for t in texts]
    keys, counts, pieces = lexicon.take()
    expected = Counter(w for t in texts[:30] for w in t)
    assert sorted(counts.tolist()) == sorted(expected.values()) and len(set(keys.tolist())) == len(expected)
    assert pieces.sum() == sum(len(t) - 1 for t in ids[:30]) and not len(lexicon)
    one = np.concatenate(ids).astype(np.int64)
    found = lm_score.word_hashes(one, np.flatnonzero(leads[one]))
    assert set(keys.tolist()) <= set(found.tolist()) and lm_score.END_HASH in found


def test_whole_texts_become_the_ids_of_their_words():
    """Arrow's words are those of ``bytes.split``, whatever the bytes; a word is encoded once for all texts until its lexicon is taken."""
    cache, rng = tokens.TokenCache.of(), random.Random(3)
    parts = [b" ", b"\t", b"\n", b"\x0b", b"\r", b"\x1c", b"\x85", b"\xc2\xa0", b"\xff", b"\xc3\x84", b"A", b"z", b"Z", b".", b"!", b"1"]
    texts = [b"", b" ", *(b"".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000))]
    learnt = np.arange(len(texts)) % 2 == 0
    one, other = lm_score.Lexicon(cache), lm_score.Lexicon(cache)
    found = one.whole(pa.array([b"away", *texts], pa.binary())[1:], learnt)
    expected = other.texts([t.lower().split() for t in texts], learnt.tolist())
    assert all(np.array_equal(a, b) for a, b in zip(found, expected, strict=True))
    assert sorted(one.take()[1].tolist()) == sorted(other.take()[1].tolist())
    assert lm_score.Lexicon(cache).whole(pa.array([], pa.binary()), np.zeros(0, dtype=bool)) == []


def test_frequent_ids_lie_in_narrow_clusters():
    """Each seen id has a place of its own; those of the frequent ids have few neighbours, which is what a position costs."""
    for n in (0, 1, 31, 32, 33, 500, 511, 512, 513, 900, 3000):
        v = attention.Vocabulary.from_counts({i: 5000 - i for i in range(n)})
        places = set(zip(v.of[v.seen].tolist(), v.within[v.seen].tolist(), strict=True))
        assert len(places) == n and v.classes == (int(v.of[v.seen].max()) + 2 if n else 1)
        tail = v.seen[v.within[v.seen] >= 0]
        widths = dict(zip(*np.unique(v.of[tail], return_counts=True), strict=True))
        assert all(widths[v.of[i]] <= attention.NARROW for i in tail if i < attention.FREQUENT)
        assert sum(high - low for low, high, _ in v.groups) == len(widths)


def test_large_scores_keep_their_weights_finite():
    """Scores beyond the range of powers are brought down by row, in a batch of their own or beside others."""
    rng = np.random.default_rng(8)
    v, p = small_model(rng, ids=12, singles=6, cluster=4)
    p["qkv"] *= np.float32(30)
    text = np.append(rng.integers(0, 12, 60), attention.END)
    found = attention.position_logs(attention.Scorer(p, v), [text])
    assert np.isfinite(found).all()
    exact = attention.position_logs(attention.Scorer({k: w.astype(float) for k, w in p.items()}, v), [text])
    assert found == pytest.approx(exact, rel=1e-3, abs=1e-3)
    loss, grad = attention.gradients(p, v, *attention.batch(attention.training_windows([text])))
    assert np.isfinite(loss) and all(np.isfinite(grad[k][1] if k in attention.ROWS else grad[k]).all() for k in attention.NAMES if grad[k] is not None)


def test_long_texts_are_learnt_whole(spark):
    """Texts of over 16,384 bytes, whose order only the positions after the first third show."""
    rng = random.Random(5)
    say = lambda: " ".join(rng.choice(["alpha", "beta"]) for _ in range(2000)) + " alpha beta" * 2000
    rows = [(i, say()) for i in range(60)] + [(1000, "alpha beta " * 500)]
    r = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id < 100").where("doc_id = 1000").first()
    assert (r.score - r.base_score) / r.n_tokens > 0.1


def test_scores_do_not_depend_on_the_layout(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_score, "BUCKET", 1 << 15)  # several buckets and rounds
    monkeypatch.setattr(lm_score, "FIRST", 1 << 16)
    monkeypatch.setattr(lm_score, "LEAST_BATCHES", 20)
    found = []
    for layout in (docs.select("doc_id", "text").coalesce(1), docs.select("text", "doc_id").repartition(7).sortWithinPartitions("text")):
        found.append({r.doc_id: (r.score, r.base_score, r.n_known) for r in lm_score.score(layout, "doc_id % 3 <> 1").collect()})
    assert found[0].keys() == found[1].keys()
    for i, one in found[0].items():
        assert found[1][i] == pytest.approx(one, rel=1e-6)


def test_score_edges(odd, none):
    rows = lm_score.score(odd, head=4).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2, 3)} == {1}
    assert all(r.n_known == r.n_tokens and math.isfinite(r.score) for r in rows)
    assert lm_score.score(none).count() == 0
    rows = lm_score.score(odd, "false").collect()
    assert {r.n_known for r in rows} == {0} and all(math.isfinite(r.score) for r in rows)


def test_each_id_is_scored_once_and_causally():
    rng = np.random.default_rng(0)
    v, p = small_model(rng, ids=12, singles=6, cluster=4)
    scorer = attention.Scorer(p, v)
    sizes = (1, 2, attention.CONTEXT, attention.CONTEXT + 1, 3 * attention.CONTEXT + 5)
    texts = [np.arange(n) + 1000 * i for i, n in enumerate(sizes)]
    rows, firsts, place = attention.scored_windows(texts)
    scored = Counter(x for r, f in zip(rows, firsts, strict=True) for x in r[1 + f :].tolist() if x >= 0)
    assert scored == Counter(np.concatenate(texts).tolist()) and place.tolist() == [0, 1, 3, 35, 59, 68, 92, 116, 140]
    a = rng.integers(0, 12, (1, 20))
    b = a.copy()
    b[0, 15:] = (b[0, 15:] + 1) % 12
    t = rng.integers(0, 12, (1, 20))
    assert np.allclose(scorer.log_probabilities(a, t, 0)[0, :15], scorer.log_probabilities(b, t, 0)[0, :15])
    assert np.allclose(scorer.log_probabilities(a, t, 4), scorer.log_probabilities(a, t, 0)[:, 4:], atol=1e-5)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    v, p = small_model(rng, ids=14, singles=6, cluster=4)
    p = {k: w.astype(np.float64) for k, w in p.items()}
    x, t, valid = rng.integers(0, 16, (2, 10)), rng.integers(0, 16, (2, 10)), rng.random((2, 10)) < 0.8
    _, grad = attention.gradients(p, v, x, t, valid)
    for k, w in p.items():
        g = np.zeros_like(w)
        if k in attention.ROWS:
            g[grad[k][0]] = grad[k][1]
        else:
            g = grad[k]
        for at in map(tuple, np.argwhere((np.abs(g) > 1e-7) & np.isfinite(w))[:3]):
            e = 1e-5
            w[at] += e
            high, _ = attention.gradients(p, v, x, t, valid)
            w[at] -= 2 * e
            low, _ = attention.gradients(p, v, x, t, valid)
            w[at] += e
            assert g[at] == pytest.approx((high - low) / (2 * e), rel=1e-3, abs=1e-8)


# 10
def brute_judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = lowered(host)
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_url_rules_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["com", "example.com", "www.example.com", "a.b.example.com", "net", "x.net", "exnet", "EXAMPLE.com", "", "..", "com."]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/y", "/fr/", "/en/x/y", "/é/"]
    urls = [None, "", "no scheme", "://", "a://b://c/d", "http://com", "http://com?x=/en/", "x" * 5000]
    urls += [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=1', '#top', '/'])}" for _ in range(400)]
    rules = [*url_rules.RULES, ("block", "b.example.com", "/en/x"), ("allow", "example.com", "/en/x/y"), ("block", "com", "/en/x"), ("block", "example.com", ""), ("allow", "net", "/é")]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)] + [(3, urls[3], None, None, None)], "page_id long, url string, host string, path string, rule string")
    found = url_rules.judge_urls(pages, spark.createDataFrame(rules, url_rules.RULE_SCHEMA)).collect()
    assert len(found) == len(urls) + 1
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == brute_judge(urls[r.page_id], rules)
    empty = spark.createDataFrame([], url_rules.RULE_SCHEMA)
    assert url_rules.judge_urls(pages.where("false"), spark.createDataFrame(rules, url_rules.RULE_SCHEMA)).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, empty, default="block").collect()} == {"block"}


def test_windows_tell_order_and_length():
    h = np.arange(1, 9, dtype=np.uint64)
    assert windows(h, 4)[0] != windows(h[::-1].copy(), 4)[-1]
    assert len(windows(h, 4)) == 5 and len(windows(h[:2], 4)) == 1 and windows(h[:2], 4)[0] != windows(h[:3], 4)[0]
