"""Fill-in-the-middle, turn repair and HyperMinHash: brute force, round trips, edge cases."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from metaseries.llm import fill_middle, hyper_minhash, jaccard_join, turn_repair

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, form string, output string, key string, component_id string, kept string"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def rows_of(texts, repeats=()):
    return [(i, t, "en" if i % 3 else None, None, i, "n", "f", "o", "k", "c", "x") for i, t in enumerate(texts)] + list(repeats)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "épée", "the", "日本語", "12", "a<P", "<S"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(80)
    texts = [None, "", " ", "\n\t", "a", " a", "a ", "a b c", "A B C", "<P>", "x <S> y", "z<M>", base, re.sub("[a-z]", lambda m: m[0].upper(), base), base + " tail", say(30_000), "    wide", "ends with white \r\n", "😀 " * 900]
    rows = rows_of(texts)
    rows += [rows[12], rows[12], (None, base, *[None] * 9), (None,) * 11]
    return spark.createDataFrame(rows, SCHEMA)


# 11
def transformed(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n = len(tokens)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_the_middle_of_every_text(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    forms = set()
    for table in (docs, odd.where("doc_id is not null")):
        made = fill_middle.fill_in_middle(table).collect()
        want = [(r.doc_id, *transformed(r.doc_id, r.text)) for r in table.select("doc_id", "text").collect()]
        order = lambda r: (r[0], r[-1])
        assert sorted([(*r[:-1], bytes(r.output).decode()) for r in made], key=order) == sorted(want, key=order)
        forms |= {r.form for r in made}
    assert forms == {"plain", "spm", "psm"}


def test_fill_in_the_middle_is_restored_from_output_and_form(spark, odd):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    made = fill_middle.fill_in_middle(odd, rate=100, suffix_first=50)
    digests = sorted((r.output_sha256, r.restored_sha256) for r in fill_middle.with_digests(made).collect())
    rows = made.collect()
    texts = sorted(sha((r.text or "").encode()) for r in odd.collect())
    assert sorted(sha(fill_middle.restore(bytes(r.output), r.form)) for r in rows) == texts == sorted(d[1] for d in digests)
    assert sorted(d[0] for d in digests) == sorted(sha(bytes(r.output)) for r in rows)
    assert {"spm", "psm"} <= {r.form for r in rows}


def test_select_agrees_with_a_scan():
    rng = random.Random(4)
    for size in (1, 7, 8, 9, 500, 4096, 5000, 60_000):
        text = "".join(rng.choice("ab  \té") for _ in range(size)).encode()
        ends = fill_middle.Ends(text)
        tokens = [t.encode() for t in TOKEN.findall(text.decode())]
        assert len(ends) == len(tokens)
        total = 0
        cuts = [0] + [total := total + len(t) for t in tokens]
        ks = range(len(cuts)) if len(cuts) < 3000 else rng.sample(range(len(cuts)), 500)
        assert all(ends.cut(k) == cuts[k] for k in ks)
    with pytest.raises(IndexError):
        fill_middle.Ends(b"a b").cut(3)


def test_fill_in_the_middle_refuses_marks_that_can_not_be_told_apart(spark, odd):
    for marks in (("<P>", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("<P>x", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(odd, marks=marks)
    none = spark.createDataFrame([], SCHEMA)
    assert fill_middle.with_digests(fill_middle.fill_in_middle(none)).count() == 0


# 12
def cheapest(rows):
    """Counts and cheapest edits of one conversation's rows ``(turn, role, text)``, by uniform-cost search."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))  # noqa: B905
    name = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
        if (i, last) in done:
            continue
        done.add((i, last))
        then = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, then, (*out, name[then] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, then, (*out, f"{name[then]}:{text}")))
                if role[:1] == then or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))


def damaged(r):
    space = lambda x: " " if x is None else x
    role, text, draw = space(r.role), space(r.text), zlib.crc32(f"{space(r.conv_id)}:{space(r.turn)}".encode()) % 20
    text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
    return [] if draw == 0 else [(r.turn, "user" if draw == 4 else role, text)] * (1 + (draw == 3))


def expected(rows, change):
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).extend(change(r))
    return {k: cheapest(v) for k, v in by.items() if v}


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(table):
    found = turn_repair.with_digests(turn_repair.repair(table)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}


@pytest.fixture(scope="module")
def talks(spark):
    """Roles and texts of all kinds, null and repeated turns, nulls in any column, whole rows repeated."""
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "sage", "User"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why?  ", "...", "é", "a.b"]
    rows = [(c, rng.choice([t, t, t, None, 3]), rng.choice(roles[:3] if c % 2 else roles), rng.choice(texts), "x", "y", "z") for c in range(80) for t in range(rng.randrange(1, 14))]
    rows += rows[:40] + [(None, 1, "user", "Hi.", None, None, None), (None, None, None, None, None, None, None), (None, 2, "assistant", "Ho.", None, None, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, audit string, whole string")


def test_repairs_are_the_cheapest(spark, talks):
    rows = talks.collect()
    assert repaired(talks) == expected(rows, lambda r: [(r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text)])
    assert turn_repair.repair(talks.limit(0)).count() == 0


def test_repairs_of_long_conversations_are_the_same_in_pieces(spark, talks, monkeypatch):
    whole = repaired(talks)
    monkeypatch.setattr(turn_repair, "LONG_TURNS", 2)
    for turns in (1, 3, 256):
        monkeypatch.setattr(turn_repair, "PIECE_TURNS", turns)
        assert repaired(talks) == whole


def test_damaged_conversations_are_all_returned(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    want = expected(rows, damaged)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turn_repair.query(spark, SF).collect()}
    assert found == {r.conv_id: want.get(r.conv_id, nothing) for r in rows}


def test_a_conversation_that_loses_all_rows_is_empty(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, None, None)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in turn_repair.query(spark, str(tmp_path)).collect()}
    assert set(found) == {gone, None} and found[gone].audit == "" and found[gone].cost == 0 and found[gone].repaired_sha256 == hashlib.sha256(b"").hexdigest()


# 13
def groups_by_pairs(texts, width, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return sets, label


def variants(rng):
    """Texts of 1 to 900 words in chains of edits, with a passage that many share, and copies."""
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared, texts = say(40), ["", None, "   "]
    for n in (1, 2, 3, 4, 7, 9, 15, 16, 31, 33, 60, 90, 130, 257, 500, 900):
        one = say(n)
        texts.append(" ".join(one))
        for _ in range(5):
            one = list(one)
            for _ in range(rng.randrange(1, 2 + n // 60)):
                one[rng.randrange(len(one))] = rng.choice(vocabulary)
            texts += [" ".join(one), " ".join(one + one[:1]).upper()]
    texts += [" ".join(say(12) + shared + say(12)) for _ in range(40)]
    texts += [" ".join(shared + say(rng.randrange(1, 5))) for _ in range(40)]
    texts += [texts[9]] * 4
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (2, 70)])
def test_near_duplicate_groups_are_those_of_all_pairs(spark, width, percent):
    texts = variants(random.Random(width))
    sets, label = groups_by_pairs(texts, width, percent)
    found = {r.doc_id: r for r in hyper_minhash.near_duplicates(spark.createDataFrame(rows_of(texts), SCHEMA), width, percent).collect()}
    assert len(found) == len(texts) > len(set(label)) > 30
    for i in range(len(texts)):
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(sets[i]), label[i], label[i] == i)


def test_crowds_and_hot_keys_give_the_same_groups(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(220):
        one = list(base)
        for _ in range(rng.choice([1, 1, 2, 7, 9])):
            one[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(one))
    _, label = groups_by_pairs(texts, 3, 85)
    assert 1 < len(set(label)) < 200
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    hot = hyper_minhash.hot_keys
    monkeypatch.setattr(hyper_minhash, "hot_keys", lambda table, share, often: hot(table, 1, 5))
    assert {r.doc_id: r.component_id for r in hyper_minhash.near_duplicates(docs).collect()} == dict(enumerate(label))
    monkeypatch.setattr(jaccard_join, "FEW", 3)
    assert {r.doc_id: r.component_id for r in hyper_minhash.near_duplicates(docs).collect()} == dict(enumerate(label))


def test_estimates_are_right_on_average_and_free_of_chance():
    rng = np.random.default_rng(5)
    count = hyper_minhash.bands(85) * hyper_minhash.BAND
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
    for n in (5, 40, 300, 5000):
        found, apart = [], []
        for _ in range(60):
            common, one, two = draw(round(n * 0.8)), draw(n - round(n * 0.8)), draw(n - round(n * 0.8))
            a, b = (np.unique(np.concatenate([common, x])) for x in (one, two))
            at, load = n.bit_length() - 1, n / hyper_minhash.buckets_of(n.bit_length() - 1, count)
            held = [hyper_minhash.registers(x, at, count) for x in (a, b)]
            found.append(hyper_minhash.estimate(*held, load)[0])
            apart.append(hyper_minhash.estimate(held[0], hyper_minhash.registers(np.unique(draw(n)), at, count), load)[0])
        truth = round(n * 0.8) / (2 * n - round(n * 0.8))
        assert abs(np.mean(found) - truth) < 0.02 and abs(np.mean(apart)) < 0.003
    assert 0 < hyper_minhash.chance(8.0) < 0.001


def test_near_duplicates_of_odd_tables(spark, odd):
    found = hyper_minhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[12].component_id == by[13].component_id == by[14].component_id == 12 and by[7].component_id == by[8].component_id == 7
    assert all(by[i].n_shingles == 0 and by[i].component_id == i and by[i].kept for i in range(4))
    nobody = [r for r in found if r.doc_id is None]
    assert sorted((r.n_shingles == 0, r.component_id) for r in nobody if r.component_id is not None) == [(False, 12)] and all(r.kept is None for r in nobody)
    assert hyper_minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
