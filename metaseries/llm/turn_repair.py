"""Repair of conversations by the cheapest edits, found by a recursive DuckDB query.

Spark deals conversations by their id to tasks, and a task hands them on in batches of
whole conversations. In a batch one recursive query does the search: each recursion
advances one turn in all conversations, and of the edits that lead to one state of the
grammar it keeps the cheapest, of equally cheap ones the first by their letters. Two
edit strings of one cost that read equally many turns are never each other's prefix (an
insertion would cost), so the first of them stays the first whatever follows.

A conversation of very many turns or bytes is not given to one task. Its turns are
sorted by range and cut into pieces; the query finds each piece's cheapest edits between
any two states, and what is chained in one place are just these few edits a piece.

Turns that must be deleted leave the state as it is. They are left out of the search
and their letters put back right after the turn before them, which is the first of the
orders that cost the same.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import private, row_count_at_most, stash, tidy

WHITE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system turn, after a user's, after an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits; an undeleted truncated turn adds its own.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns or bytes beyond which a conversation is cut into pieces, and those of a piece.
LONG_TURNS, LONG_BYTES = 1_000, 8 << 20
PIECE_TURNS, PIECE_BYTES = 256, 1 << 20
#: Turns or bytes of a batch, which ends with a conversation.
BATCH_TURNS, BATCH_BYTES = 4_096, 4 << 20
#: Long conversations up to this number may be broadcast by their ids.
BROADCAST_IDS = 1_000_000


def inserted(state: int) -> int:
    """The state after an inserted (or newly named) turn: the user's or the assistant's."""
    return ASSISTANT if state == USER else USER


#: What ends a conversation in each state: its cost and letters.
ENDS = {NOTHING: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


def edits() -> list[tuple[int, str, int, int, str]]:
    """``state, code, target, cost, letters`` of all ways to go on by one turn.

    A code is the role's initial (x for others), upper-case where the turn is truncated.
    Up to two insertions go before; more would come back to a state.
    """
    found = []
    for start in range(4):
        state, letters = start, ""
        for _ in range(3):
            paid = INSERT * len(letters)
            for code in "suaxSUAX":
                more = TRUNCATED if code.isupper() else 0
                found.append((start, code, state, paid + DELETE, letters + "D"))
                found.append((start, code, inserted(state), paid + REROLE + more, letters + "R"))
                kept = {"s": SYSTEM if state == NOTHING else None, "u": USER if state != USER else None, "a": ASSISTANT if state == USER else None}.get(code.lower())
                if kept is not None:
                    found.append((start, code, kept, paid + more, letters + "K"))
            state, letters = inserted(state), letters + "I"
    return found


WALK = """
with recursive walk as (
  select lane, entry, 0 as at, entry as state, struct_pack(cost := 0::bigint, letters := '') as best from lanes
  union all
  select w.lane, w.entry, w.at + 1, e.target, min(struct_pack(cost := w.best.cost + e.cost, letters := w.best.letters || e.letters))
  from walk w join lanes l on l.lane = w.lane and l.entry = w.entry join edits e on e.state = w.state and e.code = l.codes[w.at + 1]
  group by w.lane, w.entry, w.at, e.target
)
select w.lane, w.entry, w.state, w.best.cost as cost, w.best.letters as letters
from walk w join lanes l on l.lane = w.lane and l.entry = w.entry
where w.at = length(l.codes)
"""


class Search:
    """The recursive query, in a DuckDB of the task's own."""

    def __init__(self):
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})
        self.db.execute("create table edits (state int, code varchar, target int, cost int, letters varchar)")
        self.db.executemany("insert into edits values (?, ?, ?, ?, ?)", edits())

    def moves(self, codes: list[str], entries: tuple[int, ...]) -> list[list[tuple[int, int, int, str]]]:
        """Of each string of codes the cheapest ``entry, state, cost, letters`` from each of the entries to each state."""
        lanes = [(i, entry, code) for i, code in enumerate(codes) for entry in entries]
        lane, entry, code = zip(*lanes, strict=True) if lanes else ((),) * 3
        self.db.register("lanes", pa.table({"lane": pa.array(lane, pa.int32()), "entry": pa.array(entry, pa.int32()), "codes": pa.array(code, pa.string())}))
        out: list[list[tuple[int, int, int, str]]] = [[] for _ in codes]
        for lane, *move in self.db.execute(WALK).fetchall():
            out[lane].append(tuple(move))
        self.db.unregister("lanes")
        return out

    def close(self):
        self.db.close()


class Turns:
    """Turns of one conversation or piece: what is searched, what must go, and counts."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.codes: list[str] = []
        #: how many turns must go before the first that is searched, and after each
        self.runs = [0]
        self.blank = self.duplicate = self.truncated = self.illegal = self.bytes = 0
        self.first = self.last = None

    def add(self, role: str, text: str, repeated: bool, copies: int = 1):
        """A turn, and ``copies`` - 1 like it right after; ``repeated``: it was seen before."""
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.last = initial
        said = text.rstrip(WHITE)
        if not said:
            self.blank += copies
            self.runs[-1] += copies
            return
        self.duplicate += copies - 1 + repeated
        if not repeated:
            cut = said[-1] not in ".!?"
            self.truncated += cut
            code = initial if initial and initial in "sua" else "x"
            self.roles.append(role)
            self.texts.append(text)
            self.codes.append(code.upper() if cut else code)
            self.runs.append(0)
            self.bytes += len(text)
        self.runs[-1] += copies - (not repeated)


def woven(letters: str, runs: list[int]) -> str:
    """The letters with those of the turns that must go, each run right after the turn before it."""
    out, at = ["D" * runs[0]], 0
    for letter in letters:
        out.append(letter)
        if letter != "I":
            at += 1
            out.append("D" * runs[at])
    return "".join(out)


def edited(letters: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The turns that the letters leave of those that were searched, from a state on."""
    out, rows = [], iter(zip(roles, texts, strict=True))
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = inserted(state)
            role = "user" if state == USER else "assistant"
        out.append((role, text))
    return out


_turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_result = "piece long, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"


def _batch(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    """Rows ``conv_id, piece, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``."""
    kinds = [kind, pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), _turn]
    names = ["conv_id", "piece", "whole", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    columns[-1] = [[{"role": r, "text": t} for r, t in turns] for turns in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _gaps(turns: set[int]) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations, sorted by id, turn, role and text: their repair."""
    search, kind = Search(), pa.null()
    done: list[tuple] = []  # conversations of the batch
    now, held = None, None

    def flush() -> pa.RecordBatch:
        rows = []
        for (conv_id, turns, numbers, _), moves in zip(done, search.moves(["".join(t.codes) for _, t, _, _ in done], (NOTHING,)), strict=True):
            cost, letters = min((cost + ENDS[state][0], letters + ENDS[state][1]) for _, state, cost, letters in moves)
            repaired = edited(letters, NOTHING, turns.roles, turns.texts)
            rows.append((conv_id, 0, True, _gaps(numbers), turns.blank, turns.duplicate, turns.truncated, turns.illegal, cost + DELETE * sum(turns.runs), woven(letters, turns.runs), repaired))
        done.clear()
        return _batch(kind, rows)

    try:
        size = bytes_ = 0
        for batch in batches:
            kind = batch.column(0).type
            for conv_id, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or conv_id != now:
                    if held is not None:
                        done.append(held)
                        if size >= BATCH_TURNS or bytes_ >= BATCH_BYTES:
                            yield flush()
                            size = bytes_ = 0
                    now, held = conv_id, (conv_id, Turns(), set(), set())
                _, turns, numbers, seen = held
                if turn is not None:
                    numbers.add(turn)
                turns.add(role, text, (role, text) in seen)
                seen.add((role, text))
                size, bytes_ = size + 1, bytes_ + len(text)
        if held is not None:
            done.append(held)
            yield flush()
    finally:
        search.close()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of long conversations, and the cheapest edits between any two states of each."""
    search, at = Search(), 0
    done: list[tuple] = []
    now, turns, part, kind = None, None, 0, pa.null()
    moves_kind = pa.list_(pa.struct([("entry", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))

    def flush() -> pa.RecordBatch:
        moves = search.moves(["".join(t.codes) for _, _, t in done], (NOTHING, SYSTEM, USER, ASSISTANT))
        columns = [
            pa.array([c for c, _, _ in done], kind), pa.array([part] * len(done), pa.int32()), pa.array([k for _, k, _ in done], pa.int32()),
            *[pa.array([getattr(t, name) for _, _, t in done], pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")],
            *[pa.array([getattr(t, name) for _, _, t in done], pa.string()) for name in ("first", "last")],
            *[pa.array([getattr(t, name) for _, _, t in done], pa.list_(pa.string())) for name in ("roles", "texts")],
            pa.array([t.runs for _, _, t in done], pa.list_(pa.int64())),
            pa.array([[dict(zip(("entry", "state", "cost", "letters"), m, strict=True)) for m in found] for found in moves], moves_kind),
        ]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "seq", "blank", "duplicate", "truncated", "illegal", "first", "last", "roles", "texts", "runs", "moves"])

    try:
        for batch in batches:
            kind = batch.column(0).type
            for conv_id, role, text, repeated, copies, part_now in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = part_now
                if turns is not None and (conv_id != now or len(turns.codes) >= PIECE_TURNS or turns.bytes >= PIECE_BYTES):
                    done.append((now, at, turns))
                    at, turns = at + 1, None
                    if sum(len(t.codes) for _, _, t in done) >= BATCH_TURNS or sum(t.bytes for _, _, t in done) >= BATCH_BYTES:
                        yield flush()
                if turns is None:
                    now, turns = conv_id, Turns()
                turns.add(role, text, repeated, copies)
        if turns is not None:
            done.append((now, at, turns))
            yield flush()
    finally:
        search.close()


class _Chain:
    """Cheapest edits through the pieces of one conversation, in order.

    Of the letters of each state only what follows their common beginning is held, as
    they are needed just to tell which of equally cheap ones comes first.
    """

    def __init__(self):
        self.best = {NOTHING: (0, "")}
        self.back: list[dict[int, int]] = []
        self.keys: list[tuple[int, int]] = []
        self.between, self.last = 0, None

    def add(self, part: int, seq: int, first: str, last: str, moves: list[dict]):
        if self.last is not None:
            self.between += self.last + first not in ("su", "ua", "au")
        self.last = last
        found: dict[int, tuple[int, str, int]] = {}
        for m in moves:
            if m["entry"] in self.best:
                cost, letters = self.best[m["entry"]]
                way = (cost + m["cost"], letters + m["letters"], m["entry"])
                if m["state"] not in found or way < found[m["state"]]:
                    found[m["state"]] = way
        common = len(os.path.commonprefix([letters for _, letters, _ in found.values()]))
        self.best = {state: (cost, letters[common:]) for state, (cost, letters, _) in found.items()}
        self.back.append({state: entry for state, (_, _, entry) in found.items()})
        self.keys.append((part, seq))

    def end(self) -> list[tuple]:
        """``part, seq, entry, state, final, cost, between`` of each piece."""
        cost, _, state = min((cost + ENDS[state][0], letters + ENDS[state][1], state) for state, (cost, letters) in self.best.items())
        out = []
        for (part, seq), back in zip(reversed(self.keys), reversed(self.back), strict=True):
            last = not out
            out.append((part, seq, back[state], state, last, cost if last else 0, self.between if last else 0))
            state = back[state]
        return out


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces' edits, sorted by conversation and place: which way each piece takes."""
    names = ["part", "seq", "entry", "state", "final", "total", "between"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]

    def out(chain: _Chain) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*chain.end(), strict=True), kinds, strict=True)], names=names)

    now, chain = None, None
    for batch in batches:
        for conv_id, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if chain is None or conv_id != now:
                if chain is not None:
                    yield out(chain)
                now, chain = conv_id, _Chain()
            chain.add(*piece)
    if chain is not None:
        yield out(chain)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the way each takes: their repair."""
    for batch in batches:
        rows = []
        for p in batch.to_pylist():
            letters = next(m["letters"] for m in p["moves"] if m["entry"] == p["entry"] and m["state"] == p["state"])
            tail = ENDS[p["state"]][1] if p["final"] else ""
            repaired = edited(letters + tail, p["entry"], p["roles"], p["texts"])
            rows.append((p["conv_id"], (p["part"] << 32) + p["seq"], False, p["gaps"] if p["final"] else 0, p["blank"], p["duplicate"], p["truncated"], p["illegal"] + p["between"], p["total"] + DELETE * sum(p["runs"]), woven(letters, p["runs"]) + tail, repaired))
        yield _batch(batch.column("conv_id").type, rows)


def _long(rows: DataFrame) -> DataFrame:
    """The repair of long conversations, in pieces."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    # repeated rows are counted, and what a row repeats is found by sums, so no task holds a conversation
    once = stash(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")))
    first = once.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(F.min(F.struct("turn")).alias("first"))
    earlier = F.col("turn").isNotNull() & (F.col("first.turn").isNull() | (F.col("turn") > F.col("first.turn")))
    known = once.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")))
    known = known.select("conv_id", "turn", "role", "text", earlier.alias("repeated"), "copies")
    placed = known.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 100)).sortWithinPartitions("conv_id", "turn", "role", "text")
    cut = placed.select("conv_id", "role", "text", "repeated", "copies", F.spark_partition_id().alias("part")).mapInArrow(
        tidy(_pieces),
        f"conv_id {kind}, part int, seq int, blank long, duplicate long, truncated long, illegal long, first string, last string, roles array<string>, texts array<string>, runs array<long>, moves array<struct<entry:int,state:int,cost:long,letters:string>>",
    )
    cut = stash(cut)
    order = cut.select("conv_id", "part", "seq", "first", "last", "moves").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    ways = stash(order.mapInArrow(_chained, "part int, seq int, entry int, state int, final boolean, total long, between long"))
    numbers = once.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("c"))
    gaps = numbers.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return cut.join(ways, ["part", "seq"]).join(gaps, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c").mapInArrow(tidy(_finished), f"conv_id {kind}, {_result}")


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The cheapest repair of each conversation that has a row.

    One row per conversation, or per piece of a long one: ``conv_id, piece, whole``
    (pieces in order by ``piece``), the counts ``gaps, blank, duplicate, truncated,
    illegal`` and ``cost`` (of pieces, to be added up), ``audit`` (the edits' letters) and
    ``repaired``, the turns that result. Rows are taken by turn, nulls first, then by role
    and text. Null roles and texts are one space; rows without id are a conversation of
    their own. Rows that agree in all four columns repeat each other, so all but one go
    as duplicates. An empty table gives no rows; other columns are not read.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    own = private("long")
    sizes = rows.groupBy(F.col("conv_id").alias(own)).agg(F.count(F.lit(1)).alias("turns"), F.sum(F.octet_length("text")).alias("bytes"))
    long = stash(sizes.where((F.col("turns") > LONG_TURNS) | (F.col("bytes") > LONG_BYTES)).select(own))
    few = F.broadcast(long) if row_count_at_most(long, BROADCAST_IDS) else long
    same = F.col("conv_id").eqNullSafe(F.col(own))
    short = rows.join(few, same, "left_anti").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    found = short.mapInArrow(tidy(_whole), f"conv_id {kind}, {_result}")
    if long.isEmpty():
        return found
    return found.unionByName(_long(rows.join(few, same, "left_semi")))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults that a checksum of conversation and turn fixes.

    Of 20 rows one is dropped, one emptied, one loses its full stops, one is repeated and
    one becomes the user's. Null roles and texts, and null ids in the checksum, are one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), draw.alias("draw")).where("draw <> 0")
    text = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of long conversations, sorted: their sums, whole audits and digests.

    A digest is taken of a conversation from front to end, so its turns pass one task,
    but only a batch of them is held.
    """
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    now, sums, audit, digest, begun, kind = None, None, [], None, False, pa.null()

    def out() -> pa.RecordBatch:
        columns = [pa.array([now], kind), *[pa.array([s], pa.int64()) for s in sums], pa.array(["".join(audit)], pa.string()), pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        kind = batch.column("conv_id").type
        for p in batch.to_pylist():
            if sums is None or p["conv_id"] != now:
                if sums is not None:
                    yield out()
                now, sums, audit, digest, begun = p["conv_id"], [0] * 6, [], hashlib.sha256(), False
            sums = [s + p[name] for s, name in zip(sums, names[1:7], strict=True)]
            audit.append(p["audit"])
            for turn in p["repaired"]:
                digest.update((("\n" if begun else "") + f"{turn['role']}:{turn['text']}").encode())
                begun = True
    if sums is not None:
        yield out()


def joined_turns(repaired: Column) -> Column:
    return F.array_join(F.transform(repaired, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def with_digests(found: DataFrame) -> DataFrame:
    """``repair``'s rows as one row per conversation, with ``repaired_sha256`` in place of the turns."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kind = found.schema["conv_id"].dataType.simpleString()
    whole = found.where("whole").select(*names, F.sha2(joined_turns(F.col("repaired")).cast("binary"), 256).alias("repaired_sha256"))
    pieces = found.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    kinds = ", ".join(f"{c} long" for c in names[1:7])
    return whole.unionByName(pieces.mapInArrow(tidy(_digests), f"conv_id {kind}, {kinds}, audit string, repaired_sha256 string"))


def query(spark, sf_dir: str) -> DataFrame:
    """Damage to all conversations and its cheapest repair; those that lost all rows too."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = with_digests(stash(repair(damage(conversations)))).withColumnRenamed("conv_id", "own")
    every = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
