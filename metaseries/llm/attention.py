"""A small causal self-attention model over subword ids in numpy: forward, backward, scoring.

The output is a two-level softmax over all ids (Grave et al. 2017): the most frequent
ids are classes of their own, the others lie in clusters, and both levels depend on the
context. Ids that no training text has share a class, evenly.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Positions of a context window, and how far the next window starts behind it.
CONTEXT, STRIDE = 32, 24
WIDTH = 16
#: Ids that are classes of their own, and ids of a cluster.
SINGLES, CLUSTER = 32, 128
#: Ids of a cluster of the more frequent ids, and how many ids count as such.
NARROW, FREQUENT = 32, 512
#: Windows of a training batch; windows whose inner states are found at once, and such lots whose ids are scored together.
BATCH, SCORED, LOTS = 64, 128, 16
#: Positions whose classes are weighed at once.
BLOCK = 2048
#: What a rate falls to, as a share of itself.
LEAST_RATE = 0.02
#: Ids are below this; the last one ends a text.
IDS = 1 << 16
END = IDS - 1

DENSE = ("place", "qkv", "out", "up", "down", "head", "bias")
ROWS = ("embed", "tail", "tail_bias")
NAMES = (*DENSE, *ROWS)


@dataclass(frozen=True)
class Vocabulary:
    """Which place of the output stands for each id.

    ``seen`` are the ids of the training texts, the more frequent first. ``row`` is an
    id's place among them (the place after the last for all others), ``of`` its class,
    ``within`` its place in its cluster (-1: none). The last class is that of unseen ids.
    """

    seen: np.ndarray
    count: np.ndarray
    row: np.ndarray
    of: np.ndarray
    within: np.ndarray

    @classmethod
    def from_counts(cls, count: dict[int, int], singles: int = SINGLES, cluster: int = CLUSTER) -> Vocabulary:
        seen = np.array(sorted(count, key=lambda i: (-count[i], i)), dtype=np.int64)
        row = np.full(IDS, len(seen), dtype=np.int32)
        row[seen] = np.arange(len(seen))
        narrow = np.arange(singles, max(FREQUENT, singles), min(NARROW, cluster))
        wide = np.arange(narrow[-1] + min(NARROW, cluster) if len(narrow) else singles, max(len(seen), singles), cluster)
        starts = np.concatenate([narrow, wide])
        starts = starts[starts < len(seen)]  # of each cluster
        nth = np.searchsorted(starts, row, "right") - 1
        alone = min(len(seen), singles)
        of = np.where(row < alone, row, alone + nth)
        of = np.where(row == len(seen), alone + len(starts), of).astype(np.int32)
        within = np.where((nth >= 0) & (row < len(seen)), row - np.append(starts, 0)[nth], -1).astype(np.int32)
        return cls(seen, np.array([count[int(i)] for i in seen], dtype=float), row, of, within)

    @cached_property
    def classes(self) -> int:
        return int(self.of.max()) + 1

    @cached_property
    def alone(self) -> int:
        """Classes of one id."""
        return int((self.within[self.seen] < 0).sum())

    @cached_property
    def cluster(self) -> int:
        return int(self.within.max()) + 1

    @cached_property
    def groups(self) -> list[tuple[int, int, int]]:
        """Runs of clusters, of narrow ones and of others: first, last (not included), width."""
        in_tail = self.seen[self.alone :]
        widths = np.bincount(self.of[in_tail] - self.alone)
        narrow = int(np.argmax(np.append(widths, NARROW + 1) > NARROW))
        runs = ((0, narrow), (narrow, len(widths)))
        return [(a, b, int(widths[a:b].max())) for a, b in runs if a < b]

    @cached_property
    def unseen_log(self) -> float:
        """The log probability of an id among those that were not seen."""
        return -float(np.log(max(1, IDS - len(self.seen))))


def initial(vocabulary: Vocabulary, width: int = WIDTH, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; the output starts at the ids' own frequencies."""
    rng, d = np.random.default_rng(seed), width
    v, k, clusters = len(vocabulary.seen), vocabulary.classes, vocabulary.classes - 1 - vocabulary.alone
    draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {
        "embed": draw(0.5, v + 1, d), "place": draw(0.1, CONTEXT, d), "qkv": draw(d**-0.5, d, 3 * d), "out": draw(0.3 * d**-0.5, d, d),
        "up": draw(d**-0.5, d, 2 * d), "down": draw(0.3 * (2 * d) ** -0.5, 2 * d, d), "head": draw(0.3 * d**-0.5, d, k), "tail": draw(0.3 * d**-0.5, clusters, vocabulary.cluster, d),
    }
    p["qkv"][:, :d] *= np.float32(d**-0.5)
    mass = np.bincount(vocabulary.of[vocabulary.seen], vocabulary.count, k) + 1
    p["bias"] = np.log(mass / mass.sum()).astype(np.float32)
    p["tail_bias"] = np.full((clusters, vocabulary.cluster), -np.inf, dtype=np.float32)
    in_tail = vocabulary.seen[vocabulary.alone :]
    at = vocabulary.of[in_tail] - vocabulary.alone, vocabulary.within[in_tail]
    p["tail_bias"][at] = np.log(vocabulary.count[vocabulary.alone :])
    p["tail_bias"] -= np.log(np.exp(p["tail_bias"]).sum(axis=1, keepdims=True)) if clusters else np.float32(0)
    return p


_causal = np.tril(np.ones((CONTEXT, CONTEXT), dtype=np.float32))


def _ordinary(total: np.ndarray) -> bool:
    """Whether sums of powers are such that neither they nor what is divided by them leave the range of the numbers."""
    return not total.size or bool(total.min() > 1e-15 and total.max() < 1e15)


def _attended(qkv: np.ndarray, first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From position ``first`` of each window on: powers of the scores, what they gather
    (over their sums), and the sums; and the values with a column of ones."""
    n, d = qkv.shape[1], qkv.shape[2] // 3
    values = np.ones((len(qkv), n, d + 1), dtype=qkv.dtype)
    values[:, :, :d] = qkv[:, :, 2 * d :]
    z = qkv[:, first:, :d] @ qkv[:, :, d : 2 * d].transpose(0, 2, 1)
    causal = _causal[first:n, :n].astype(z.dtype, copy=False)
    with np.errstate(over="ignore", invalid="ignore"):
        a = np.exp(z)
        a *= causal
        found = a @ values
    total = found[:, :, d:]
    if not _ordinary(total):
        z = np.where(causal > 0, z, -np.inf)
        a = np.exp(z - z.max(axis=2, keepdims=True))
        found = a @ values
        total = found[:, :, d:]
    return a, found[:, :, :d] / total, total, values


def _powers(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """The powers of ``z``, their sums by row, and what was taken off each exponent first.

    Trained weights keep exponents small, so nothing is taken off unless a sum is out of
    the ordinary.
    """
    one = np.ones(z.shape[1], dtype=z.dtype)
    with np.errstate(over="ignore", invalid="ignore"):
        e = np.exp(z)
        total = e @ one
    if _ordinary(total):
        return e, total, 0.0
    top = z.max(axis=1)
    e = np.exp(z - top[:, None])
    return e, e @ one, top


def _with_one(y: np.ndarray) -> np.ndarray:
    """A column of ones beside ``y``, for what is added in any case."""
    out = np.ones((len(y), y.shape[1] + 1), dtype=y.dtype)
    out[:, :-1] = y
    return out


def _tails(v: Vocabulary, of: np.ndarray, within: np.ndarray, wanted: np.ndarray):
    """Of the places of ids in clusters among ``wanted``, by group of clusters: its number, the places
    by cluster, and runs ``(cluster, from, to)`` of each cluster among them."""
    at = np.flatnonzero((within >= 0) & wanted)
    cluster = (of[at] - v.alone).astype(np.uint16)
    order = np.argsort(cluster, kind="stable")
    at, cluster = at[order], cluster[order]
    for group, (low, high, _) in enumerate(v.groups):
        ends = np.searchsorted(cluster, np.arange(low, high + 1)).tolist()
        runs = [(c, s - ends[0], e - ends[0]) for c, s, e in zip(range(low, high), ends, ends[1:], strict=False) if e > s]
        if runs:
            yield group, at[ends[0] : ends[-1]], runs


class Scorer:
    """The forward pass with everything that does not depend on the text computed once."""

    def __init__(self, p: dict[str, np.ndarray], vocabulary: Vocabulary):
        self.p, self.v = p, vocabulary
        self.of_id, self.of_place = p["embed"] @ p["qkv"], p["place"] @ p["qkv"]
        self.head = np.concatenate([p["head"], p["bias"][None]])
        self.tail = np.concatenate([p["tail"].transpose(0, 2, 1), p["tail_bias"][:, None]], axis=1)

    def hidden(self, x: np.ndarray, first: int) -> np.ndarray:
        """The inner state, and a one, from position ``first`` of each window on; a row a position."""
        p, row = self.p, self.v.row[x]
        n = x.shape[1]
        qkv = self.of_id.take(row, axis=0)
        qkv += self.of_place[:n]
        _, o, _, _ = _attended(qkv, first)
        y = p["embed"].take(row[:, first:], axis=0)
        y += p["place"][first:n]
        y = y.reshape(-1, y.shape[2])
        y += o.reshape(y.shape) @ p["out"]
        g = y @ p["up"]
        np.maximum(g, 0, out=g)
        y += g @ p["down"]
        return _with_one(y)

    def logs(self, y: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each of ``ids`` at the inner state beside it."""
        v = self.v
        of, within = v.of[ids], v.within[ids]
        out = np.empty(len(ids), dtype=y.dtype)
        for at in range(0, len(ids), BLOCK):
            z = y[at : at + BLOCK] @ self.head
            hit = z[np.arange(len(z)), of[at : at + BLOCK]]
            _, total, top = _powers(z)
            out[at : at + BLOCK] = hit - np.log(total) - top
        out[of == v.classes - 1] += v.unseen_log
        for group, own, runs in _tails(v, of, within, True):
            own_y, place, width = y[own], within[own], v.groups[group][2]
            for c, s, e in runs:
                tail = self.tail[c][:, :width]
                for at in range(s, e, BLOCK):
                    to = min(at + BLOCK, e)
                    z = own_y[at:to] @ tail
                    hit = z[np.arange(to - at), place[at:to]]
                    _, total, top = _powers(z)
                    out[own[at:to]] += hit - np.log(total) - top
        return out

    def log_probabilities(self, x: np.ndarray, target: np.ndarray, first: int) -> np.ndarray:
        """Natural log probability of the ids ``target`` from position ``first`` of each window on."""
        return self.logs(self.hidden(x, first), target[:, first:].ravel()).reshape(len(x), -1)


def _in_groups(p: dict[str, np.ndarray], v: Vocabulary) -> list[np.ndarray]:
    """The clusters' weights by group, as wide as its clusters are; an id's bias stands behind its weights."""
    return [np.concatenate([p["tail"][a:b, :width], p["tail_bias"][a:b, :width, None]], axis=2) for a, b, width in v.groups]


def gradients(p: dict[str, np.ndarray], v: Vocabulary, x: np.ndarray, target: np.ndarray, valid: np.ndarray) -> tuple[float, dict[str, object]]:
    """Mean loss over the valid positions and its gradients; those of ``ROWS`` as (rows, values)."""
    loss, grad, tails = _gradients(p, _in_groups(p, v), v, x, target, valid)
    grad |= {"tail": None, "tail_bias": None}
    if tails:
        at = np.concatenate([rows + v.groups[group][0] for group, (rows, _) in tails.items()])
        found = np.concatenate([np.pad(g, ((0, 0), (0, v.cluster - g.shape[1]), (0, 0))) for _, g in tails.values()])
        grad |= {"tail": (at, found[:, :, :-1]), "tail_bias": (at, found[:, :, -1])}
    return loss, grad


def _gradients(p: dict[str, np.ndarray], groups: list[np.ndarray], v: Vocabulary, x: np.ndarray, target: np.ndarray, valid: np.ndarray) -> tuple[float, dict[str, object], dict]:
    """Mean loss and its gradients, and by group those of ``groups`` as (clusters in it, values).

    Rows of powers are not divided by their sums: the vectors that they are multiplied with are.
    """
    (b, n), d = x.shape, p["qkv"].shape[0]
    kind = p["qkv"].dtype
    count = max(1, int(valid.sum()))
    row = v.row[x].ravel()
    windows = lambda t: t.reshape(b, n, -1)
    h = p["embed"].take(row, axis=0)
    windows(h)[:] += p["place"][:n]
    qkv = h @ p["qkv"]
    a, o, total, values = _attended(windows(qkv))
    r = o.reshape(h.shape) @ p["out"]
    r += h
    g = r @ p["up"]
    np.maximum(g, 0, out=g)
    y = g @ p["down"]
    y += r
    y1 = _with_one(y)
    ids, weight = target.ravel(), valid.ravel() / kind.type(count)
    of, within = v.of[ids], v.within[ids]

    def softened(z: np.ndarray, place: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss of the outputs ``z``; its gradient by ``z``, over a factor for each row; and the factors."""
        at = np.arange(len(z)) * z.shape[1] + place
        hit = z.ravel()[at]
        e, total, top = _powers(z)
        e.ravel()[at] -= total
        return -float(((hit - np.log(total) - top) * w).sum()), e, (w / total)[:, None]

    loss, z, share = softened(y1 @ np.concatenate([p["head"], p["bias"][None]]), of, weight)
    dy = z @ p["head"].T
    dy *= share
    dhead = (z.T @ (y1 * share)).T
    grad: dict[str, object] = {"head": dhead[:-1], "bias": dhead[-1]}
    tails = {}
    for group, own, runs in _tails(v, of, within, weight > 0):
        low, w, part = v.groups[group][0], groups[group], y1[own]
        t, back, found = (np.empty(shape, dtype=kind) for shape in ((len(own), w.shape[1]), (len(own), d), (len(runs), *w.shape[1:])))
        for c, s, e in runs:
            np.dot(part[s:e], w[c - low].T, out=t[s:e])
        more, t, share = softened(t, within[own], weight[own])
        loss += more
        part *= share
        for i, (c, s, e) in enumerate(runs):
            np.dot(t[s:e], w[c - low, :, :d], out=back[s:e])
            np.dot(t[s:e].T, part[s:e], out=found[i])
        back *= share
        dy[own] += back
        tails[group] = np.array([c - low for c, _, _ in runs]), found
    dg = dy @ p["down"].T
    dg *= g > 0
    dr = dg @ p["up"].T
    dr += dy
    # the last column takes each row's mean off its scores' gradients
    do = np.empty_like(values)
    np.divide(windows(dr @ p["out"].T), total, out=do[:, :, :d])
    np.negative(np.vecdot(do[:, :, :d], o), out=do[:, :, d])
    da = do @ values.transpose(0, 2, 1)
    da *= a
    dqkv = np.empty((b, n, 3 * d), dtype=kind)
    dqkv[:, :, 2 * d :] = a.transpose(0, 2, 1) @ do[:, :, :d]
    dqkv[:, :, :d] = da @ windows(qkv)[:, :, d : 2 * d]
    dqkv[:, :, d : 2 * d] = da.transpose(0, 2, 1) @ windows(qkv)[:, :, :d]
    dqkv = dqkv.reshape(b * n, 3 * d)
    dh = dqkv @ p["qkv"].T
    dh += dr
    order = np.argsort(row.astype(np.uint16), kind="stable")
    sorted_rows = row[order]
    starts = _grouped_starts(sorted_rows)
    grad["embed"] = (sorted_rows[starts], np.add.reduceat(dh[order], starts, axis=0))
    place = np.zeros_like(p["place"])
    place[:n] = windows(dh).sum(axis=0)
    grad |= {"place": place, "qkv": h.T @ dqkv, "out": o.reshape(h.shape).T @ dr, "up": r.T @ dg, "down": g.T @ dy}
    return loss, grad, tails


def _grouped_starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def train(p: dict[str, np.ndarray], v: Vocabulary, batches: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], rate: float, steps: int = 0) -> tuple[dict[str, np.ndarray], float]:
    """Adam over ``batches`` of (x, target, valid), for rows of ids only where they occur; weights and mean loss after it.

    The rate falls evenly over ``steps`` batches to ``LEAST_RATE`` of itself and stays there.
    """
    p = {k: w.copy() for k, w in p.items()}
    # the dense weights lie in one array
    ends = np.cumsum([0, *(p[k].size for k in DENSE)])
    dense = np.concatenate([p[k].ravel() for k in DENSE])
    p |= {k: dense[a:b].reshape(p[k].shape) for k, a, b in zip(DENSE, ends, ends[1:], strict=False)}
    groups = _in_groups(p, v)
    held = {"": dense, "embed": p["embed"]} | dict(enumerate(groups))
    # sums of the gradients and of their squares, of which older ones fade: 10 and 100 times the means
    m = {k: np.zeros_like(w) for k, w in held.items()}
    s = {k: np.zeros_like(w) for k, w in held.items()}
    losses = []
    for step, (x, target, valid) in enumerate(batches, 1):
        loss, grad, tails = _gradients(p, groups, v, x, target, valid)
        losses.append(loss)
        now = rate * max(LEAST_RATE, 1 - (step - 1) / steps) if steps else rate
        root = 0.1 / (1 - 0.99**step) ** 0.5  # by what the root of a sum of squares is that of their mean
        up, least = dense.dtype.type(0.1 * now / (1 - 0.9**step) / root), dense.dtype.type(1e-8 / root)
        every = {"": (slice(None), np.concatenate([grad[k].ravel() for k in DENSE])), "embed": grad["embed"], **tails}
        for k, (at, g) in every.items():
            if not isinstance(at, slice) and len(at) == len(held[k]):
                at = slice(None)  # all rows, in order
            mk, sk = m[k][at], s[k][at]  # themselves where all rows are meant, else copies
            mk *= np.float32(0.9)
            mk += g
            sk *= np.float32(0.99)
            np.multiply(g, g, out=g)
            sk += g
            if not isinstance(at, slice):
                m[k][at], s[k][at] = mk, sk
            np.sqrt(sk, out=g)
            g += least
            np.divide(mk, g, out=g)
            g *= up
            held[k][at] -= g
    for (low, high, width), w in zip(v.groups, groups, strict=True):
        p["tail"][low:high, :width], p["tail_bias"][low:high, :width] = w[:, :, :-1], w[:, :, -1]
    return p, float(np.mean(losses)) if losses else 0.0


def training_windows(texts: list[np.ndarray]) -> np.ndarray:
    """Windows that cover all positions of all texts, one after the other: a row has the
    id before its first position, then its ids; -1 beyond the text."""
    if not texts:
        return np.empty((0, CONTEXT + 1), dtype=np.int32)
    ids = np.concatenate([[END], *texts]).astype(np.int32)
    length = np.array(list(map(len, texts)), dtype=np.int64)
    count = -(-length // CONTEXT)
    starts = np.cumsum(length) - length  # of each text in ids, one to the left
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (np.repeat(starts, count) + nth * CONTEXT)[:, None] + np.arange(CONTEXT + 1)
    ends = np.repeat(starts + length, count)[:, None]
    found = ids[np.minimum(at, len(ids) - 1)]
    found[at > ends] = -1
    found[nth == 0, 0] = END
    return found


def batch(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and valid positions of training windows."""
    valid = rows[:, 1:] >= 0
    rows = np.where(rows < 0, END, rows)
    return rows[:, :-1], rows[:, 1:], valid


def scored_windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rows, first, place`` of overlapping windows over the texts.

    Rows are like training windows, but a text's next one starts ``STRIDE`` on. ``first``
    is the first position that a window scores: 0 in a text's first window, else the
    first beyond the window before; so each position is scored once. ``place`` is the
    window's first position in all texts together.
    """
    if not texts:
        return np.empty((0, CONTEXT + 1), dtype=np.int32), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    ids = np.concatenate([[END], *texts]).astype(np.int32)
    length = np.array(list(map(len, texts)), dtype=np.int64)
    count = 1 + np.maximum(0, -(-(length - CONTEXT) // STRIDE))
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = (np.cumsum(length) - length)[owner] + nth * STRIDE
    at = place[:, None] + np.arange(CONTEXT + 1)
    found = ids[np.minimum(at, len(ids) - 1)]
    found[at > np.cumsum(length)[owner][:, None]] = -1
    found[nth == 0, 0] = END
    return found, np.where(nth > 0, CONTEXT - STRIDE, 0), place


def position_logs(scorer: Scorer, texts: list[np.ndarray]) -> np.ndarray:
    """The natural log probability of each id of the texts (ends among them), one text after the other."""
    rows, firsts, place = scored_windows(texts)
    out = np.zeros(sum(map(len, texts)))
    for first in (0, CONTEXT - STRIDE):
        group = np.flatnonzero(firsts == first)
        for at in range(0, len(group), SCORED * LOTS):
            own = group[at : at + SCORED * LOTS]
            x, target, valid = batch(rows[own])
            valid = valid[:, first:]
            to = place[own][:, None] + np.arange(first, CONTEXT)
            y = np.concatenate([scorer.hidden(x[i : i + SCORED], first) for i in range(0, len(x), SCORED)])
            if valid.all():
                out[to.ravel()] = scorer.logs(y, target[:, first:].ravel())
            else:
                out[to[valid]] = scorer.logs(y[valid.ravel()], target[:, first:][valid])
    return out


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in NAMES])


def unflat(weights: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in NAMES:
        n = like[k].size
        out[k] = weights[at : at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out
