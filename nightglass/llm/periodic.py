"""Runs of repeated word patterns in a text: maximal stretches with a period q and at least four times its length.

A text of n words is cut by a grid of every q-th word, for each q up to n / 4 (the harmonic grid: n log n points in all). A run of
period q holds at least three neighbouring grid points whose words equal the next point's. From such a point the
longest common extension (LCE) of the word sequences that start q apart, forwards and backwards, gives the whole run.

LCE by a difference cover: only suffixes at positions whose residue modulo 7 lies in {0, 1, 3} are sorted. Any two positions
reach two sampled ones within the same few steps; these words are compared one by one, and the rest is a range minimum
over the common prefixes of neighbours in the sorted order, held in a sparse table.

Each text is worked on alone, inside one task; texts of a batch are laid end to end, apart by words that equal no other. Memory
is a bounded multiple (about 200 bytes a word) of the batch's chunk or of the longest text, whichever is more.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TIMES = 4
SHORTEST = 6
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CHUNK_WORDS = 200_000
MODULUS = 7
COVER = np.array([0, 1, 3])
SLOT = np.array([0, 1, -1, 2, -1, -1, -1])
# Steps from residues (i, j) to the nearest pair of sampled residues.
STEPS = np.array([[next(d for d in range(MODULUS) if SLOT[(i + d) % MODULUS] >= 0 <= SLOT[(j + d) % MODULUS]) for j in range(MODULUS)] for i in range(MODULUS)])


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def heads(new: np.ndarray) -> np.ndarray:
    """For each place the place of the last True at or before it."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


class Extensions:
    """Longest common extensions of positions of `s`, an array of word numbers from 1 that ends in a number of its own."""

    def __init__(self, s: np.ndarray):
        self.s = np.concatenate((s, np.zeros(2 * MODULUS, dtype=np.int64)))
        places = np.arange(3 * (len(s) // MODULUS + 1))
        self.at = places // 3 * MODULUS + COVER[places % 3]
        self.sort()

    def sort(self) -> None:
        """Ranks of the sampled suffixes: by their first MODULUS words, then by doubled lengths where still equal."""
        m, bits = len(self.at), int(self.s.max()).bit_length()
        per_key = max(1, 63 // bits)
        keys = []
        for first in range(0, MODULUS, per_key):
            key = np.zeros(m, dtype=np.int64)
            for j in range(first, min(first + per_key, MODULUS)):
                key = (key << bits) | self.s[self.at + j]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.concatenate(([True], np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)))
        rank = np.full(m + 1, -1, dtype=np.int64)  # one more for what lies beyond the end
        rank[order] = heads(new)
        levels, step = [rank.copy()], 3
        while step < m:
            # Places of suffixes that share their rank; the rest have found theirs.
            size = np.bincount(rank[:m], minlength=m)
            open_ = np.flatnonzero(size[rank[order]] > 1)
            if len(open_) == 0:
                break
            who = order[open_]
            first, second = rank[who], rank[np.minimum(who + step, m)]
            by = np.lexsort((second, first))
            who, first, second = who[by], first[by], second[by]
            order[open_] = who
            new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
            rank[who] = open_[heads(new)]
            levels.append(rank.copy())
            step *= 2
        self.rank = rank
        self.minima = self.sparse_table(self.neighbours(order, levels))

    def neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that each sampled suffix shares with the one before it in the order; 0 for the first."""
        m = len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(m - 1, dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = (levels[k][np.minimum(a, m)] == levels[k][np.minimum(b, m)]) & (np.maximum(a, b) < m)
            a, b = a + (3 << k) * same, b + (3 << k) * same
            shared += (MODULUS << k) * same
        alive = np.maximum(a, b) < m
        at_a, at_b = self.at[np.minimum(a, m - 1)], self.at[np.minimum(b, m - 1)]
        for j in range(MODULUS):
            alive &= self.s[at_a + j] == self.s[at_b + j]
            shared += alive
        return np.concatenate(([0], shared))

    @staticmethod
    def sparse_table(values: np.ndarray) -> list[np.ndarray]:
        table = [values.astype(np.int32)]
        while 2 << len(table) - 1 <= len(values):
            half, last = 1 << len(table) - 1, table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        return table

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value at places low..high."""
        out = np.zeros(len(low), dtype=np.int64)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(self.minima[k][low[of]], self.minima[k][high[of] - (1 << k) + 1])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the sequences from i and from j share, i != j."""
        steps = STEPS[i % MODULUS, j % MODULUS]
        shared, alive = np.zeros(len(i), dtype=np.int64), np.ones(len(i), dtype=bool)
        for t in range(MODULUS - 1):
            alive &= (t >= steps) | (self.s[i + t] == self.s[j + t])
            shared += alive & (t < steps)
        on = np.flatnonzero(alive)
        a, b = ((x + steps)[on] for x in (i, j))
        ra, rb = (self.rank[x // MODULUS * 3 + SLOT[x % MODULUS]] for x in (a, b))
        shared[on] += self.least(np.minimum(ra, rb) + 1, np.maximum(ra, rb))
        return shared


def grid_points(s: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, q): grid points from which as many neighbours as every run of period q holds equal their next one."""
    at, periods = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for q in range(1, longest // TIMES + 1):
        same = s[:-q:q] == s[q::q]
        for _ in range(max((SHORTEST - q) // q, TIMES - 1) - 1):
            same = same[:-1] & same[1:] if len(same) > 1 else same[:0]
        found = np.flatnonzero(same)
        if len(found):
            at.append(found * q)
            periods.append(np.full(len(found), q))
    return np.concatenate(at), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text, an array of word numbers from 1, its runs (start, length, period) by start, then period."""
    none = np.zeros((0, 3), dtype=np.int64)
    out = [none] * len(texts)
    top = max((int(t.max()) for t in texts if len(t)), default=0)

    def laid(which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The texts end to end, each closed by a number of its own, and their starts."""
        parts = [np.append(texts[k], top + 1 + i) for i, k in enumerate(which)]
        return np.concatenate(parts).astype(np.int64), np.cumsum([0] + [len(p) for p in parts])

    long_enough = [k for k, t in enumerate(texts) if len(t) >= SHORTEST]
    if not long_enough:
        return out
    s, starts = laid(long_enough)
    at, _ = grid_points(s, max(len(texts[k]) for k in long_enough))
    hold = [long_enough[i] for i in np.unique(np.searchsorted(starts, at, side="right") - 1)]
    if not hold:
        return out
    # Only texts with such points are sorted; positions are those of the shorter string.
    s, starts = laid(hold)
    at, q = grid_points(s, max(len(texts[k]) for k in hold))
    n = len(s)
    forwards = Extensions(s).common(at, at + q)
    # The mirror image ends in a number of its own as well; position p stands at n - p in it, what precedes p follows there.
    mirror = Extensions(np.append(s[::-1], top + len(hold) + 1))
    backwards = np.zeros(len(at), dtype=np.int64)
    inner = np.flatnonzero(at > 0)
    backwards[inner] = mirror.common(n - at[inner], n - at[inner] - q[inner])
    start, length = at - backwards, backwards + forwards + q
    real = length >= np.maximum(SHORTEST, TIMES * q)
    found = np.stack([start[real], length[real], q[real]], axis=1)
    # A stretch of period q has the periods 2q, 3q .. too: the least one counts.
    found = found[np.lexsort(found.T[[2, 1, 0]])]
    found = found[np.concatenate(([True], np.any(found[1:, :2] != found[:-1, :2], axis=1)))] if len(found) else found
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    for i in np.unique(owner):
        mine = found[owner == i] - [starts[i], 0, 0]
        out[hold[i]] = mine[np.lexsort(mine.T[[2, 0]])]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run holds after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word numbers that a text with planted repeats reads: one id in ten has its later words replaced by a pattern."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def found_batch(ids: list, words: list[list[str]], numbers: list[np.ndarray]) -> pa.RecordBatch:
    lists, texts = [], []
    for own, runs in zip(words, runs_of(numbers), strict=True):
        lists.append([{"start": a, "length": b, "period": c} for a, b, c in runs.tolist()])
        texts.append(" ".join(w for w, keep in zip(own, kept_words(len(own), runs).tolist(), strict=True) if keep) if len(runs) else " ".join(own))
    columns = [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(lists, pa.list_(RUN)), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def run_batches(change: Callable[[int | None, int], np.ndarray | None] | None):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, numbers, held, known = [], [], [], 0, {}
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                own = words_of(text.as_py())
                order = change(i.as_py(), len(own)) if change else None
                if order is not None:
                    own = [own[k] for k in order]
                ids.append(i.as_py())
                words.append(own)
                numbers.append(np.array([known.setdefault(w, len(known) + 1) for w in own], dtype=np.int64))
                held += len(own)
                if held >= CHUNK_WORDS:
                    yield found_batch(ids, words, numbers)
                    ids, words, numbers, held, known = [], [], [], 0, {}
            if ids:
                yield found_batch(ids, words, numbers)

    return found


def find_runs(docs: DataFrame, change: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of docs: its runs, and its words but for what repeats a run's first period.

    `change` may name, by doc_id and number of words, other words to read in place of a text's own. Null and
    empty texts have no words, no runs and an empty collapsed text. Rows are worked on alone, so null ids, repeated rows and
    other columns do no harm; very long texts are taken whole by one task. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run_batches(change), FOUND)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of several the one that starts first, then that of the least period; null without runs."""
    order = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    return F.array_max(order)


def run_digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of the runs and of the collapsed text, per row of find_runs.

    A text with planted repeats is read as changed; a row without an id never is.
    """
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", longest_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"),
        F.floor(1000 * best["length"] / (-best["p"])).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
