"""Removal of passages that occur earlier in the corpus, by suffix trees of groups of suffixes that share a prefix.

A window is WINDOW words of one text. Windows that start alike hang below one inner node of the corpus' suffix tree, and
those that are equal below one at depth WINDOW. The tree is never held whole:

1. Of equal texts the first (least doc_id) stands for all; the others lose all words that a window covers.
2. Suffixes that cannot branch late are left out. Every window holds a marked position, the least hash of GRAM words
   in it, so equal windows hold equal marks; the windows round a mark that is alone in the corpus hang on leaves.
3. The other suffixes are dealt to groups by prefixes of variable length: BLOCK words, and as many blocks more as it takes
   until a group has at most `limit` suffixes. Groups of whole windows that are still larger differ in nothing: their
   first member is a pre-aggregated minimum.
4. In each group suffixes are sorted, and the common prefixes of neighbours give the inner nodes of its subtree. Below a node at
   depth WINDOW all leaves but the first one are repeats. Sorting spills; the walk holds one row.

Blocks, marks and texts are compared by hashes: 32 bits for each of the four blocks of a window, 64 for a mark, 96 for a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from nightglass.llm.common import write_out

WINDOW = 20
BLOCK = 5
BLOCKS = WINDOW // BLOCK
GRAM = 6
SPAN = WINDOW - GRAM + 1  # positions of a window at which its mark can stand
# Suffixes of one group, and the greatest number of groups that may be over it: what is broadcast has at most so many rows.
GROUP = 1 << 17
LARGE_GROUPS = 1 << 16
CELLS = 1 << 18
CHUNK_WORDS = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)
# The blocks of a window, two in a column.
WHOLE = ["high", "low"]
# A text's place in the corpus: rows without an id come last, texts of one id in the order of their hashes.
PLACE = ["none", "first_id", "th"]


def words_of(text: bytes | None) -> list[bytes]:
    """Words in UTF-8; `bytes.split` cuts at the blanks x20 and x09 to x0D and at nothing else."""
    return (text or b"").split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Numbers(dict):
    """64-bit numbers of words, the same on every machine."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def hashed(numbers: np.ndarray, n: int) -> np.ndarray:
    """A hash of numbers[i : i + n] for every i."""
    m = len(numbers) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = numbers[:m].copy()
        for j in range(1, n):
            h = h * BASE + numbers[j : j + m]
        return mixed(h)


def marks(numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram, at, first, last) of texts laid end to end: windows first..last have their mark at `at`, the leftmost of equal ones."""
    starts = np.concatenate(([0], ends[:-1]))
    grams = hashed(numbers, GRAM)
    real = ends - starts >= WINDOW
    if not real.any():
        return grams[:0], *(np.zeros(0, dtype=np.int64) for _ in range(3))
    # The lower bits hold the position, so that the minimum names its place.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    at = np.lib.stride_tricks.sliding_window_view(least, SPAN).min(axis=1) & np.uint64(0xFFFFFFFF)
    edges = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(edges, starts[real], 1)
    np.add.at(edges, ends[real] - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
    chosen = at[window].astype(np.int64)
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)))
    last = window[np.append(np.flatnonzero(new)[1:] - 1, len(window) - 1)]
    return grams[chosen[new]], chosen[new], window[new], last


def chunks(texts: list[list[bytes]], numbers: Numbers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word numbers, ends) of stretches of whole texts of about CHUNK_WORDS in all."""
    first, sizes, held = 0, [], []
    for i, words in enumerate(texts):
        held.extend(map(numbers.__getitem__, words))
        sizes.append(len(words))
        if len(held) >= CHUNK_WORDS or i == len(texts) - 1:
            yield first, np.array(held, dtype=np.uint64), np.cumsum(sizes)
            first, sizes, held = i + 1, [], []


def in_parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of a batch with the words of their texts, few texts at a time."""
    at, words, held = 0, [], 0
    for i, text in enumerate(batch.column(column).cast(pa.binary())):
        words.append(words_of(text.as_py()))
        held += len(words[-1])
        if held >= CHUNK_WORDS:
            yield batch.slice(at, i + 1 - at), words
            at, words, held = i + 1, [], 0
    if words:
        yield batch.slice(at), words


MARKS = "gram bigint, th bigint, at int"


def mark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for batch in batches:
        for part, texts in in_parts(batch, 1):
            for first, flat, ends in chunks(texts, numbers):
                gram, at, _, _ = marks(flat, ends)
                owner = np.searchsorted(ends, at, side="right")
                at = (at - np.concatenate(([0], ends[:-1]))[owner]).astype(np.int32)
                th = part.column(0).slice(first, len(ends)).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), th, pa.array(at)], ["gram", "th", "at"])


SUFFIXES = "high bigint, low bigint, none boolean, first_id bigint, th bigint, start int"


def suffix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window whose mark does not stand alone: its four blocks, its text's place in the corpus and where it starts."""
    numbers = Numbers()
    for batch in batches:
        for part, texts in in_parts(batch, 3):
            for first, flat, ends in chunks(texts, numbers):
                _, at, low, high = marks(flat, ends)
                owner = np.searchsorted(ends, at, side="right")
                starts = np.concatenate(([0], ends[:-1]))
                # Marks that stand alone, as positions of the texts laid end to end.
                alone = [np.asarray(a.values) + s for a, s in zip(part.column(4).slice(first, len(ends)), starts, strict=True) if a.is_valid]
                open_ = ~np.isin(at, np.concatenate(alone)) if alone else np.ones(len(at), dtype=bool)
                low, sizes, owner = low[open_], (high - low + 1)[open_], owner[open_]
                window = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                owner = np.repeat(owner, sizes)
                h = hashed(flat, BLOCK) >> np.uint64(32)
                two = lambda k: ((h[window + BLOCK * k] << np.uint64(32)) | h[window + BLOCK * (k + 1)]).view(np.int64)  # noqa: B023, E731
                row = pa.array(owner + first)
                place = [part.column(c).take(row) for c in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(two(0)), pa.array(two(2)), *place, pa.array((window - starts[owner]).astype(np.int32))], [c.split()[0] for c in SUFFIXES.split(", ")])


REPEATS = "none boolean, first_id bigint, th bigint, start int"


def walk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves that are not the first below their node at depth WINDOW, from leaves in sorted order.

    Neighbours that share all blocks hang below one such node. A leaf that stands twice, from repeated rows, is one leaf.
    """
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(6)])
        before = np.concatenate((rows[:, :1] if last is None else last, rows[:, :-1]), axis=1)
        again = (rows[:2] == before[:2]).all(axis=0) & (rows[2:] != before[2:]).any(axis=0)
        last = rows[:, -1:].copy()
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(again)) for k in range(2, 6)], [c.split()[0] for c in REPEATS.split(", ")])


def texts_of(docs: DataFrame) -> DataFrame:
    """(none, first_id, th, crc, text): (th, crc) names a text's content, a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("first_id"), F.xxhash64(text).alias("th"), F.crc32(text.cast("binary")).alias("crc"), text.alias("text"))


def lonely_marks(rows: DataFrame) -> DataFrame:
    """(th, alone): per text the positions of marks that no other position of a different text holds.

    Marks go back to their texts as lists of those that stand alone: no join is on a mark, so one that many texts share is
    never gathered; it is one row in the pre-aggregated counts. Copies of a text hold the same marks in the same places.
    """
    found = rows.select("th", "text").mapInArrow(mark_batches, MARKS)
    ends = found.groupBy("gram").agg(F.min("th").alias("th"), F.max("th").alias("th2"), F.min("at").alias("at"), F.max("at").alias("at2"))
    return ends.where("th = th2 AND at = at2").groupBy("th").agg(F.collect_list("at").alias("alone"))


def group_limit(n: int) -> int:
    return max(GROUP, -(-n // LARGE_GROUPS))


def prefix(k: int) -> Column:
    """A hash of the first k blocks of a suffix."""
    first, third = F.shiftrightunsigned("high", 32), F.shiftrightunsigned("low", 32)
    return F.xxhash64(*[[first], ["high"], ["high", third], WHOLE][k - 1])


def cell(k: int) -> Column:
    return F.pmod(prefix(k), F.lit(CELLS)) if k < BLOCKS else prefix(k)


def large_cells(suffixes: DataFrame, limit: int) -> list[DataFrame]:
    """Per prefix length the cells of more than `limit` suffixes, among those in a large cell of every shorter one.

    Fewer than one cell in `limit` suffixes is large. Longer prefixes are counted over what large cells hold, written apart.
    """
    found, rest = [], suffixes.select(*WHOLE)
    for k in range(1, BLOCKS + 1):
        over = write_out(rest.groupBy(cell(k).alias("cell")).agg(F.count("*").alias("n")).where(F.col("n") > limit).select("cell"), "large-cells")
        if over.isEmpty():
            break
        found.append(over)
        if k < BLOCKS:
            rest = write_out(rest.join(F.broadcast(over), cell(k) == over["cell"], "left_semi"), "in-large-cells")
    return found


def grouped(suffixes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(suffixes with a group (level, cell), the rest): groups hold whole prefixes and at most `limit` suffixes.

    A suffix goes to the shortest of its prefixes whose cell is not large. The rest, None if there is none, shares whole windows more
    than `limit` times over. Suffixes are dealt in one pass.
    """
    dealt, found = suffixes, large_cells(suffixes, limit)
    for k, over in enumerate(found, 1):
        side = F.broadcast(over.select(F.col("cell").alias(f"_cell{k}")))
        dealt = dealt.join(side, cell(k) == F.col(f"_cell{k}"), "left")
    level, place = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for k in range(min(len(found) + 1, BLOCKS), 0, -1):
        small = F.col(f"_cell{k}").isNull() if k <= len(found) else F.lit(True)
        level, place = F.when(small, k).otherwise(level), F.when(small, cell(k)).otherwise(place)
    dealt = dealt.select(*suffixes.columns, level.alias("level"), place.alias("cell"))
    if len(found) < BLOCKS:
        return dealt, None
    return dealt.where("level IS NOT NULL"), dealt.where("level IS NULL").select(*suffixes.columns)


def later_windows(suffixes: DataFrame, limit: int | None = None) -> DataFrame:
    """(none, first_id, th, start) of each window whose words start earlier too."""
    done, same = grouped(suffixes, limit or group_limit(suffixes.count()))
    order = [*PLACE, "start"]
    leaves = done.repartition("level", "cell").sortWithinPartitions("level", "cell", *WHOLE, *order)
    found = leaves.select(*WHOLE, *order).mapInArrow(walk_batches, REPEATS)
    if same is None:
        return found
    first = same.groupBy(*WHOLE).agg(F.min(F.struct(*order)).alias("one")).select("one.*")
    return found.unionByName(same.select(*order).join(first, order, "left_anti"))


def repeats_of(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """(doc_id, text, first, starts) per row of docs: whether it is the first with its text, and its repeated windows, as starts.

    A null text is empty, a null doc_id comes after all others. Rows that share id and text are one document and get equal
    results. Texts of one id are ordered by their hashes.
    """
    rows = texts_of(docs)
    place = F.min(F.struct("none", "first_id")).alias("place")
    firsts = rows.groupBy("th", "crc").agg(place).select("place.*", "th", "crc")
    texts = write_out(firsts.join(lonely_marks(rows), "th", "left").select(*PLACE, "crc", "alone"), "marked-texts")
    held = rows.join(texts, [*PLACE, "crc"]).select(*PLACE, "text", "alone")
    suffixes = write_out(held.mapInArrow(suffix_batches, SUFFIXES), "suffixes")
    later = later_windows(suffixes, limit).groupBy(*PLACE).agg(F.collect_set("start").alias("starts"))
    fates = write_out(texts.join(later, PLACE, "left").select(*PLACE, "crc", F.lit(True).alias("first"), "starts"), "fates")
    joined = rows.join(fates, [*PLACE, "crc"], "left")
    return joined.select(F.when(~F.col("none"), F.col("first_id")).alias("doc_id"), "text", F.coalesce("first", F.lit(False)).alias("first"), "starts")


KEPT = "doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
SPAN_TYPE = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def covered(n: int, first: bool, starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches of words that repeated windows cover."""
    if not first:
        return [(0, n)] if n >= WINDOW else []
    at = np.sort(starts)
    if len(at) == 0:
        return []
    cut = np.flatnonzero(at[1:] > at[:-1] + WINDOW)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + WINDOW).tolist(), strict=True))


def kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in in_parts(batch, 1):
            spans, kept = [], []
            for words, first, starts in zip(texts, part.column(2).to_pylist(), part.column(3), strict=True):
                runs = covered(len(words), first, np.asarray(starts.values) if starts.is_valid else np.zeros(0, dtype=np.int64))
                left, at = [], 0
                for a, b in runs:
                    left += words[at:a]
                    at = b
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b" ".join([*left, *words[at:]]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(spans, pa.list_(SPAN_TYPE)), pa.array(kept, pa.string())], [c.split()[0] for c in KEPT.split(", ")]
            )


def remove_passages(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """(doc_id, n_words, spans, kept) per row of docs: the removed stretches of words and the words left, joined by blanks.

    Windows are judged on the input. `limit` bounds a group of suffixes and changes no result. Null and empty texts have
    no words, texts of fewer than WINDOW words lose none, very long ones are taken whole. All rows are kept.
    """
    return repeats_of(docs, limit).mapInArrow(kept_batches, KEPT)


def passage_digest(kept: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))
