"""Exact removal of byte strings of WINDOW bytes that occur more than once in the corpus.

Suffixes are ordered by induction from a sample, as in induced suffix sorting: the sampled suffixes are
the local minima of a hash of the next GRAM bytes (every window holds one: its least), equal suffixes are found by
their leading bytes, and what hangs on a sampled suffix, the windows that contain it, is decided from it. Tuples carry the
common part of a range of windows. A range is dropped when its common part is unique, taken when
the whole stretch of bytes is repeated, and else halved, down to single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from nightglass.llm.common import write_out

WINDOW = 200
SPAN = 128  # windows that can share one sampled suffix; a power of two
GRAM = WINDOW - SPAN + 1
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "big") for b in range(256)], dtype=np.uint64)


def powers(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of data[i : i + GRAM] for every i, by doubling the length."""
    with np.errstate(over="ignore"):
        h, n, out, have = TABLE[data], 1, None, 0
        while True:
            if GRAM & n:
                # The stretch of n bytes follows the `have` bytes hashed so far.
                if out is None:
                    out = h
                else:
                    m = len(data) - have - n + 1
                    out = out[:m] * powers(n) + h[have : have + m]
                have += n
            if 2 * n > GRAM:
                return mixed(out)
            m = len(data) - 2 * n + 1
            h = h[:m] * powers(n) + h[n : n + m]
            n *= 2


def sampled(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, at, first, last) of the sampled suffixes of texts laid end to end.

    `ends` are the ends of the texts. The windows that start at first..last have their least gram at `at`; of equal
    grams the leftmost counts, so which one is chosen depends on the window's bytes alone.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none, none
    grams = gram_hashes(data)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    n = 1
    while n < SPAN:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(at) + 1, dtype=np.int32)
    real = ends - starts >= WINDOW
    np.add.at(inside, starts[real], 1)
    np.add.at(inside, ends[real] - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if len(window) == 0:
        return none.astype(np.uint64), none, none, none
    chosen = at[window]
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)))
    first = window[new]
    last = window[np.append(np.flatnonzero(new)[1:] - 1, len(window) - 1)]
    return grams[chosen[new]], chosen[new], first, last


def pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, owner, offset): texts laid end to end in stretches of about CHUNK; a longer text comes in
    overlapping parts, so that every window is in exactly one of them."""
    held, parts, owners, offsets = 0, [], [], []
    for i, text in enumerate(texts):
        if len(text) < WINDOW:
            continue
        for at in range(0, len(text) - WINDOW + 1, CHUNK):
            part = text[at : at + CHUNK + WINDOW - 1]
            parts.append(part), owners.append(i), offsets.append(at)
            held += len(part)
            if held >= CHUNK:
                yield b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(owners), np.array(offsets)
                held, parts, owners, offsets = 0, [], [], []
    if parts:
        yield b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(owners), np.array(offsets)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, th, crc, text): (th, crc) names a text's content; copies share it and have equal repeats."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text, F.octet_length(text)).alias("th"), F.crc32(text.cast("binary")).alias("crc"), text.alias("text"))


def gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, ends, _, _ in pieces([t.encode() for t in batch.column(0).to_pylist()]):
            grams = sampled(np.frombuffer(data, np.uint8), ends)[0]
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], ["gram"])


SAMPLES = "gram bigint, hull bigint, th bigint, crc bigint, at bigint, lo int, hi int"


def sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per sampled suffix: its gram, a hash of all bytes of its windows, and their offsets lo..hi before it."""
    for batch in batches:
        th, crc = (np.asarray(batch.column(i)) for i in (0, 1))
        for data, ends, owner, offset in pieces([t.encode() for t in batch.column(2).to_pylist()]):
            grams, at, first, last = sampled(np.frombuffer(data, np.uint8), ends)
            part = np.searchsorted(ends, at, side="right")
            lo, hi = at - last, at - first
            seeds = (lo * SPAN + hi).tolist()
            hulls = np.fromiter(
                (xxhash.xxh3_64_intdigest(data[a : b + WINDOW], seed=s) for a, b, s in zip(first.tolist(), last.tolist(), seeds, strict=True)), dtype=np.uint64, count=len(at)
            )
            shift = offset - np.concatenate(([0], ends[:-1]))
            doc = owner[part]
            columns = [grams.view(np.int64), hulls.view(np.int64), th[doc], crc[doc], at + shift[part], lo.astype(np.int32), hi.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in SAMPLES.split(", ")])


PIECES = "key binary, base int, single boolean, th bigint, crc bigint, at bigint, lo int, hi int, piece binary"


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all windows of each listed suffix of a text."""
    for batch in batches:
        th, crc, texts, lists = (batch.column(i) for i in range(4))
        out, held = [], 0
        for i in range(batch.num_rows):
            data, t, c = texts[i].as_py().encode(), th[i].as_py(), crc[i].as_py()
            for s in lists[i].as_py():
                out.append((s["gram"].to_bytes(8, "big", signed=True), 0, s["single"], t, c, s["at"], s["lo"], s["hi"], data[s["at"] - s["hi"] : s["at"] - s["lo"] + WINDOW]))
            held += len(data)
            if len(out) > 20_000 or held > 1 << 24:
                yield as_batch(out)
                out, held = [], 0
        yield as_batch(out)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PIECES.split(", ")])


def halved(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """Rows over `size` offsets cut into `parts`, each with the hash of its common part as key."""
    step = size // parts
    children = []
    for j in range(parts):
        base = F.col("base") + j * step
        lo, hi = F.greatest(F.col("lo"), base), F.least(F.col("hi"), base + (step - 1))
        piece = F.substring(F.col("piece"), F.col("hi") - hi + 1, hi - lo + WINDOW)
        children.append(F.when(lo <= hi, F.struct(base.cast("int").alias("base"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), piece.alias("piece"))))
    cut = rows.select("single", "th", "crc", "at", F.explode(F.filter(F.array(*children), lambda c: c.isNotNull())).alias("c")).select("single", "th", "crc", "at", "c.*")
    # The common part of offsets base .. base + step - 1 starts base bytes before the suffix.
    core = F.substring(F.col("piece"), F.col("hi") - F.col("base") + 1, F.lit(WINDOW - (step - 1)))
    return cut.withColumn("key", F.unhex(F.md5(core)))


def settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(taken, open): ranges found repeated, and one row per different piece of the groups to be cut further.

    A group has one key, the common part of its windows. A single row whose piece another row has too is taken. A group
    stays open if it has several pieces, one of them still single.
    """
    hulls = rows.withColumn("hull", F.xxhash64("piece", "lo", "hi"))
    pieces_ = hulls.groupBy("base", "key", "hull").agg(F.count("*").alias("n"), F.bool_or(~F.col("single")).alias("known"), F.min(F.struct("th", "crc", "at", "lo", "hi", "piece")).alias("one"))
    each = write_out(pieces_.select("base", "key", "hull", (F.col("known") | (F.col("n") > 1)).alias("again"), "one"), "pieces")
    again = each.where("again").select("base", "key", "hull")
    taken = hulls.where("single").select("base", "key", "hull", "th", "crc", "at", "lo", "hi").join(again, ["base", "key", "hull"], "left_semi")
    groups = each.groupBy("base", "key").agg(F.count("*").alias("hulls"), F.count_if(~F.col("again")).alias("singles")).where("hulls > 1 AND singles > 0").select("base", "key")
    open_ = each.join(groups, ["base", "key"], "left_semi").select("key", "base", (~F.col("again")).alias("single"), "one.*")
    return ranges_of(taken), open_


def ranges_of(rows: DataFrame) -> DataFrame:
    return rows.select("th", "crc", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + WINDOW).alias("end"))


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(th, crc, ranges): per text the byte ranges covered by repeated windows; they may overlap."""
    grams = texts.select("text").mapInArrow(gram_batches, "gram bigint").groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    samples = texts.select("th", "crc", "text").mapInArrow(sample_batches, SAMPLES)
    found = write_out(samples.join(grams, "gram", "left_semi"), "suffixes")
    hulls = write_out(found.groupBy("gram", "hull").agg(F.count("*").alias("n"), F.min(F.struct("th", "crc", "at", "lo", "hi")).alias("one")), "hulls")
    taken = [ranges_of(found.join(hulls.where("n > 1").select("gram", "hull"), ["gram", "hull"], "left_semi"))]
    groups = hulls.groupBy("gram").agg(F.count("*").alias("hulls"), F.count_if(F.col("n") == 1).alias("singles")).where("hulls > 1 AND singles > 0").select("gram")
    marks = hulls.join(groups, "gram", "left_semi").select("one.th", "one.crc", F.struct("gram", (F.col("n") == 1).alias("single"), "one.at", "one.lo", "one.hi").alias("s"))
    listed = marks.groupBy("th", "crc").agg(F.collect_list("s").alias("list"))
    one_text = texts.groupBy("th", "crc").agg(F.first("text").alias("text"))
    rows = write_out(one_text.join(listed, ["th", "crc"]).select("th", "crc", "text", "list").mapInArrow(cut_batches, PIECES), "open")
    size = SPAN
    while size > 1 and not rows.isEmpty():
        parts = min(4, size)
        cut = halved(rows, size, parts)
        size //= parts
        got, rows = settle(cut)
        taken.append(write_out(got, "taken"))
        rows = write_out(rows, "open")
    every = taken[0]
    for t in taken[1:]:
        every = every.unionByName(t)
    return every.groupBy("th", "crc").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in runs:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            data, runs = batch.column(1)[i].as_py().encode(), merged(batch.column(2)[i].as_py())
            rows.append((len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(data, runs)).hexdigest()))
        n, removed, spans, digest = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], [c.split()[0] for c in RESULT.split(", ")]
        )


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept text. Bytes are cut, so what is left of a split character becomes U+FFFD."""
    for batch in batches:
        texts = [kept_bytes(t.as_py().encode(), merged(r.as_py())).decode("utf-8", "replace") for t, r in zip(batch.column(1), batch.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def with_ranges(docs: DataFrame) -> DataFrame:
    texts = texts_of(docs)
    ranges = write_out(repeated_ranges(texts), "ranges")
    return texts.join(ranges, ["th", "crc"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "ranges")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    A null text is empty. Repeated rows are all kept, and being copies of each other lose all windows. Texts shorter than a
    window lose nothing. No id is joined on, so null and repeated ids do no harm.
    """
    return with_ranges(docs).mapInArrow(result_batches, RESULT)


def kept_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row with repeated bytes removed."""
    return with_ranges(docs).mapInArrow(text_batches, "doc_id bigint, text string")
