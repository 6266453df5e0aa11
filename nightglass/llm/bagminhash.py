"""Near duplicates by BagMinHash: signatures of weighted shingle sets, banding, and a check of the whole multisets.

A text is the multiset of its five-word shingles (a shorter text is one shingle of all its words). The weight axis
of a shingle is cut into [0, 1), [1, 2), [2, 4), [4, 8) ... and each part has its own Poisson process in time, with a rate
proportional to its length. Every point falls on one of SIGNATURE components and at one weight; the first point below the
shingle's weight decides a component. Two texts agree in a component with probability equal to their weighted
Jaccard similarity, and points are drawn only until no later one can matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nightglass.llm.common import write_out

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
SIGNATURE = BANDS * ROWS
# Bands whose buckets meet by stars: the most shared member of a bucket meets all others, this many times.
STAR_BANDS = 4
STAR_ROUNDS = 2
# Bits of the filter that tells open buckets: 2 MB, whatever their number.
OPEN_BITS = 1 << 24
# Texts are compared whole if their signatures agree in this many components: two texts of similarity 0.8 agree in 104
# on average, in fewer than 84 with a chance of 5 in a million.
AGREEING = 84
CHUNK_WORDS = 200_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_number(word: str) -> int:
    """A 64-bit number of a word, the same on every machine (FNV-1a over its UTF-8 bytes)."""
    h = 0xCBF29CE484222325
    for b in word.encode():
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h


class Numbers(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = number = word_number(word)
        return number


def weighted_shingles(texts: list[list[str]], numbers: Numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight) of texts given as words; documents without words have none."""
    sizes = np.array([len(w) for w in texts])
    flat = np.array([numbers[w] for words in texts for w in words], dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if len(flat) == 0:
        return owner, flat, np.zeros(0, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    length = np.minimum(sizes, SHINGLE)[owner]
    first = np.arange(len(flat)) - starts[owner] <= sizes[owner] - length
    at, length = np.flatnonzero(first), length[first]
    with np.errstate(over="ignore"):
        h = mixed(length.astype(np.uint64))
        for j in range(SHINGLE):
            inside = length > j
            h[inside] = mixed(h[inside] * GOLDEN + flat[at[inside] + j])
    doc = owner[at]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))))
    return doc[new], h[new], np.diff(np.append(new, len(h)))


def signatures(n_docs: int, doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """BagMinHash signatures, n_docs x size identities of first points. Documents without shingles stay 0."""
    top = np.full((n_docs, size), np.inf)
    who = np.zeros((n_docs, size), dtype=np.uint64)
    live = np.zeros(n_docs, dtype=bool)
    live[doc] = True
    # One entry per shingle and part of the weight axis that its weight reaches into.
    docs, keys, starts, widths, weights = [], [], [], [], []
    level, low, width = 0, 0, 1
    while len(doc):
        docs.append(doc), starts.append(np.full(len(doc), low)), widths.append(np.full(len(doc), width)), weights.append(weight)
        with np.errstate(over="ignore"):
            keys.append(mixed(shingle + GOLDEN * np.uint64(level + 1)))
        low, level = low + width, level + 1
        width = low
        reach = weight > low
        doc, shingle, weight = doc[reach], shingle[reach], weight[reach]
    if not docs:
        return who
    e_doc, e_key, e_low, e_width, e_weight = (np.concatenate(x) for x in (docs, keys, starts, widths, weights))
    e_rate = size * e_width.astype(float)
    share = (e_weight - e_low) / e_width
    now, drawn = np.zeros(len(e_doc)), np.zeros(len(e_doc), dtype=np.uint64)
    active = np.arange(len(e_doc))
    while len(active):
        n = 1 if len(active) > 4000 else 16
        with np.errstate(over="ignore"):
            step = drawn[active][:, None] + np.arange(1, n + 1, dtype=np.uint64)[None, :]
            r = mixed(e_key[active][:, None] + GOLDEN * step)
            place, level = mixed(r + GOLDEN), mixed(r + GOLDEN * np.uint64(2))
        gap = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) / 2.0**53)
        t = now[active][:, None] + np.cumsum(gap, axis=1) / e_rate[active][:, None]
        part = ((place >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        under = (level >> np.uint64(11)).astype(float) / 2.0**53 < share[active][:, None]
        rows = np.broadcast_to(e_doc[active][:, None], t.shape)
        d, k, when, point = rows[under], part[under], t[under], r[under]
        before = when < top[d, k]
        d, k, when, point = d[before], k[before], when[before], point[before]
        np.minimum.at(top, (d, k), when)
        first = when == top[d, k]
        who[d[first], k[first]] = point[first]
        now[active] = t[:, -1]
        drawn[active] += np.uint64(n)
        latest = top.max(axis=1)
        active = active[now[active] < latest[e_doc[active]]]
    return who


def band_keys(who: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """n_docs x bands keys; equal keys mean equal components of the same band."""
    with np.errstate(over="ignore"):
        grouped = who.reshape(len(who), bands, rows)
        h = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(who), bands)).copy()
        for j in range(rows):
            h = mixed(h * GOLDEN + grouped[:, :, j])
    return h.view(np.int64)


SIGNED = "doc_id bigint, node binary, bands array<bigint>, sketch binary"


def sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for batch in batches:
        ids, nodes, texts = batch.column(0), batch.column(1), batch.column(2)
        at = 0
        while at < batch.num_rows:
            words, held, start = [], 0, at
            while at < batch.num_rows and held < CHUNK_WORDS:
                words.append(words_of(texts[at].as_py()))
                held += len(words[-1])
                at += 1
            who = signatures(len(words), *weighted_shingles(words, numbers))
            keys, sketch = band_keys(who), (who & np.uint64(255)).astype(np.uint8)
            filled = np.array([len(w) > 0 for w in words])
            offsets = np.concatenate(([0], np.cumsum(np.where(filled, BANDS, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[filled].ravel()))
            columns = [ids.slice(start, at - start), nodes.slice(start, at - start), lists, pa.array([row.tobytes() for row in sketch], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "bands", "sketch"])


def likely_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sketches, a byte per component, agree often enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, SIGNATURE) for i in (2, 3))
        near = pa.array((a == b).sum(axis=1) >= AGREEING)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])


TOKENS = "node binary, n int, tokens array<bigint>"


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, tokens) of each text (node, text): its shingles with their occurrences numbered, so that its multiset is a set."""
    numbers = Numbers()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            words, held, start = [], 0, at
            while at < batch.num_rows and held < CHUNK_WORDS:
                words.append(words_of(batch.column(1)[at].as_py()))
                held += len(words[-1])
                at += 1
            doc, shingle, weight = weighted_shingles(words, numbers)
            occurrence = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            with np.errstate(over="ignore"):
                token = mixed(np.repeat(shingle, weight) + GOLDEN * (occurrence + 1).astype(np.uint64))
            size = np.bincount(np.repeat(doc, weight), minlength=len(words))
            offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, at - start), pa.array(size.astype(np.int32)), tokens], ["node", "n", "tokens"])


def similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 0.0


def shingle_counts(text: str) -> Counter:
    words = words_of(text)
    n = min(SHINGLE, len(words))
    return Counter(zip(*(words[i:] for i in range(n)), strict=False)) if n else Counter()


def compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, counts = None, Counter()
    for batch in batches:
        out = []
        for a, b, text_a, text_b in zip(*(batch.column(i) for i in range(4)), strict=True):
            a = a.as_py()
            if a != last:
                last, counts = a, shingle_counts(text_a.as_py())
            out.append(similarity(counts, shingle_counts(text_b.as_py())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "sim"])


def nodes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, node, text): a node is one different text, named by its 128-bit digest."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def connected(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, comp): each node of the edges (a, b), at most `rows` of them, with the least node of its component.

    Large-star and small-star steps in turn, each written out; rounds grow with the logarithm of the longest chain. A hub
    is no group in memory: minima are pre-aggregated, and Spark may split the join on a hub's edges.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = write_out(links, "stars", rows)

    def size(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    state = size(now)
    while True:
        both = now.union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = write_out(small, "stars", rows)
        after = size(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def relabel(comps: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """Labels after joining the components at both ends of each link."""
    a, b = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = connected(edges, rows).select(F.col("node").alias("comp"), F.col("comp").alias("joined"))
    return comps.join(merged, "comp", "left").select("node", F.coalesce("joined", "comp").alias("comp"))


def weighed(buckets: DataFrame) -> DataFrame:
    """The rows (bucket, node, ..) of buckets with two members or more, plus weight, the node's number of mates in all buckets."""
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = write_out(buckets.join(shared, "bucket"), "bucket-members")
    return members.join(members.groupBy("node").agg(F.sum("n").alias("weight")), "node").drop("n")


def links_of(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar: by sketch, then by their whole multisets."""
    side = lambda n, table, what: table.select(F.col("node").alias(n), F.col(what).alias(f"{what}_{n}"))
    sketched = pairs.join(side("b", sketches, "sketch"), "b").join(side("a", sketches, "sketch"), "a").select("a", "b", "sketch_a", "sketch_b")
    likely = write_out(sketched.mapInArrow(likely_batches, "a binary, b binary"), "likely")
    whole = likely.join(side("b", texts, "text"), "b").join(side("a", texts, "text"), "a").select("a", "b", "text_a", "text_b")
    return write_out(whole.mapInArrow(compare_batches, "a binary, b binary, sim double").where(F.col("sim") >= SIMILARITY).select("a", "b"), "links")


def with_links(comps: DataFrame, links: DataFrame) -> DataFrame:
    n = links.count()
    return write_out(relabel(comps, links, n), "labels", comps.count()) if n else comps


def meet_heads(members: DataFrame, comps: DataFrame, sketches: DataFrame, texts: DataFrame, judged: list[DataFrame]) -> DataFrame:
    """Labels after the most shared member of each bucket (bucket, node, weight) that has not led yet met the others, STAR_ROUNDS times.

    A bucket of one component meets no more, so a group of near copies is done with its first head. Pairs judged before, in any
    bucket, are in `judged` and are not judged again.
    """
    state = members.withColumn("led", F.lit(False))
    for _ in range(STAR_ROUNDS):
        n_state = state.count()
        at = write_out(state.join(comps, "node"), "buckets", n_state)
        order = F.struct("weight", F.xxhash64("node"), "node")
        waiting = at.where(~F.col("led")).groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max(order)["node"].alias("head"))
        heads = write_out(waiting.where("low <> high").select("bucket", "head"), "heads", n_state)
        if heads.isEmpty():
            break
        marked = at.join(heads, "bucket")
        named = heads.join(comps.select(F.col("node").alias("head"), F.col("comp").alias("head_comp")), "head").select("bucket", "head_comp")
        met = marked.join(named, "bucket").where(F.col("comp") != F.col("head_comp"))
        pairs = met.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
        for before in judged:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = write_out(pairs, "pairs", n_state)
        judged.append(pairs)
        comps = with_links(comps, links_of(pairs, sketches, texts))
        state = marked.select("bucket", "node", "weight", (F.col("led") | (F.col("node") == F.col("head"))).alias("led"))
    return comps


def open_nodes(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Nodes of buckets that hold several components, and a few more.

    Open buckets set bits of a filter of fixed size, so members are not joined with them: a bucket that holds a third of all
    nodes is one row here. A node of a closed bucket that shares a bit is looked at for nothing.
    """
    ends = members.join(comps, "node").groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    slots = ends.select(F.pmod("bucket", F.lit(OPEN_BITS)).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(slot, 64) as int))")).alias("bits"))
    every = members.sparkSession.range(OPEN_BITS // 64).join(words, "id", "left")
    listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    bits = every.agg(F.transform(listed, lambda w: w["bits"]).alias("words")).scalar()
    slot = F.pmod("bucket", F.lit(OPEN_BITS))
    hit = F.getbit(F.get(bits, F.floor(slot / 64).cast("int")), F.pmod(slot, F.lit(64)).cast("int")) == 1
    return write_out(members.where(hit).select("node").distinct(), "open-nodes")


def prefix_pairs(opened: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts (node, text) in different components that may have a similarity of 0.8, none left out.

    Tokens are ordered from the rarest on. Two texts of n and m tokens with that similarity share at least k = ceil(4 (n + m) / 9), so behind the first
    token they share, it included, both hold k tokens or more; it lies among the first n - ceil(0.8 n) + 1 of each. Only
    these tokens are joined, those of a single text take places but meet none. Texts that share much, but each with a
    fifth of its own, do not meet.
    """
    tokens = write_out(opened.mapInArrow(token_batches, TOKENS).withColumn("id", F.xxhash64("node")), "open-tokens")
    each = tokens.select("id", F.explode("tokens").alias("token"))
    counts = write_out(each.groupBy("token").agg(F.count("*").alias("df"), F.min("id").alias("id")), "token-counts")
    alone = counts.where("df = 1").groupBy("id").agg(F.count("*").alias("alone"))
    listed = each.join(counts.where("df > 1").select("token", "df"), "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    known = tokens.select("id", "node", "n").join(listed, "id").join(alone, "id", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).join(comps, "node")
    places = F.greatest(F.expr("n - (4 * n + 4) div 5 + 1 - alone").cast("int"), F.lit(0))
    first = known.select("node", "comp", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), places)).alias("i", "s"))
    rows = write_out(first.select("node", "comp", "n", (F.col("alone") + F.col("i")).alias("pos"), F.col("s.token").alias("token")), "prefixes")
    other = rows.select("token", *[F.col(c).alias(f"{c}_2") for c in ("node", "comp", "n", "pos")])
    least = F.expr("(4 * (n + n_2) + 8) div 9")
    near = (F.col("comp") != F.col("comp_2")) & (F.col("n") - F.col("pos") >= least) & (F.col("n_2") - F.col("pos_2") >= least) & (F.col("node") < F.col("node_2"))
    met = rows.join(other, (rows["token"] == other["token"]) & near)
    return met.select(F.col("node").alias("a"), F.col("node_2").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, comp) per row of docs; comp names the class of texts linked by similarities of 0.8 or more.

    Equal texts are one node. Texts without words (null and empty ones too) link to none but their equals.
    """
    rows = nodes_of(docs)
    signed = write_out(rows.select("doc_id", "node", "text").mapInArrow(sign_batches, SIGNED), "signatures")
    # A key is mixed with its band already, so it names the bucket.
    bands = signed.groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.posexplode("bands").alias("band", "bucket"))
    members = write_out(weighed(bands), "members")
    nodes = members.select("node").distinct()
    distinct = rows.groupBy("node").agg(F.first("text").alias("text"))
    texts = write_out(distinct.join(nodes, "node", "left_semi"), "candidate-texts")
    sketches = write_out(signed.groupBy("node").agg(F.first("sketch").alias("sketch")).join(nodes, "node", "left_semi"), "sketches")
    comps = write_out(nodes.select("node", F.col("node").alias("comp")), "labels")
    judged: list[DataFrame] = []
    comps = meet_heads(members.where(F.col("band") < STAR_BANDS).drop("band"), comps, sketches, texts, judged)
    # Whatever shares a bucket of any band with another component is compared through its rarest shingles.
    opened = texts.join(open_nodes(members, comps), "node", "left_semi").select("node", "text")
    pairs = prefix_pairs(opened, comps)
    for before in judged:
        pairs = pairs.join(before, ["a", "b"], "left_anti")
    comps = with_links(comps, links_of(write_out(pairs, "pairs"), sketches, texts))
    found = signed.select("doc_id", "node").join(comps, "node", "left")
    return found.select("doc_id", "node", F.coalesce("comp", "node").alias("comp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_rows, class_texts) per row of docs; class_id is the least doc_id of the class.

    A class whose ids are all null has a null class_id. Repeated rows are all kept.
    """
    rows = write_out(classes(docs), "classes")
    per_text = rows.groupBy("comp", "node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    sizes = per_text.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_rows"), F.count("*").alias("class_texts"))
    return rows.join(sizes, "comp").select("doc_id", "class_id", "class_rows", "class_texts")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class with all its columns: the one with the least doc_id, nulls last, then the least text digest."""
    rows = write_out(classes(docs), "classes")
    least = rows.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("k"))
    keepers = write_out(least.select(F.col("k.doc_id").alias("_id"), F.col("k.node").alias("_node")), "keepers")
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    marked = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"))
    kept = marked.join(keepers, marked["doc_id"].eqNullSafe(keepers["_id"]) & (marked["node"] == keepers["_node"]), "left_semi")
    repeats = rows.groupBy("doc_id", "node").agg(F.count("*").alias("n")).where("n > 1")
    if not repeats.isEmpty():
        kept = kept.groupBy("doc_id", "node").agg(F.first("row").alias("row"))
    return kept.select("row.*")
