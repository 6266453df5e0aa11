"""Hard negatives for anchors: rows of other labels that score close below an anchor's positives.

Scores are integer inner products. Anchors are dealt to trees of at most TREE; in each tree a minimum spanning tree of their
distances is rooted at the most central one. Cauchy-Schwarz bounds the score of a row c with a child anchor by its score with the parent:
|<c, child> - <c, parent>| <= |c| * |child - parent|. Rows whose bounds miss what is asked for are not scored again; their
bounds widen by one edge more further down. What is asked for is a window of scores: at least the fifth best sure score for
positives, the range below each positive for negatives.

The anchors are a stated query set that meets all rows, in blocks: rows and anchors are dealt to blocks of bounded size, and every
pair of blocks is one group. A block of rows is sent once for ANCHORS anchors. Each group returns its best few rows per
question, which are merged by a ranking that Spark cuts before the shuffle; nothing is gathered per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from nightglass.llm.common import ranked, write_out

POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
TREE = 256
ANCHORS = 1 << 14
ROWS = 1 << 15
SCALE = 256
# The widest whole numbers that sums of doubles hold exactly.
EXACT = 1 << 53


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, with components in whole steps of 1 / SCALE as doubles."""
    vec = F.transform(F.col(vector), lambda x: F.floor(SCALE * x.cast("double")).cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    taken = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, bad)
    return rows.where(taken).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    flat, sizes = np.asarray(column.flatten(), dtype=np.float64), np.asarray(column.value_lengths(), dtype=np.int64)
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1) if sizes[0] else np.zeros((len(sizes), 1))
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): points in an order in which parents come first, each one's parent (the root its own) and distance."""
    squares = (points**2).sum(axis=1)
    far = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * points @ points.T, 0.0))
    root = int(far.sum(axis=1).argmin())
    parent, order, near, waiting = np.full(len(points), root), [root], far[root].copy(), np.ones(len(points), dtype=bool)
    waiting[root] = False
    for _ in range(len(points) - 1):
        nxt = int(np.where(waiting, near, np.inf).argmin())
        order.append(nxt)
        waiting[nxt] = False
        closer = waiting & (far[nxt] < near)
        near[closer], parent[closer] = far[nxt][closer], nxt
    # Distances of the edges by direct subtraction, which does not lose digits.
    return np.array(order), parent, np.sqrt(((points - points[parent]) ** 2).sum(axis=1))


TREES = "slab bigint, tree bigint, step int, parent int, edge double, vec_id bigint, label bigint, vec array<double>"


def tree_table(table: pa.Table) -> pa.Table:
    """The anchors of one tree in an order in which each comes after its parent; `parent` is the parent's step."""
    table = table.combine_chunks()
    order, parent, edge = spanning_tree(matrix(table["vec"].combine_chunks()))
    step = np.empty(len(order), dtype=np.int32)
    step[order] = np.arange(len(order))
    rows = table.take(pa.array(order))
    columns = {"slab": rows["slab"], "tree": rows["tree"], "step": np.arange(len(order), dtype=np.int32), "parent": step[parent[order]], "edge": edge[order]}
    return pa.table(columns | {n: rows[n] for n in ("vec_id", "label", "vec")})


def anchor_trees(anchors: DataFrame) -> DataFrame:
    """The different anchors, dealt to trees of TREE by label and id, and trees to slabs of ANCHORS."""
    distinct = anchors.distinct()
    block = F.struct("label", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("h"))
    numbered = ranked(distinct, [], block, [F.col("vec_id"), F.col("vec")], "rank")
    dealt = numbered.select(F.expr(f"rank div {ANCHORS}").alias("slab"), F.expr(f"rank div {TREE}").alias("tree"), "vec_id", "label", "vec")
    return write_out(dealt.groupBy("tree").applyInArrow(tree_table, TREES), "anchor-trees")


@dataclass
class Rows:
    ids: np.ndarray
    labels: np.ndarray
    vecs: np.ndarray
    norms: np.ndarray
    widest: float

    def scores(self, anchor: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact scores of some rows; sums that doubles may round are worked out in whole numbers."""
        vecs = self.vecs if len(which) == len(self.ids) else self.vecs[which]
        if np.abs(anchor).max() * self.widest * len(anchor) >= EXACT:
            whole = [int(x) for x in anchor]
            return np.array([sum(int(x) * y for x, y in zip(v, whole, strict=True)) for v in vecs], dtype=object)
        return vecs @ anchor


def best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties by smaller id."""
    if len(scores) > 4 * n and scores.dtype != object:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        return some[np.lexsort((ids[some], -scores[some]))[:n]]
    return np.array(sorted(range(len(scores)), key=lambda k: (-scores[k], ids[k]))[:n], dtype=np.int64)


def nth_highest(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def walk(rows: Rows, tree: dict[str, np.ndarray], ask) -> Iterator[tuple]:
    """Goes down a tree, with bounds of each row's score at each anchor. `ask(k, low, high)` names the rows that anchor k needs
    to know, and takes their exact scores when sent them; what it gives back is passed on."""
    n, kept = len(rows.ids), {}
    children = np.bincount(tree["parent"][1:], minlength=len(tree["step"]))
    for k in range(len(tree["step"])):
        parent = int(tree["parent"][k])
        if k == 0:
            low, high, need = np.full(n, -np.inf), np.full(n, np.inf), np.ones(n, dtype=bool)
        else:
            # A little more than the bound, for the rounding of distances, norms and wide scores.
            reach, (low, high) = tree["edge"][k] * rows.norms * (1 + 1e-9) + 1e-6, kept[parent]
            low, high = low - reach - 1e-12 * np.abs(low), high + reach + 1e-12 * np.abs(high)
            children[parent] -= 1
            if children[parent] == 0:
                del kept[parent]
            need = ask(k, low, high)
        which = np.flatnonzero(need)
        scores = rows.scores(tree["vec"][k], which)
        if children[k]:
            low[which], high[which] = scores, scores
            kept[k] = (low, high)
        yield k, which, scores


GROUPED = "anchor bigint, anchor_id bigint, positive_id bigint, positive_score bigint, other_id bigint, score bigint"


def positives_in(rows: Rows, tree: dict[str, np.ndarray]) -> Iterator[tuple]:
    def ask(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        own = (rows.labels == tree["label"][k]) & (rows.ids != tree["vec_id"][k])
        return own & (high >= nth_highest(low[own], POSITIVES))

    for k, which, scores in walk(rows, tree, ask):
        own = (rows.labels[which] == tree["label"][k]) & (rows.ids[which] != tree["vec_id"][k])
        which, scores = which[own], scores[own]
        for j in best(rows.ids[which], scores, POSITIVES):
            yield tree["anchor"][k], tree["vec_id"][k], None, None, rows.ids[which[j]], int(scores[j])


def windows_of(positives: list[dict]) -> list[tuple[int, int, int, int]]:
    """(positive id, its score, least and greatest score of a negative), for windows that hold a whole number."""
    made = ((p["positive_id"], p["positive_score"], -(-LOW * p["positive_score"] // 100), HIGH * p["positive_score"] // 100) for p in positives)
    return [w for w in made if w[2] <= w[3]]


def negatives_in(rows: Rows, tree: dict[str, np.ndarray]) -> Iterator[tuple]:
    def ask(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other, need = rows.labels != tree["label"][k], np.zeros(len(rows.ids), dtype=bool)
        for _, _, least, most in windows_of(tree["positives"][k]):
            sure = nth_highest(low[other & (low >= least) & (high <= most)], NEGATIVES)
            need |= other & (high >= max(least, sure)) & (low <= most)
        return need

    for k, which, scores in walk(rows, tree, ask):
        other = rows.labels[which] != tree["label"][k]
        which, scores = which[other], scores[other]
        for positive, positive_score, least, most in windows_of(tree["positives"][k]):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            for j in best(rows.ids[which[inside]], scores[inside], NEGATIVES):
                yield tree["anchor"][k], tree["vec_id"][k], positive, positive_score, rows.ids[which[inside[j]]], int(scores[inside[j]])


def in_blocks(what):
    """A function over one block of rows and one slab of anchor trees."""

    def made(rows_table: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows_table.num_rows and anchors.num_rows:
            vecs, others = matrix(rows_table["vec"].combine_chunks()), matrix(anchors["vec"].combine_chunks())
            width = max(vecs.shape[1], others.shape[1])
            vecs, others = padded(vecs, width), padded(others, width)
            rows = Rows(np.asarray(rows_table["vec_id"]), np.asarray(rows_table["label"]), vecs, np.sqrt((vecs**2).sum(axis=1)), np.abs(vecs).max())
            named = {n: np.asarray(anchors[n]) for n in ("tree", "step", "parent", "edge", "vec_id", "label")}
            named |= {"vec": others, "anchor": named["tree"] * TREE + named["step"]}
            named["positives"] = np.empty(anchors.num_rows, dtype=object)
            if "positives" in anchors.column_names:
                for i, known in enumerate(anchors["positives"].to_pylist()):
                    named["positives"][i] = known
            order = np.lexsort((named["step"], named["tree"]))
            named = {n: v[order] for n, v in named.items()}
            cuts = np.flatnonzero(np.diff(named["tree"])) + 1
            for part in np.split(np.arange(len(order)), cuts):
                found.extend(what(rows, {n: v[part] for n, v in named.items()}))
        columns = list(zip(*found, strict=True)) if found else [[]] * 6
        return pa.Table.from_arrays([pa.array([None if x is None else int(x) for x in c], pa.int64()) for c in columns], [c.split()[0] for c in GROUPED.split(", ")])

    return made


def first_rows(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The n best rows of each question, numbered by `rank` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, vec) of whole numbers.

    An anchor's positives are its POSITIVES best rows of its label; for each of them the first NEGATIVES rows of other labels
    whose score lies in the positive's window are returned, fewer if there are no more. Higher scores come first, ties by smaller id.

    Rows that share an anchor's id are no partners of it. Repeated rows each take a place, but a repeated positive gives its rows once, and so
    does a repeated anchor; anchors that share an id only give rows each. Shorter vectors are filled up with zeros. A
    score beyond 64 bits is an error. Without usable rows or anchors the result is empty.
    """
    spark = rows.sparkSession
    trees = anchor_trees(rows.where(is_anchor))
    n, slabs = rows.count(), trees.agg(F.max("slab")).first()[0]
    if slabs is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    groups = max(-(-n // ROWS), min(spark.sparkContext.defaultParallelism, -(-n // TREE)))
    # The hash covers the whole row, so that rows that share an id are dealt apart.
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(groups))).withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs)).cast("array<bigint>")))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>"))
    met = lambda anchors, what: dealt.groupBy("group", "slab").cogroup(anchors.withColumn("group", every).groupBy("group", "slab")).applyInArrow(in_blocks(what), GROUPED)
    own = ["anchor", "anchor_id"]
    best_own = first_rows(met(trees, positives_in), own, POSITIVES)
    asked = best_own.groupBy(*own).agg(F.collect_set(F.struct(F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))).alias("positives"))
    # A parent without positives still bounds its children.
    known = write_out(trees.withColumn("anchor", F.col("tree") * TREE + F.col("step")).join(asked.drop("anchor_id"), "anchor", "left").drop("anchor").withColumn("positives", F.coalesce("positives", F.array().cast(asked.schema["positives"].dataType))), "anchor-positives")
    best_other = first_rows(met(known, negatives_in), [*own, "positive_id", "positive_score"], NEGATIVES)
    return best_other.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
