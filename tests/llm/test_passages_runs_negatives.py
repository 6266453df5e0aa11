"""Hard negatives, passages that occur earlier, and periodic runs, against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from nightglass.llm import negatives, periodic, subtrees
from nightglass.llm.common import table
from nightglass.llm.queries import QUERIES

from .conftest import passage

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return tuple((x is None, x) for x in row)


# Passages that start earlier.


def plain_passages(rows):
    """(doc_id, n_words, n_removed, kept) of each (doc_id, text); rows that share both are one document."""
    seen, found = set(), {}
    for row in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1] or "", seed=42)).view(np.int64))):
        words = SPLIT.findall(row[1] or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        found[row] = (row[0], len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return [found[row] for row in rows]


def kept_rows(spark, rows, limit=None):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = subtrees.remove_passages(df, limit).collect()
    for r in got:
        assert r.n_words >= sum(s.end - s.start for s in r.spans) and all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in got), key=key)


def test_words_are_cut_at_six_blanks_alone():
    """Bytes are cut where the contract's words end: not at other white space, control characters or parts of a character."""
    text = "a\tb\nc\x0bd\x0ce\rf  g\x1ch\x1fi\x85j\xa0k\u2003l\u3000m\u0085n\x00o é\u2028ü "
    want = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    assert subtrees.words_of(text.encode()) == want and len(want) == 8
    assert subtrees.words_of(None) == subtrees.words_of(b" \n") == []


@pytest.mark.parametrize("limit", [None, 4])
def test_passages(spark, docs, no_docs, limit):
    rows = [(r.doc_id, None if r.text is None else r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, t or "") for i, t in rows]
    assert kept_rows(spark, rows, limit) == sorted(plain_passages(rows), key=key)
    assert subtrees.remove_passages(docs).count() == docs.count()
    assert subtrees.remove_passages(no_docs).collect() == []


@pytest.mark.parametrize("limit", [None, 2, 30])
def test_passages_at_every_offset(spark, limit):
    """Windows shared at all offsets, within a text, in periodic texts, over odd blanks; groups split at every depth."""
    shared = passage(50, 60)
    rows = [(i, f"{passage(60 + i, 7 + i)} {' '.join(shared.split()[: 17 + i])}\t{passage(90 + i, 9)}") for i in range(9)]
    rows += [(20, "ab " * 90), (21, "x " + "ab cd " * 20), (22, f"{shared}\n{shared}"), (23, shared), (24, shared.upper()), (25, passage(61, 30)), (26, " \v\f "), (27, "a\x1fb " + shared)]
    rows += [(30 + i, " ".join(shared.split()[i : i + 25])) for i in range(20)]
    assert kept_rows(spark, rows, limit) == sorted(plain_passages(rows), key=key)


def test_groups_split_by_longer_prefixes(spark):
    """No group is over the limit but those of one whole window, and no suffix is lost."""
    blocks = [F.floor(F.sqrt(F.col("id") % (4 + 9 * k))).cast("long") for k in range(4)]
    two = lambda a, b: F.shiftleft(a, 32).bitwiseOR(b)
    place = [F.lit(False).alias("none"), F.col("id").alias("first_id"), F.lit(0).cast("long").alias("th"), F.lit(0).alias("start")]
    suffixes = spark.range(4000).select(two(*blocks[:2]).alias("high"), two(*blocks[2:]).alias("low"), *place)
    done, rest = subtrees.grouped(suffixes, 50)
    assert done.groupBy("level", "cell").count().agg(F.max("count")).first()[0] <= 50
    assert done.select("level").distinct().count() > 1
    assert done.count() + rest.count() == 4000
    assert rest.groupBy(*subtrees.WHOLE).count().agg(F.min("count")).first()[0] > 50


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=70), max_size=5))
def test_marks_cover_every_window_once(texts):
    numbers = subtrees.Numbers()
    for first, flat, ends in subtrees.chunks([[str(x) for x in t] for t in texts], numbers):
        gram, at, low, high = subtrees.marks(flat, ends)
        starts = np.concatenate(([0], ends[:-1]))
        windows = [w for a, b in zip(starts, ends, strict=True) for w in range(a, b - 19)]
        assert [w for a, b in zip(low, high, strict=True) for w in range(a, b + 1)] == windows
        assert first == 0 and ((high <= at) & (at < low + subtrees.SPAN)).all() and len(gram) == len(at)


# Periodic runs.


def plain_runs(s):
    out = set()
    for q in range(1, len(s) // 4 + 1):
        x = 0
        while x + q < len(s):
            end = x
            while end + q < len(s) and s[end] == s[end + q]:
                end += 1
            n = end - x + q
            if end > x and n >= max(6, 4 * q) and not any(s[x : x + n - r] == s[x + r : x + n] for r in range(1, q)):
                out.add((x, n, q))
            x = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text, planted=True):
    words = SPLIT.findall(text or "")
    order = periodic.planted(doc_id, len(words)) if planted else None
    words = words if order is None else [words[k] for k in order]
    runs = plain_runs(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *longest, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


periodic_text = st.builds(lambda a, b, times, c: a + b * times + b[: len(b) // 2] + c, *[st.lists(st.integers(1, 3), max_size=12)] * 2, st.integers(0, 9), st.lists(st.integers(1, 30), max_size=20))


@settings(max_examples=150, deadline=None)
@given(st.lists(periodic_text, max_size=5))
def test_runs(texts):
    got = periodic.runs_of([np.array(t, dtype=np.int64) for t in texts])
    assert [[tuple(r) for r in runs.tolist()] for runs in got] == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=200), st.data())
def test_common_extensions(s, data):
    """The sorted sample and its range minima give the extension of any two positions."""
    closed = np.array([*s, 4], dtype=np.int64)
    pairs = data.draw(st.lists(st.tuples(*[st.integers(0, len(s) - 1)] * 2).filter(lambda p: p[0] != p[1]), min_size=1, max_size=30))
    i, j = (np.array(x) for x in zip(*pairs, strict=True))
    plain = [next(k for k in range(len(closed)) if max(a, b) + k >= len(closed) or closed[a + k] != closed[b + k]) for a, b in pairs]
    assert periodic.Extensions(closed).common(i, j).tolist() == plain


def test_long_text_with_one_period():
    s = np.array([1, 2, 3, 4, 5] * 30_000 + [9] + list(range(10, 5000)), dtype=np.int64)
    assert [r.tolist() for r in periodic.runs_of([s])] == [[[0, 150_000, 5]]]


def test_periodic_query_on_odd_rows(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = periodic.run_digest(periodic.find_runs(docs, periodic.planted)).collect()
    assert sorted(map(key, map(tuple, got))) == sorted(key(plain_report(*r)) for r in rows)
    assert periodic.find_runs(no_docs).collect() == []
    plain = periodic.run_digest(periodic.find_runs(docs)).collect()
    assert sorted(map(key, map(tuple, plain))) == sorted(key(plain_report(*r, planted=False)) for r in rows)


def test_periodic_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    # Brute force is quadratic: the longest texts are left to the tests above.
    short = {i for i, t in rows if len(t or "") < 6000}
    assert len(short) > 150 and any(periodic.planted(i, 50) is not None for i in short)
    got = [tuple(r) for r in QUERIES["op13_periodic"](spark, FOLDER).collect()]
    assert len(got) == len(rows)
    assert sorted((r for r in got if r[0] in short), key=key) == sorted((plain_report(i, t) for i, t in rows if i in short), key=key)


# Hard negatives.


def plain_negatives(rows, is_anchor):
    ok = [(i, m, [math.floor(256 * x) for x in v]) for i, m, v in rows if i is not None and m is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, m, v in ok:
        if not is_anchor(i):
            continue
        own = sorted((-score(v, w), j) for j, n, w in ok if n == m and j != i)[:5]
        other = sorted((-score(v, w), j) for j, n, w in ok if n != m and j != i)
        for p, j in own:
            fit = [(s, k) for s, k in other if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out |= {(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(fit, 1)}
    return sorted(out)


def mined(spark, rows, every):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, vec array<float>").withColumn("group", F.lit("x")).repartition(3)
    return sorted(map(tuple, negatives.mine(negatives.usable(df, "vec"), F.col("vec_id") % every == 0).collect()))


def vectors(n, labels, width, seed, spread=1.0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(3 * labels)]
    rows = []
    for i in range(n):
        c = rnd.randrange(3 * labels)
        rows.append((i, c % labels, [float(np.float32(x + spread * rnd.gauss(0, 1))) for x in centres[c]]))
    return rows


@pytest.mark.parametrize("spread, width", [(1.0, 8), (0.05, 3), (0.0, 2)])
def test_negatives(spark, monkeypatch, spread, width):
    """Small trees, slabs and blocks; tight clusters, where bounds leave rows out; and nothing but ties."""
    monkeypatch.setattr(negatives, "TREE", 7)
    monkeypatch.setattr(negatives, "ANCHORS", 21)
    monkeypatch.setattr(negatives, "ROWS", 60)
    rows = vectors(300, 4, width, 5, spread)
    assert mined(spark, rows, 5) == plain_negatives(rows, lambda i: i % 5 == 0)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 3, 4, 9) + [(None, 1, [1.0, 2.0, 3.0, 4.0]), (200, None, [1.0, 0.0, 0.0, 0.0]), (201, 1, None), (202, 1, [1.0, nan, 0.0, 0.0]), (203, 1, [inf, 1.0, 0.0, 0.0]), (204, 2, [None, 1.0, 0.0, 0.0])]
    rows += [(205, 1, []), (206, 2, [3.0, 1.0]), (207, 0, [1e6, -1e6, 1e6, 3e5]), (208, 2, [1e6, -1e6, 9e5, 3e5]), (210, 0, [9e6, -1e6, 1e6, 3e5]), (300, 7, [0.0, 0.0, 0.0, 0.0]), (310, 7, [0.0, 0.0, 0.0, 0.0])]
    assert mined(spark, rows, 10) == plain_negatives(rows, lambda i: i % 10 == 0)
    # A repeated anchor gives its rows once.
    anchor = next(r for r in rows if r[0] == 10)
    assert mined(spark, [*rows, anchor], 10) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert mined(spark, [], 10) == [] and mined(spark, [(1, 1, [1.0])], 10) == []


def test_bounds_hold_and_leave_rows_out():
    rows = vectors(400, 2, 6, 3, 0.02)
    vecs = np.floor(256 * np.array([v for _, _, v in rows]))
    of = negatives.Rows(np.arange(400), np.array([m for _, m, _ in rows]), vecs, np.sqrt((vecs**2).sum(axis=1)), np.abs(vecs).max())
    order, parent, edge = negatives.spanning_tree(vecs[:60])
    step = np.empty(60, dtype=int)
    step[order] = np.arange(60)
    tree = {"step": np.arange(60), "parent": step[parent[order]], "edge": edge[order], "vec": vecs[:60][order]}
    assert (tree["parent"][1:] < tree["step"][1:]).all()

    def ask(k, low, high):
        exact = vecs @ tree["vec"][k]
        assert (low <= exact).all() and (exact <= high).all()
        return high >= negatives.nth_highest(low, 5)

    scored = [len(which) for _, which, _ in negatives.walk(of, tree, ask)]
    assert scored[0] == 400 and sum(scored[1:]) < 59 * 400 / 2
