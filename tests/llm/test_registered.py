"""The registered queries over the smallest tables: against their SQL, or else against brute force."""

import collections
import re

import pytest

import corpus_pipeline
from compare import compare, connect
from nightglass.llm import quality
from nightglass.llm.common import table
from nightglass.llm.queries import ORACLE, QUERIES

from .test_corpus_operators import check_shards, plain_classes, plain_repeats
from .test_row_operators import KINDS, SECRETS, ascii_lower, plain_spans, sha

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def rows(spark):
    return sorted((r.doc_id, r.text or "", r.source) for r in table(spark, FOLDER, "documents").collect())


@pytest.fixture(scope="module")
def texts(rows):
    return [r[:2] for r in rows]


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLE[name]) == ""


@pytest.mark.parametrize("name, kinds", [("op4_pii", KINDS), ("op9_secrets", SECRETS)])
def test_spans(spark, texts, name, kinds):
    got = {r.doc_id: r for r in QUERIES[name](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        spans, counts = plain_spans(kinds, t)
        assert [got[i][f"n_{k}"] for k in kinds] == counts and got[i].base_sha256 == sha(spans)
        listed = set(got[i].spans.split(",")) - {""}
        assert set(spans.split(",")) - {""} <= listed


def test_repeated_strings(spark, texts):
    assert sorted(map(tuple, QUERIES["op6_suffix"](spark, FOLDER).collect())) == sorted(plain_repeats(texts))


def test_near_duplicates(spark, texts):
    group = plain_classes(texts)
    least = {g: min(i for (i, _), h in zip(texts, group, strict=True) if h == g) for g in group}
    got = {r.doc_id: r.class_id for r in QUERIES["op10_bagminhash"](spark, FOLDER).collect()}
    assert got == {i: least[g] for (i, _), g in zip(texts, group, strict=True)}


def test_sharding(spark, texts):
    check_shards(QUERIES["op3_sharding"](spark, FOLDER).collect(), texts, 16)


def test_mixing(spark, rows):
    got = QUERIES["op5_mixing"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted((i, s) for i, _, s in rows)
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_licences(spark, texts):
    notices = {
        "apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    }
    want = {i: ",".join(sorted(f for f, n in notices.items() if n in t)) for i, t in texts}
    got = {r.doc_id: r.families for r in QUERIES["op1_license"](spark, FOLDER).collect()}
    right = sum(got[i] == f for i, f in want.items())
    assert len(got) == len(want) and right >= 0.98 * len(want)


def test_pipeline(spark, texts):
    mask = quality.mask_of(quality.POLICIES[quality.CURRENT])

    def bits(t):
        n, chars, symbols, lines, dup, repeat, stutter = quality.measure(t)
        fails = (n < 10, 100 * repeat > 20 * n, 10 * symbols > n, 100 * dup > 40 * lines, 100 * stutter > 25 * n, chars > 25 * n)
        return sum(1 << i for i, f in enumerate(fails) if f)

    good = [(i, t) for i, t in texts if bits(t) & mask == 0]
    group = plain_classes(good)
    first = [row for k, row in enumerate(good) if row[0] == min(i for (i, _), g in zip(good, group, strict=True) if g == group[k])]
    grams = set()
    for r in table(spark, FOLDER, "benchmark").collect():
        w = WORD.findall(ascii_lower(r.text or ""))
        grams |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    clean = []
    for i, t in first:
        w = WORD.findall(ascii_lower(t))
        hit = {k for n in {len(g) for g in grams} for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in grams for k in range(a, a + n)}
        if 20 * len(hit) < len(w) or not hit:
            clean.append((i, t))
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == [i for i, _ in clean]
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(16)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_stages_keep_the_columns_and_bear_odd_rows(spark, docs, no_docs):
    names = docs.columns
    for given in (docs, no_docs):
        kept = given
        for stage, (_, function) in enumerate(corpus_pipeline.STAGES):
            kept = function(spark, kept, FOLDER)
            if stage < len(corpus_pipeline.STAGES) - 1:
                assert kept.columns == names
        assert {"doc_id", "text", "shard", "slot"} <= set(kept.columns)
        assert (kept.count() > 0) == (given is docs)
