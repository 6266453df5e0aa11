"""Operators that compare documents with each other, against brute force over the same rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from nightglass.llm import bagminhash, license, mixing, sharding, suffix

from .conftest import ROWS, passage


def plain_repeats(texts):
    data = [t.encode() for _, t in texts]
    counts = collections.Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for (i, _), d in zip(texts, data, strict=True):
        gone = bytearray(len(d))
        for a in range(len(d) - 199):
            if counts[d[a : a + 200]] > 1:
                gone[a : a + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_repeated_strings(docs, texts, no_docs):
    assert sorted(map(key, suffix.remove_repeats(docs).collect())) == sorted(map(key, plain_repeats(texts)))
    assert suffix.remove_repeats(no_docs).collect() == []


def test_repeated_strings_at_every_offset(spark, monkeypatch):
    shared = passage(50, 40)
    rows = [(i, passage(60 + i, 30)[: 150 + i] + shared[i : i + 190 + i] + passage(90 + i, 25)) for i in range(14)]
    rows += [(20, "ab" * 400), (21, "x" + "ab" * 120), (22, shared[:199]), (23, shared[:200]), (24, "ü" * 120 + shared), (25, passage(61, 30))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, suffix.remove_repeats(df).collect())) == sorted(plain_repeats(rows))


def test_long_texts_come_in_parts(monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 500)
    texts = [passage(1, 300).encode(), b"short", passage(2, 20).encode(), passage(3, 100).encode()]
    seen = collections.Counter()
    for data, ends, owner, offset in suffix.pieces(texts):
        _, at, first, last = suffix.sampled(np.frombuffer(data, np.uint8), ends)
        part = np.searchsorted(ends, at, side="right")
        shift = offset - np.concatenate(([0], ends[:-1]))
        for a, f, e, p in zip(at, first, last, part, strict=True):
            assert f <= e <= f + suffix.SPAN - 1 and 0 <= a - e and a - f < suffix.SPAN
            seen.update((owner[p], w + shift[p]) for w in range(f, e + 1))
    assert seen == collections.Counter((i, w) for i, t in enumerate(texts) for w in range(len(t) - 199))


def plain_classes(texts):
    counts = [bagminhash.shingle_counts(t) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if texts[i][1] == texts[j][1] or bagminhash.similarity(counts[i], counts[j]) >= 0.8:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def test_near_duplicates(docs, texts, no_docs):
    group = plain_classes(texts)
    least = {g: min((i for (i, _), h in zip(texts, group, strict=True) if h == g and i is not None), default=None) for g in group}
    want = [(i, least[g], group.count(g)) for (i, _), g in zip(texts, group, strict=True)]
    rows = bagminhash.near_duplicates(docs)
    assert sorted(map(key, rows.select("doc_id", "class_id", "class_rows").collect())) == sorted(map(key, want))
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert {r.doc_id for r in kept.collect()} == set(least.values())
    assert bagminhash.near_duplicates(no_docs).collect() == []


def test_chains_and_hard_buckets(spark):
    """A chain whose ends differ, and two clusters that share buckets without being near."""
    words = passage(5, 120).split()
    chain = []
    for i in range(12):
        chain.append(" ".join(words[: 100] if i == 0 else [*words[i * 2 : 100 + i * 2]]))
    base = passage(6, 200).split()
    other = base[:150] + passage(7, 50).split()
    rows = [(i, t) for i, t in enumerate(chain)]
    for i in range(15):
        for j, b in enumerate((base, other)):
            w = list(b)
            w[i * 9] = f"edit{i}{j}"
            rows.append((100 + 100 * j + i, " ".join(w)))
    want = plain_classes(rows)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    least = {g: min(i for (i, _), h in zip(rows, want, strict=True) if h == g) for g in want}
    assert got == {i: least[g] for (i, _), g in zip(rows, want, strict=True)}


def test_signatures_estimate_weighted_similarity():
    rng, numbers, errors = np.random.default_rng(3), bagminhash.Numbers(), []
    for trial in range(150):
        a, b = rng.integers(1, 40, 2)
        unit = [f"u{trial}_{i}" for i in range(25)]
        x, y = unit * int(a), unit * int(b) + [f"v{trial}_{i}" for i in range(30)]
        s = bagminhash.signatures(2, *bagminhash.weighted_shingles([x, y], numbers))
        exact = bagminhash.similarity(bagminhash.shingle_counts(" ".join(x)), bagminhash.shingle_counts(" ".join(y)))
        errors.append((s[0] == s[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


def test_components(spark):
    edges = [(b"a%03d" % i, b"a%03d" % (i + 1)) for i in range(60)] + [(b"z", b"y"), (b"h", b"i"), (b"i", b"h")]
    got = {bytes(r.node): bytes(r.comp) for r in bagminhash.connected(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {got[b"a%03d" % i] for i in range(61)} == {b"a000"} and got[b"z"] == b"y" and got[b"i"] == b"h" and len(got) == 65


def check_shards(rows, texts, shards):
    assert len(rows) == len(texts)
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    want = [(i, len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for i, t in texts]
    assert sorted(key((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard)) for r in rows) == sorted(map(key, want))


def test_sharding(spark, docs, texts, no_docs):
    check_shards(sharding.assign(docs).collect(), texts, 16)
    assert sharding.assign(no_docs).collect() == []


def test_sharding_keeps_groups_together(spark):
    rows = [(i, f"copy {i // 4}" if i < 400 else f"single {i}") for i in range(1600)] + [(2000 + i, "hot") for i in range(500)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check_shards(got, rows, 16)
    text, where = dict(rows), collections.defaultdict(set)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
    cut = sum(len(where[f"copy {g}"]) > 1 for g in range(100))
    hot = collections.Counter(r.shard for r in got if text[r.doc_id] == "hot")
    assert cut <= 2 and sum(n for _, n in hot.most_common(6)) >= 450


def test_groups_that_fit_stand_in_one_shard(spark):
    rows = [(i, f"copy {i % 5}" if i < 250 else f"single {i}") for i in range(1000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check_shards(got, rows, 16)
    text, where = dict(rows), collections.defaultdict(set)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
    assert [len(where[f"copy {g}"]) for g in range(5)] == [1] * 5


def test_slots_follow_the_files_of_the_mix(spark, tmp_path):
    """What the mixing stage wrote decides the slots: each shard's rows stand in its order, and in another order without it."""
    rows = [(i, f"text {i}" if i % 7 else "copy", "x" if i % 3 else "y", i) for i in range(900)] + [(None, None, None, 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, slot int")
    mixed_path, plain_path = str(tmp_path / "mixed"), str(tmp_path / "plain")
    mixing.mixed(docs).write.parquet(mixed_path)
    docs.write.parquet(plain_path)
    slots = []
    for path in (mixed_path, plain_path):
        read = spark.read.parquet(path)
        order = {(r.f, r.n): k for k, r in enumerate(read.selectExpr("_metadata.file_path AS f", "_metadata.row_index AS n").orderBy("f", "n").collect())}
        place = collections.defaultdict(list)
        for r in read.selectExpr("doc_id", "text", "_metadata.file_path AS f", "_metadata.row_index AS n").collect():
            place[r.doc_id, r.text].append(order[r.f, r.n])
        got = sharding.sharded(read, 4).collect()
        assert collections.Counter((r.doc_id, r.text, r.source) for r in got) == collections.Counter(r[:3] for r in rows)
        for shard in range(4):
            mine = sorted((r.slot, r.doc_id, r.text) for r in got if r.shard == shard and r.doc_id is not None)
            assert [place[i, t][0] for _, i, t in mine] == sorted(place[i, t][0] for _, i, t in mine)
        assert sorted(r.slot for r in got if r.shard == 0) == list(range(sum(r.shard == 0 for r in got)))
        slots.append({r.doc_id: r.slot for r in got if r.doc_id is not None})
    assert sum(slots[0][i] != slots[1][i] for i in slots[0]) > 800


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.01, 100), min_size=1, max_size=12), st.integers(64, 300))
def test_pfair_order_stays_within_a_block(weights, period):
    slots = mixing.shares({f"s{i}": w for i, w in enumerate(weights)}, period)
    assert sum(slots.values()) == period and min(slots.values()) >= 1
    done = collections.Counter()
    for n, (source, j, slot, release, deadline) in enumerate(mixing.one_period(slots, period), 1):
        assert slot == n - 1 and release <= slot < deadline and done[source] == j
        done[source] += 1
        for s, a in slots.items():
            assert abs(done[s] - n * a / period) < 1


def test_mixing(spark, docs, no_docs):
    rows = mixing.schedule(docs, block=2).collect()
    assert sorted(key((r.doc_id, r.source)) for r in rows) == sorted(key((i, s)) for i, _, _, s in ROWS)
    blocks = collections.defaultdict(set)
    for r in rows:
        assert r.release <= r.slot < r.deadline
        blocks[r.slot].add((r.source, r.block))
    assert all(len(b) == 1 for b in blocks.values())
    out = mixing.mixed(docs, {"a": 3.0, "b": 1.0})
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert mixing.schedule(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_rows_without_ids_are_spread_and_weights_are_positive(spark):
    df = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('t', id) AS text", "'s' AS source")
    places = mixing.schedule(df, keep=[F.col("text")]).collect()
    assert sorted((r.slot, r.place) for r in places) == [(i // mixing.BLOCK, i % mixing.BLOCK) for i in range(4000)]
    with pytest.raises(ValueError, match="weights must be positive"):
        mixing.schedule(df, {"s": 0})


def test_mixing_follows_given_weights(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 10 < 7 THEN 'x' WHEN id % 10 < 9 THEN 'y' END AS source")
    rows = sorted(((r.slot, r.place, r.source) for r in mixing.schedule(df, {"x": 1.0, "y": 2.0, None: 1.0}, block=4).collect()), key=lambda r: r[:2])
    head = collections.Counter(s for slot, _, s in rows if slot < 200)
    assert abs(head["y"] - 400) <= 4 and abs(head["x"] - 200) <= 4 and abs(head[None] - 200) <= 4


def test_licences(spark, docs, no_docs):
    c = license.train(spark, docs)
    rows = {r.doc_id: r for r in license.scan(docs, c).collect()}
    assert len(license.scan(docs, c).collect()) == len(ROWS)
    assert rows[13].families == "apache" and rows[13].n_confirmed == 1 and rows[13].probability >= license.THRESHOLDS[0]
    assert all(r.families == "" for i, r in rows.items() if i != 13) and rows[5].n_units == 0
    held = [
        ("apache", "All sources here are Licensed under the Apache License, Version 2.0 (see NOTICE)"),
        ("mit", "The tool was released under the MIT License in spring."),
        ("gpl", "This work is licensed under the GNU General Public License, version 3 or newer"),
        ("cc-by-nc", "Photos: licensed under CC BY-NC 4.0"),
        ("bsd", "Redistribution and use in source and binary forms, with or without changes, are permitted"),
        ("", "The general public may use this work under version 3 of the plan."),
        ("", "Licensed under the house rules of the hotel"),
        ("", "He was released in the spring under the old oak"),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(held)], "doc_id bigint, text string")
    got = {r.doc_id: r.families for r in license.scan(df, c).collect()}
    assert sum(got[i] == f for i, (f, _) in enumerate(held)) >= 7
    assert license.scan(no_docs, c).collect() == []


HEADERS = {
    "gpl": """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * You should have received a copy of the GNU General Public License along
 * with this program; if not, write to the Free Software Foundation, Inc.,
 */""",
    "lgpl": """// This library is free software; you can redistribute it and/or modify it
// under the terms of the GNU Lesser General Public License as published by
// the Free Software Foundation; either version 2.1 of the License.
//
// You should have received a copy of the GNU Lesser General Public
// License along with this library.""",
    "mit": """# Permission is hereby granted, free of charge, to any person obtaining
# a copy of this software and associated documentation files (the "Software"),
# to deal in the Software without restriction.
#
# The above copyright notice and this permission notice shall be included in
# all copies or substantial portions of the Software.""",
    "bsd": """;; Redistribution and use in source and binary forms, with or without
;; modification, are permitted provided that the following conditions are met:
;;
;; Redistributions of source code must retain the above copyright notice,
;; this list of conditions and the following disclaimer.""",
    "apache": """<!-- Licensed under the Apache License, Version 2.0 (the "License");
  you may not use this file except in compliance with the License.
  You may obtain a copy of the License at

      http://www.apache.org/licenses/LICENSE-2.0 -->""",
}


def test_wrapped_headers(spark, docs):
    """Notices as they stand in source files, wrapped and behind comment marks; between prose; and inside one very long paragraph."""
    c = license.train(spark, docs)
    prose = " ".join(f"word{i} of the old river" for i in range(2000))
    rows = [(i, text) for i, text in enumerate(HEADERS.values())]
    rows += [(10 + i, f"{passage(i, 40)}\n\n{text}\n\n{passage(50 + i, 40)}") for i, text in enumerate(HEADERS.values())]
    rows += [(20 + i, f"{prose}\n{text}\n{prose}") for i, text in enumerate(HEADERS.values())]
    rows += [(90, prose), (91, "The license of the driver and the permission of the version"), (92, "a copy of the terms was granted\n\nfree of charge to any person"), (93, None), (94, "")]
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), c).collect()}
    assert len(got) == len(rows)
    for start in (0, 10, 20):
        assert [got[start + i].families for i in range(len(HEADERS))] == list(HEADERS)
    assert all(got[i].families == "" and got[i].n_confirmed == 0 for i in range(90, 95))
    assert (got[90].n_units, got[93].n_units, got[94].n_units, got[10].n_units) == (1, 0, 0, 4)


def test_units_without_anchors_could_not_be_confirmed():
    for template in (t for ts in license.TEMPLATES.values() for t in ts):
        pairs, anchors = license.plain_pairs(template), license.anchor_words(template)
        without = [p for p in pairs if not set(p.split()) & set(anchors)]
        assert len(without) < license.CONFIRMED * len(pairs)


def test_every_window_is_scored(spark, docs):
    """Windows cover all words of all paragraphs, and the model judges those without a template's words too."""
    prose = " ".join(f"river{i}" for i in range(150))
    frame = license.keyed_texts(spark.createDataFrame([(1, f"{prose}\n\nshort one"), (2, "Released under the MIT License"), (3, ""), (4, None)], "doc_id bigint, text string"))
    blocks = frame.select("doc_id", "key", F.posexplode(license.paragraphs_of(F.col("text"))).alias("pos", "block"))
    units = license.units_of(blocks, "block").select("doc_id", "key", "pos", "words")
    windows = collections.defaultdict(set)
    for r in units.collect():
        windows[r.doc_id, r.pos].update(r.words)
    assert windows == {(1, 0): set(prose.split()), (1, 1): {"short", "one"}, (2, 0): {"released", "under", "the", "mit", "license"}}
    scored = license.scored_units(units, license.train(spark, docs)).collect()
    assert len(scored) == units.count() == 7 and {r.explained for r in scored if r.doc_id == 1} == {0.0}


def test_scores_by_hand(spark, docs):
    """Calibrated probability, family and template share of every unit, from the model's coefficients in plain Python."""
    c = license.train(spark, docs)
    texts = [(i, t) for i, t in enumerate(HEADERS.values())]
    frame = license.keyed_texts(spark.createDataFrame(texts, "doc_id bigint, text string"))
    blocks = frame.select("doc_id", "key", F.posexplode(license.paragraphs_of(F.col("text"))).alias("pos", "block"))
    units = license.units_of(blocks, "block").select("doc_id", "key", "pos", "words")
    weights, bias = c.model.coefficientMatrix.toArray(), c.model.interceptVector.toArray()
    features = {(r.doc_id, r.pos, tuple(r.words)): r.features for r in license.with_features(units).collect()}
    want = set()
    for (i, pos, words), v in features.items():
        raw = weights @ v.toArray() + bias
        p = np.exp((raw - raw.max()) / c.temperature)
        k = int(raw[1:].argmax()) + 1
        held = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
        shares = [len(held & set(license.plain_pairs(t))) / len(license.plain_pairs(t)) for t in license.TEMPLATES[license.FAMILIES[k]]]
        want.add((i, pos, license.FAMILIES[k], round(float(p[k] / p.sum()), 9), round(max(shares), 9)))
    got = {(r.doc_id, r.pos, r.family, round(r.probability, 9), round(r.share, 9)) for r in license.scored_units(units, c).collect()}
    assert got == want and len(got) >= 8


@pytest.mark.parametrize("weights", [{"a": 1.0, "b": 1.0, "c": 1.0}, {"a": 0.7, "b": 0.29985, "c": 0.00015}])
def test_pfair_order_keeps_to_the_given_weights(weights):
    """Over a run of many thousand slots, no source strays a block from its weight as given."""
    total, done = sum(weights.values()), collections.Counter()
    blocks = {s: int(100_000 * w / total) for s, w in weights.items()}
    for source, j, slot, release, deadline in mixing.pfair(weights, blocks):
        assert release <= slot < deadline and done[source] == j
        done[source] += 1
        if slot % 97 == 0 and slot < 99_000:
            assert all(abs(done[s] - (slot + 1) * w / total) < 1 for s, w in weights.items())
    assert done == blocks


def test_mixing_keeps_to_the_given_weights_over_many_blocks(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "'t' AS text", "element_at(array('x', 'y', 'z'), int(id % 3) + 1) AS source")
    order = sorted((r.slot, r.source) for r in mixing.schedule(df, {"x": 1.0, "y": 1.0, "z": 1.0}, block=1).collect())
    done = collections.Counter()
    for n, (slot, source) in enumerate(order, 1):
        done[source] += 1
        assert slot == n - 1 and all(abs(done[s] - n / 3) < 1 for s in "xyz")


@pytest.mark.parametrize("weights", [None, {"x": 1.0, "y": 2.0, None: 1.0}])
def test_slots_of_every_shard_hold_the_mix(spark, weights):
    """Any first slots of a shard hold each source to within a block of its weight, until one runs out there."""
    source = lambda i: "x" if i % 10 < 7 else "y" if i % 10 < 9 else None
    rows = [(i, "copy" if i % 9 == 0 else f"text {i}", source(i)) for i in range(12_000)] + [(5, "twin", "x"), (5, "twin", "y"), (5, "twin", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sharding.sharded(df, 4, weights).collect()
    assert sorted(key((r.doc_id, r.text, r.source)) for r in got) == sorted(map(key, rows))
    sizes = collections.Counter(s for _, _, s in rows)
    target = weights or {s: n**mixing.TEMPERATURE for s, n in sizes.items()}
    share = {s: w / sum(target.values()) for s, w in target.items()}
    for shard in range(4):
        order = [s for _, s in sorted((r.slot, r.source) for r in got if r.shard == shard)]
        left, done = collections.Counter(order), collections.Counter()
        for n, s in enumerate(order, 1):
            left[s] -= 1
            done[s] += 1
            # The last block of a source may be a part of one.
            if min(left.values()) < mixing.BLOCK:
                break
            assert all(abs(done[x] - n * share[x]) < 2 * mixing.BLOCK for x in share)
        assert n > 400


def test_rare_shingles_lose_no_pair(spark):
    """Every pair of similarity 0.8 or more is met through its rarest shingles, at the border too, with repeated shingles and sizes apart."""
    base = [f"b{i}" for i in range(104)]
    texts = [base, base[:84], base[:83], base[20:], ["new"] + base[1:], base[:50] + ["mid"] + base[51:], base + [f"c{i}" for i in range(25)], base + [f"d{i}" for i in range(26)]]
    texts += [["r"] * k for k in (5, 6, 8, 9, 20, 24)] + [base[:10] + ["q"] * 40, base[:10] + ["q"] * 47, base[:10] + ["q"] * 52]
    texts += [base[: 104 - 2 * k] + [f"e{k}y{i}" for i in range(2 * k)] for k in range(1, 14)]
    rows = [" ".join(t) for t in texts]
    counts = [bagminhash.shingle_counts(t) for t in rows]
    want = {(i, j) for i in range(len(rows)) for j in range(i) if bagminhash.similarity(counts[i], counts[j]) >= 0.8}
    nodes = bagminhash.nodes_of(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))
    number = {bytes(r.node): r.doc_id for r in nodes.collect()}
    pairs = bagminhash.prefix_pairs(nodes.select("node", "text"), nodes.select("node", F.col("node").alias("comp"))).collect()
    got = {tuple(sorted((number[bytes(r.a)], number[bytes(r.b)]), reverse=True)) for r in pairs}
    assert want <= got and len(want) > 40


def test_texts_that_share_the_common_stuff_only_never_meet(spark):
    """A thousand texts that share two thirds of their shingles make no pairs; a near copy of one of them meets that one."""
    common = " ".join(f"c{i}" for i in range(80))
    rows = [f"{common} " + " ".join(f"o{k}z{i}" for i in range(40)) for k in range(1000)]
    rows.append(rows[500] + " end")
    nodes = bagminhash.nodes_of(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))
    number = {bytes(r.node): r.doc_id for r in nodes.collect()}
    pairs = bagminhash.prefix_pairs(nodes.select("node", "text"), nodes.select("node", F.col("node").alias("comp"))).collect()
    assert [{number[bytes(r.a)], number[bytes(r.b)]} for r in pairs] == [{500, 1000}]


def test_recall_of_planted_pairs(spark):
    """Pairs a little over 0.8, each in a group of its own: at least 99 in 100 share a class."""
    rows = []
    for k in range(300):
        words = passage(1000 + k, 124).split()
        copy = words[:]
        for at in (11, 47, *[(), (123,), (122,)][k % 3]):
            copy[at] = f"x{k}y{at}"
        if bagminhash.similarity(bagminhash.shingle_counts(" ".join(words)), bagminhash.shingle_counts(" ".join(copy))) >= 0.8:
            rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    found = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    planted = [i for i, _ in rows if i % 2]
    assert len(planted) >= 200 and sum(found[i] == i - 1 for i in planted) >= 0.99 * len(planted)


def test_licence_units_are_cut_and_paired_once(spark, docs):
    """Windows take their pairs from their paragraph's, and counted units stand for paragraphs."""
    frame = license.keyed_texts(docs)
    blocks = frame.select("doc_id", "key", F.posexplode(license.paragraphs_of(F.col("text"))).alias("pos", "block"))
    units = license.units_of(blocks, "block").collect()
    assert len(units) > len({(u.doc_id, u.key, u.pos) for u in units}) > 5
    for u in units:
        assert u.word_pairs == [f"{a} {b}" for a, b in zip(u.words, u.words[1:], strict=False)]
    want = sorted(((r.doc_id, r.n) for r in frame.select("doc_id", F.size(license.paragraphs_of(F.col("text"))).cast("long").alias("n")).collect()), key=repr)
    assert sorted(((r.doc_id, r.n_units) for r in license.scan(docs, license.train(spark, docs)).collect()), key=repr) == want


def test_licence_paragraphs_of_odd_lines(spark):
    """Only white space and comment marks at the ends of lines go, whatever ends the line."""
    pieces = ["word", " ", "  ", "\t", "\r", "\n", "\r\n", "\u0085", "\u2028", "*/", "**", "-->", "-", "#}", "#", "/", "é"]
    dice = random.Random(5)
    texts = ["".join(dice.choice(pieces) for _ in range(n % 14)) for n in range(3000)]
    after = r"(?m)[ \t]*(?:\*+/|--+>|#\}|\*+)?[ \t\r]*$"
    bare = F.regexp_replace(F.regexp_replace("text", license.MARK_BEFORE, ""), after, "")
    plain = F.filter(F.transform(F.split(bare, r"\n(?:[ \t\r]*\n)+"), lambda b: F.regexp_replace(b, r"\s+", " ")), lambda b: b.rlike(r"[\p{L}\p{N}]"))
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r for r in frame.select("text", plain.alias("want"), license.paragraphs_of(F.col("text")).alias("got")).collect() if r.want != r.got] == []


def test_licence_strides_are_hashed_once(spark, docs):
    """Windows scored from the strides that they share are those scored each by itself, whatever their number; few grams are hashed twice."""
    c = license.train(spark, docs)
    notice = HEADERS["gpl"]
    lengths = [0, 1, 2, *(28 * k + d for k in range(1, 12) for d in (-1, 0, 1)), 400]
    texts = [(i, passage(i, n)) for i, n in enumerate(lengths)] + [(100, f"{passage(1, 90)}\n{notice}\n{passage(2, 170)}"), (101, "the " * 300), (102, None), (None, passage(3, 130)), (None, passage(3, 130))]
    frame = license.keyed_texts(spark.createDataFrame(texts, "doc_id bigint, text string"))
    blocks = frame.select("doc_id", "key", F.posexplode(license.paragraphs_of(F.col("text"))).alias("pos", "block"))
    units = license.units_of(blocks, "block").select("doc_id", "key", "pos", "words", "word_pairs")
    rows = lambda df: sorted(((r.doc_id, r.key, r.pos, r.family, round(r.probability, 9), round(r.explained, 9), round(r.share, 9)) for r in df.collect()), key=repr)
    got = rows(license.scored_windows(blocks, "block", c))
    assert got == rows(license.scored_units(units, c)) and len(got) == units.count() > 150
    assert any(r[0] == 100 and r[3] == "gpl" and r[6] >= license.CONFIRMED for r in got)
    parts, uses = license.parts_of(blocks, "block")
    grams = parts.select(F.sum(sum(F.size(p) for p in {p for use in uses for p in use})).alias("n")).first().n
    alone = units.select(F.sum(F.size("words") + F.size("word_pairs")).alias("n")).first().n
    assert grams < 0.75 * alone
