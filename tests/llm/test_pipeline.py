"""The pipeline's stages against brute force over their own input."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayline.llm import queries, quality_rules, secrets, shingle_groups, tokens
from tests.conftest import SMALL_TABLES
from tests.llm.test_operators import best_windows, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id int, kept int, root string"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL_TABLES}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL_TABLES}/benchmark.parquet").collect()]
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)

    good = steps["quality_rules"](spark, docs, SMALL_TABLES)
    judge = quality_rules.fit(docs, spark.read.parquet(f"{SMALL_TABLES}/labels.parquet"))
    wanted = {r.doc_id for r in quality_rules.judged(docs, judge).filter("kept").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == wanted

    rows = [(r.doc_id, r.text) for r in good.collect()]
    single = steps["simhash_near_dedup"](spark, good, SMALL_TABLES)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == first_of_groups(rows)

    rows = [(r.doc_id, r.text) for r in single.collect()]
    clean = steps["benchmark_decontamination"](spark, single, SMALL_TABLES)
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in best_windows(rows, items)}

    masked = steps["secret_scan"](spark, clean, SMALL_TABLES)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert masked.columns == columns
    for row in masked.collect():
        assert row.text == secrets.masked(texts[row.doc_id]) and row.n_chars == len(row.text)

    packed = steps["packing"](spark, masked, SMALL_TABLES).collect()
    total = sum(len(tokens.text_ids(queries.TOKENIZER, r.text)) // 4 + 1 for r in masked.collect())
    assert sum(r.length for r in packed) == total
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL_TABLES).collect())) == sorted(map(tuple, packed))


def test_awkward_rows_pass_every_stage(spark):
    text = spark.read.parquet(f"{SMALL_TABLES}/documents.parquet").orderBy("doc_id").first().text
    rows = [(None, text), (1, text), (1, text), (2, None), (3, ""), (3, text + " and more"), (None, None)]
    rows = [(*r, "en", None, None, 1, 2, "r") for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    single = corpus_pipeline.near_dedup_stage(spark, frame, SMALL_TABLES)
    assert single.columns == frame.columns
    assert sorted(r.doc_id for r in single.collect()) == [1, 2]
    clashing = frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("_own0", "__own1", "_kept0", "_leak_id"))])
    several = clashing.unionByName(clashing.withColumn("lang", F.lit("de"))).unionByName(clashing.withColumn("lang", F.lit(None)))
    single = corpus_pipeline.near_dedup_stage(spark, several, SMALL_TABLES)
    assert single.columns == several.columns
    assert sorted((r.doc_id, r.lang) for r in single.collect()) == [(1, None), (2, None)]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), SMALL_TABLES).count() == 0
        assert stage(spark, frame, SMALL_TABLES).columns


def plain_shingles(text):
    own = words((text or "").lower())
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def first_of_groups(rows, similarity=0.8):
    """The least doc_id of each group of chained pairs."""
    sets = [plain_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j, other in enumerate(sets[:i]):
            if one == other or len(one & other) >= similarity * len(one | other):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(least.values())


def edited_texts():
    """Texts with edited copies whose similarity lies on both sides of 0.8, and chains of them."""
    chance = random.Random(11)
    rows = []
    for length in (6, 30, 60, 120, 400):
        for _ in range(6):
            text = [f"w{chance.randrange(3000)}" for _ in range(length)]
            rows.append(" ".join(text))
            for share in (0.01, 0.015, 0.02, 0.025, 0.03):
                text = list(text) if chance.random() < 0.3 else rows[-1].split()
                for _ in range(max(1, round(share * length))):
                    text[chance.randrange(length)] = f"z{chance.randrange(3000)}"
                rows.append(" ".join(text))
    rows += ["", " \n", "one two", "One  TWO", "one two three"]
    return list(enumerate(rows))


@pytest.mark.parametrize("block,bound", [(shingle_groups.BLOCK, shingle_groups.BROADCAST_ROWS), (3, 0)])
def test_near_dedup_stage_equals_brute_force_similarity(spark, monkeypatch, block, bound):
    rows = edited_texts()
    monkeypatch.setattr(shingle_groups.groups, "__defaults__", (5, 0.8, block, bound))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.near_dedup_stage(spark, frame, SMALL_TABLES)
    assert sorted(r.doc_id for r in found.collect()) == first_of_groups(rows)


def test_wide_fingerprints_are_majorities_of_mixed_hashes():
    full, chance = (1 << 64) - 1, random.Random(3)
    for count in (1, 4, 5, 254, 300, 2100):
        shingles = [chance.getrandbits(64) for _ in range(count)]
        found = shingle_groups.wide_fingerprint(np.array(shingles, np.uint64), 3)
        for word in range(3):
            ones = [0] * 64
            for x in shingles:
                x = (x + (word + 1) * 0x9E3779B97F4A7C15) & full
                x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & full
                x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & full
                x ^= x >> 31
                ones = [n + (x >> i & 1) for i, n in enumerate(ones)]
            assert int(found[word]) == sum(1 << i for i, n in enumerate(ones) if 2 * n > count)


def connected(nodes, pairs):
    """The least node of each node's cluster."""
    root = {n: n for n in nodes}
    for _ in nodes:
        former = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == former:
            break
    return root


@pytest.mark.parametrize("block", [shingle_groups.BLOCK, 3])
def test_near_dedup_stage_proposes_by_simhash(spark, monkeypatch, block):
    texts = [text for _, text in edited_texts()]
    own = texts[-10].split()
    for i in range(60):  # a large group of near copies
        texts.append(" ".join([*own[:i], "edited", *own[i + 1 :]]))
    sets = {shingle_groups.node_of(s): s for s in map(shingle_groups.shingle_set, texts) if len(s)}
    width, segments = shingle_groups.segmenting(len(texts))
    prints = {n: shingle_groups.wide_fingerprint(s, 9) for n, s in sets.items()}
    keys = {n: shingle_groups.segment_keys(p[None], width, segments)[0] for n, p in prints.items()}
    wanted = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if sum((int(x) ^ int(y)).bit_count() for x, y in zip(prints[a][:4], prints[b][:4])) <= shingle_groups.RADIUS
        and (keys[a] == keys[b]).any()
    ]
    frame = spark.createDataFrame([(n, bytearray(p.tobytes())) for n, p in prints.items()], "node long, print binary")
    found = [tuple(r) for r in shingle_groups._proposed(frame, width, segments, block, 0).collect()]
    assert connected(prints, found) == connected(prints, wanted)
    assert len(found) < len(wanted) / 2 and len(found) <= 3 * len(prints)

    # The stage links nothing that was not proposed.
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(shingle_groups, "_proposed", lambda *_: none)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    single = corpus_pipeline.near_dedup_stage(spark, frame, SMALL_TABLES)
    assert single.count() == len({frozenset(plain_shingles(t)) for t in texts})
