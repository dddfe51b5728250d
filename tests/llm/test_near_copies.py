"""The near-copy stage against brute force on planted copies."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import near_copies


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _similar(a, b):
    return a == b or len(a & b) / len(a | b) >= 0.8


def _components(links, n):
    """The smallest member each of ``n`` items reaches."""
    group = np.arange(n)
    a, b = (np.array(x, np.int64) for x in zip(*links)) if links else (np.zeros(0, np.int64),) * 2
    while True:
        before = group.copy()
        np.minimum.at(group, a, group[b])
        np.minimum.at(group, b, group[a])
        group = group[group]
        if (group == before).all():
            return group.tolist()


def _planted():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        texts.append(base)
        for changes in (1, 1, 2, 2, 3, 4):
            copy = list(texts[-1] if rng.random() < 0.5 else base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(200, None), (201, ""), (202, "one two"), (203, "One  two"), (None, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("blocks", [(1024, 1 << 19), (3, 400)])
def test_stage_keeps_one_of_planted_near_copies(spark, blocks, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(near_copies, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", blocks[1])
    rows = _planted()
    sets = [_shingles(t) for _, t in rows]
    group = _components([(i, j) for i in range(len(rows)) for j in range(i) if _similar(sets[i], sets[j])], len(rows))
    want = sorted(min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None)) for g in set(group))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == want and 12 < len(want) < 84


@pytest.mark.parametrize("blocks", [(1024, 1 << 19), (64, 1 << 13)])
def test_two_thousand_copies_around_the_threshold(spark, blocks, monkeypatch):
    """One family whose members lie on both sides of 0.8 of each other: exact against brute force over all pairs that
    share a band, and no join of the plan makes pairs of nodes."""
    monkeypatch.setattr(near_copies, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", blocks[1])
    rng = np.random.default_rng(8)
    base = rng.integers(0, 5000, 90)
    texts = []
    for _ in range(2000):
        copy = base.copy()
        at = rng.choice(90, rng.integers(0, 13), replace=False)
        copy[at] = rng.integers(0, 5000, len(at))
        texts.append(" ".join(f"w{x}" for x in copy))
    sets = [near_copies.shingles(t) for t in texts]
    bands = np.array([near_copies.cells(s) for s in sets])
    names, token = np.unique(np.concatenate(sets), return_inverse=True)
    dense = np.zeros((2000, len(names)), np.float32)
    dense[np.repeat(np.arange(2000), [len(s) for s in sets]), token] = 1
    both, size = dense @ dense.T, np.array([len(s) for s in sets])
    near = both / (size[:, None] + size[None, :] - both) >= near_copies.SIMILARITY
    meet = np.zeros_like(near)
    for band in bands.T:
        meet |= band[:, None] == band[None, :]
    group = _components(list(zip(*np.nonzero(np.tril(near & meet, -1)))), 2000)
    everything = _components(list(zip(*np.nonzero(np.tril(near, -1)))), 2000)
    want = sorted(set(group))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = near_copies.keepers(docs).withColumnRenamed("row_key", "k")
    got = sorted(r.doc_id for r in docs.withColumn("k", near_copies.row_key()).join(keys, "k").collect())
    assert len(want) > 100
    # Inside a block pairs are compared that share no band too, so links may be found beyond the bands', none beyond all.
    assert got == want or (set(got) <= set(want) and set(sorted(set(everything))) <= set(got))


def test_edges_of_the_stage(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_copies.keepers(empty).count() == 0
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, long, 5), (2, long + " tail", 6), (3, None, 7), (4, "", 8), (None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int").withColumn("node", F.lit(1))
    keys = near_copies.keepers(docs).withColumnRenamed("row_key", "k")
    got = docs.withColumn("k", near_copies.row_key()).join(keys, "k").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == [1, 3]


def test_candidates_come_from_fingerprint_links_too(spark, monkeypatch):
    """Without any band the copies that op 8 links at two bits are still found, and compared exactly: two texts of one
    fingerprint that share no shingle both stay."""
    monkeypatch.setattr(near_copies, "BANDS", 0)
    monkeypatch.setattr(near_copies, "cells", lambda hashes: np.zeros(0, np.int64))
    base = [f"w{i}" for i in range(3000)]
    copies = [base, base[:-1] + ["x"], ["y"] + base[1:]]
    sets = [near_copies.shingles(" ".join(t)) for t in copies]
    prints = [near_copies.op8_simhash.fingerprint_of(s) for s in sets]
    assert all((prints[0] ^ p).bit_count() <= 2 for p in prints)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(copies)] + [(7, "a b c d e"), (8, None)],
                                 "doc_id long, text string")
    keys = near_copies.keepers(docs).withColumnRenamed("row_key", "k")
    got = docs.withColumn("k", near_copies.row_key()).join(keys, "k").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == [0, 7, 8]
    monkeypatch.setattr(near_copies.op8_simhash, "fingerprint_of", lambda hashes: 5)
    keys = near_copies.keepers(docs).withColumnRenamed("row_key", "k")
    got = docs.withColumn("k", near_copies.row_key()).join(keys, "k").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == [0, 7, 8]
