"""Lexical search, Merkle manifest and exact dedup against brute force: nulls, empty and long texts, ties, repeats,
clashing columns, empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import op11_lexical, op12_merkle, op13_exact

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _terms(text):
    return TERM.findall((text or "").translate(UPPER))


# ---------------------------------------------------------------- lexical search

def _ranking(docs, items, top):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        if item is not None:
            asked[item] |= set(_terms(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def _lexical():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)] + ["É", "naïve", "日本", "a1", "A1", "it's"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 40)))) for i in range(400)]
    docs += [(i, docs[3][1]) for i in range(400, 440)]  # ties
    docs += [(500, None), (501, ""), (502, "-- !!"), (5, docs[5][1]), (None, docs[6][1]), (503, "w1 rare " * 40_000)]
    items = [(k, " ".join(rng.sample(words, rng.randint(1, 12)))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "unseen term"), (None, "w1"), (3, "w7 w8"), (23, "RARE w1 w1")]
    return docs, items


@pytest.mark.parametrize("top", [5, 1000])
@pytest.mark.parametrize("shard, wave", [(1 << 20, 1 << 18), (300, 10)])
def test_ranking_equals_brute_force(spark, top, shard, wave, monkeypatch):
    monkeypatch.setattr(op11_lexical, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(op11_lexical, "WAVE_TERMS", wave)
    docs, items = _lexical()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"terms": F.lit(1), "id": F.lit("x"), "score": F.lit(2)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = sorted(map(tuple, op11_lexical.search(frame, asked, top).collect()))
    # A repeated document takes a rank for each of its rows.
    assert got == _ranking(docs, items, top)


def test_range_maxima_bound_and_find_every_range():
    rng = np.random.default_rng(3)
    owner = np.concatenate([np.sort(rng.choice(50, n, replace=False)) for n in (1, 7, 50)])
    terms, counts = np.repeat([0, 1, 2], [1, 7, 50]), rng.integers(1, 9, 58)
    shard = op11_lexical.Shard(np.arange(50), rng.integers(1, 99, 50), owner, terms, counts, np.array([5, 7, 3]), 50, 2000)
    for low in range(58):
        for high in range(low, 59):
            value, at = shard.largest(np.array([low]), np.array([high]))
            if high == low:
                assert value[0] == 0
            elif np.searchsorted(shard.ends, low, "right") == np.searchsorted(shard.ends, high - 1, "right"):
                assert value[0] == shard.impacts[low:high].max() == shard.impacts[at[0]] and low <= at[0] < high


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert op11_lexical.search(docs, items).count() == 0
    assert op11_lexical.search(items.withColumnRenamed("item_id", "doc_id"), items.where("false")).count() == 0


# ---------------------------------------------------------------- Merkle manifest

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _proofs(rows):
    """Per row (doc_id, leaf, subroot, root, proof, folded root, verified), by building every run."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = [_h(*map(field, r)) for r in rows]
    fold, proof, sub = {}, defaultdict(list), {}
    for i, r in enumerate(rows):
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
        fold[i] = _h(*map(field, (*r[:4], r[4].translate(UPPER)))) if tampered else leaf[i]

    def tree(nodes):
        while len(nodes) > 1:
            above = []
            for at in range(0, len(nodes), 16):
                run = nodes[at:at + 16]
                for j, (_, members) in enumerate(run):
                    left, right = [d for d, _ in run[:j]], [d for d, _ in run[j + 1:]]
                    for i in members:
                        proof[i] += left + right
                        fold[i] = _h(*left, fold[i], *right)
                above.append((_h(*[d for d, _ in run]), [i for _, members in run for i in members]))
            nodes = above
        return nodes[0]

    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[1]].append(i)
    tops = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        ordered = sorted(groups[source], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        tops.append(tree([(leaf[i], [i]) for i in ordered]))
        for i in ordered:
            sub[i] = tops[-1][0]
    root = tree(tops)[0]
    return sorted(((r[0], leaf[i], sub[i], root, _h(*proof[i]), fold[i], fold[i] == root) for i, r in enumerate(rows)), key=str)


def _documents(sizes):
    rng, rows, at = random.Random(6), [], 0
    for source, n in sizes:
        for _ in range(n):
            text = rng.choice([None, "", "Ä Bc", "abc", "Long É " * rng.choice([1, 30_000])]) if n < 50 else f"T{at}"
            rows.append((at if rng.random() < 0.97 else None, source, rng.choice(["en", None]), rng.choice([5, None]), text))
            at += 1
        rows.append(rows[-1])  # a repeated row
    return rows


@pytest.mark.parametrize("sizes", [
    [("one", 1)], [(None, 16)], [("a", 300), (None, 3), ("é", 1), ("B", 17), ("", 2)], [(f"s{k}", 1 + k % 3) for k in range(40)]])
def test_proofs_equal_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(op12_merkle, "BLOCK", 64)
    rows = _documents(sizes)
    if sizes == [("one", 1)]:
        rows = rows[:1]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(3)
    frame = frame.withColumns({"level": F.lit(1), "digest": F.lit("x"), "block": F.lit(2), "number": F.lit(3)})
    got = op12_merkle.verify(frame, op12_merkle.every_fifth())
    assert sorted(map(tuple, got.collect()), key=str) == _proofs(rows)


def test_manifest_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string")
    assert op12_merkle.verify(none, op12_merkle.every_fifth()).count() == 0


# ---------------------------------------------------------------- exact dedup

@pytest.mark.parametrize("smallest", [True, False])
@pytest.mark.parametrize("partitions", [1, 23])
def test_equal_texts_keep_one_row(spark, smallest, partitions):
    rng = random.Random(9)
    texts = ["hot"] * 300 + [None, "", None] + [f"t{rng.randint(0, 80)}" for _ in range(300)] + ["x" * 3_000_000] * 2
    rows = [(rng.choice([i, i, i, None]) if i % 50 == 0 else i, t) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (None, "only null"), (None, "only null")]
    rng.shuffle(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions).withColumns(
        {"run": F.lit("a"), "digest": F.lit(1), "n": F.lit(2), "kept": F.lit(3)})
    got = op13_exact.exact_duplicates(frame, smallest=smallest).collect()
    assert len(got) == len(rows)
    best = min if smallest else max
    hashes = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = hashes[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == best((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    assert op13_exact.exact_duplicates(frame.where("false")).count() == 0


def test_normalised_texts_and_other_columns(spark):
    frame = spark.createDataFrame([("b", "X  y"), ("a", "x Y"), ("c", "z")], "key string, body string")
    got = op13_exact.exact_duplicates(frame, "key", "body", F.lower(F.regexp_replace("body", r"\s+", " ")))
    assert sorted((r.key, r.keep_id, r.group_size, r.kept) for r in got.collect()) == [
        ("a", "a", 2, True), ("b", "a", 2, False), ("c", "c", 1, True)]
