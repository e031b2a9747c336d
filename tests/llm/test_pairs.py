"""Substring removal, n-gram join and embedding links against plain Python."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import catalog, common, embedding_dedup, ngram_join, substring_dedup
from roadpulse.llm.common import components

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def passages(seed):
    rng = random.Random(seed)
    shared = [[f"p{a}_{i}" for i in range(rng.randint(30, 80))] for a in range(8)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [f"u{rng.random()}" for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.6:
                text += rng.choice(shared)[rng.randint(0, 9) :]
        if rng.random() < 0.1:
            text += ["z"] * rng.randint(30, 60)
        rows.append((i, " ".join(text)))
    return rows + [(None, None), (None, rows[3][1]), (900, rows[4][1] + " "), (901, ""), (902, "  "), (3, rows[3][1])]


def families(seed):
    """Chains and stars of near copies, some around the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(25):
        base = [f"W{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 6, 40, 80, 120]))]
        now = base
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), " ".join(now)))
            now = list(now if rng.random() < 0.6 else base)
            for _ in range(rng.randint(0, 2)):
                now[rng.randrange(len(now))] = f"w{rng.randint(0, 400)}"
    n = len(rows)
    return rows + [(None, "a b c"), (n, None), (n + 1, ""), (n + 2, "  \n"), (n + 2, "A B  C"), (n + 3, "É b"), (n + 4, "é b")]


def test_difference_cover():
    assert {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER} == set(range(substring_dedup.PERIOD))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(texts, seed):
    rows = passages(seed)
    got = Counter(tuple(r) for r in substring_dedup.remove_repeats(texts(rows, 5)).collect())
    assert got == Counter(brute.repeats(rows))


def test_repeats_of_documents(spark):
    got = Counter(tuple(r) for r in catalog.op2_substring_dedup(spark, FOLDER).collect())
    assert got == Counter((i, n, g, brute.sha(k)) for i, n, g, k in brute.repeats(documents(spark)))


@pytest.mark.parametrize("rounds, centres, seed", [(1, 1, 5), (1, 8, 6), (6, 8, 5)])
def test_ngram_join(texts, monkeypatch, rounds, centres, seed):
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "CENTRES", centres)
    rows = families(seed)
    got = Counter(tuple(r) for r in ngram_join.join_components(texts(rows)).collect())
    assert got == Counter(brute.jaccard_components(rows))


def test_ngram_join_of_documents(spark):
    got = Counter(tuple(r) for r in catalog.op4_ngram_join(spark, FOLDER).collect())
    assert got == Counter(brute.jaccard_components(documents(spark)))


def test_pairs_of_a_family_stay_few(texts, monkeypatch):
    """Near copies share most n-grams, but only pairs whose own edits leave enough in common are listed."""
    rng, rows = random.Random(3), []
    base = [f"b{i}" for i in range(150)]
    for i in range(180):
        now = list(base)
        for at in rng.sample(range(0, 150, 6), rng.randint(0, 4) if i < 60 else rng.randint(6, 9)):
            now[at] = f"e{rng.random()}"
        rows.append((i, " ".join(now)))
    counted = []

    def candidates(*args, found=ngram_join.candidates):
        counted.append((pairs := common.materialize(found(*args))).count())
        return pairs

    monkeypatch.setattr(ngram_join, "candidates", candidates)
    got = Counter(tuple(r) for r in ngram_join.join_components(texts(rows)).collect())
    assert got == Counter(brute.jaccard_components(rows))
    assert sum(counted) < 10 * len(rows)


def test_exact_copies_are_not_linkable(texts):
    """Copies that several tasks send do not count as other sets; sets that share too little go no further."""
    near = [f"n{i}" for i in range(80)]
    rows = [(i, " ".join(f"t{i % 4}_{j}" for j in range(40))) for i in range(40)] + [(40, " ".join(near)), (41, " ".join([*near, "more"])), (42, " ".join(near[:10] + ["x"] * 40))]
    told = common.materialize(ngram_join.told_sets(texts(rows, 5), 5, 75, 8))
    assert sorted(r.n for r in ngram_join.linkable(told, 75).collect()) == [76, 77]
    assert ngram_join.set_of_text(told).count() == 7


def test_one_of_each_group_stays(texts):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "A b c d e f"), (2, None), (2, None), (3, ""), (5, "x y"), (5, "x y"), (5, "q r s")]
    kept = ngram_join.drop_duplicates(texts(rows))
    assert kept.columns == texts(rows).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, "A b c d e f"), (2, None), (2, None), (3, ""), (5, "x y"), (5, "q r s")])


@pytest.mark.parametrize("few", [0, 100_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_LINKS", few)
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PACK", 64)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(20, 8))
    rows = [(i, int(rng.integers(3)) if i % 17 else None, (base[rng.integers(20)] + rng.normal(size=8) * 0.12).astype(np.float32).tolist()) for i in range(800)]
    rows += [(2000, 1, None), (2001, 1, [0.0] * 8), (2002, 1, [float("nan")] * 8), (2003, 1, [None] + [1.0] * 7), (2004, None, None)]
    rows += [(3000 + i, 1, rows[5][2]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = Counter(tuple(r) for r in embedding_dedup.near_duplicates(frame).collect())
    assert got == Counter(brute.cosine_links(rows))
    assert embedding_dedup.near_duplicates(frame.limit(0)).collect() == []


def test_embeddings_of_several_lengths(spark):
    """Each length is linked by itself, also the rarer ones."""
    rng = np.random.default_rng(2)
    parts = []
    for number, length in ((300, 8), (200, 5), (20, 2), (4, 1)):
        base = rng.normal(size=(8, length))
        first = 1000 * length
        parts.append([(first + i, i % 2, (base[rng.integers(8)] + rng.normal(size=length) * 0.05).astype(np.float32).tolist()) for i in range(number)])
    rows = [r for part in parts for r in part]
    frame = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "vec_id long, label int, embedding array<float>")
    got = Counter(tuple(r) for r in embedding_dedup.near_duplicates(frame).collect())
    assert got == sum((Counter(brute.cosine_links(part)) for part in parts), Counter())
    assert sum(n > 0 for i, n, _, _ in got if i < 8000) > 100


@pytest.mark.parametrize("labels", [1, 3, 200])
def test_packs_meet_once_and_are_copied_a_bounded_number_of_times(spark, labels):
    """Vectors are not copied to the cells that they visit: however many packs a label has, its blocks bound the copies."""
    packs = spark.range(400).select((F.col("id") % labels).cast("string").alias("label"), F.col("id").alias("pack"))
    pairs = embedding_dedup.paired(packs)
    got = Counter(tuple(sorted((r.q_pack, r.pack))) for r in pairs.collect())
    assert got == Counter((a, b) for a in range(400) for b in range(a, 400) if a % labels == b % labels)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan
    blocks = int((2 * embedding_dedup.SHARES) ** 0.5) + 1
    at = pairs.select("q_pack", F.spark_partition_id().alias("task")).distinct().groupBy("q_pack").count()
    assert at.agg(F.max("count")).first()[0] <= blocks


def test_vectors_are_stored_once(spark, monkeypatch):
    written = []

    def stored(frame):
        written.append((frame.columns, frame.count()))
        return common.materialize(frame)

    monkeypatch.setattr(embedding_dedup, "materialize", stored)
    monkeypatch.setattr(embedding_dedup, "PACK", 32)
    rng = np.random.default_rng(4)
    rows = [(i, 1, rng.normal(size=16).astype(np.float32).tolist()) for i in range(400)]
    embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()
    vectors = [number for columns, number in written if "vector" in columns or "embedding" in columns]
    packs = [number for columns, number in written if "vectors" in columns]
    assert sum(vectors) == 400 and len(packs) == 1 and 400 / 32 <= packs[0] <= 400 / 32 + 8


def test_traversal_misses_nothing():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(3000, 6)) + np.eye(6)[rng.integers(6, size=3000)] * 4
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    books = [embedding_dedup.codebook(unit[:500, :3], 9), embedding_dedup.codebook(unit[:500, 3:], 9)]
    (own_1, near_1), (own_2, near_2) = embedding_dedup.bounds(unit[:, :3], books[0]), embedding_dedup.bounds(unit[:, 3:], books[1])
    most = 2 - 2 * 0.98 + 1e-9
    for k in range(0, 3000, 50):
        cells = set(zip(*map(list, embedding_dedup.visited(near_1[k], near_2[k], most))))
        near = np.flatnonzero(unit @ unit[k] >= 0.98)
        assert {(own_1[x], own_2[x]) for x in near} <= cells


@pytest.mark.parametrize("operator", [substring_dedup.remove_repeats, ngram_join.join_components, ngram_join.drop_duplicates])
def test_empty(texts, operator):
    assert operator(texts([])).collect() == []
