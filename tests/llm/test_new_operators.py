"""Vector codes, line quality and collocations against plain Python."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import catalog, collocations, quality, vector_codes

FOLDER = "/root/testdata/sf0.001"
VECTOR = "vec_id long, label string, embedding array<double>, entry int, numbers binary, total_label string"


# vector codes


def plain_codes(rows, parts=8, entries=16, scale=4096, rounds=6):
    kept = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts) * parts
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    dims = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:entries]
    books = [[r[2][p * dims : (p + 1) * dims] for r in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for *_, v in kept:
                x = v[p * dims : (p + 1) * dims]
                members[nearest(p, x)[1]].append(x)
            new.append([[sum(c) // len(c) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])])
        books = new
    found = [(i, label, [nearest(p, v[p * dims : (p + 1) * dims]) for p in range(parts)]) for i, label, v in kept]
    by_label = Counter()
    for _, label, f in found:
        by_label[label] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, label, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[label], sha) for i, label, f in found)


def vector_frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, label, v, 1, b"x", "t") for i, label, v in rows], VECTOR).repartition(parts)


def coded(frame, **options):
    return Counter((r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.vector_codes(frame, **options).collect())


def test_vector_codes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "hot" if i % 3 else f"l{i % 7}", rng.normal(0, 0.3, 16).round(2).tolist()) for i in range(200)]
    rows += [(500 + i, None, rows[i % 4][2]) for i in range(30)]  # copies, and labels of null
    rows += [(700, "a", None), (701, "a", [None] * 16), (702, "a", [float("nan")] * 16), (703, "a", [float("inf")] * 16), (704, "z", [0.0] * 16), (705, "z", [-1.5, 2.25])]
    got = coded(vector_frame(spark, rows))
    assert got == plain_codes(rows) and sum(got.values()) == 232


def test_vector_codes_of_few_or_odd_rows(spark):
    assert coded(vector_frame(spark, [])) == Counter()
    assert coded(vector_frame(spark, [(1, "a", None), (2, "a", [None])])) == Counter()
    few = [(3, "a", [0.1, 0.2, 0.3]), (2, "a", []), (2, "b", [0.5] * 9)]
    assert [(r.vec_id, len(r.code)) for r in vector_codes.vector_codes(vector_frame(spark, few)).orderBy("vec_id", "code").collect()] == [(2, 16), (2, 16), (3, 16)]
    assert len(coded(vector_frame(spark, [(None, "a", [1.0] * 8)] * 3))) == 1
    large = coded(vector_frame(spark, [(1, "a", [1e300, -1e300] * 8), (2, "a", [0.0] * 16)], 1), entries=1, rounds=0)
    assert sorted(e for _, _, _, e, *_ in large) [0] == 0


def test_many_entries_use_several_words(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "l", rng.normal(0, 1, 8).tolist()) for i in range(300)]
    options = {"parts": 2, "entries": 130, "rounds": 2}
    assert coded(vector_frame(spark, rows), **options) == plain_codes(rows, **options)


def test_candidates_are_exact():
    """The masks never lose the nearest entry, and leave out most of the others."""
    rng = np.random.default_rng(6)
    entries, points = rng.integers(-4000, 4000, (64, 6)), rng.integers(-4000, 4000, (2000, 6))
    entries[10] = entries[40]
    slices = vector_codes.Slices(entries)
    every = ((points[:, None] - entries[None]) ** 2).sum(-1)
    index, error = slices.nearest(points)
    assert (index == every.argmin(1)).all() and (error == every.min(1)).all()
    reach = np.sqrt(error).astype(np.int64) + 1
    bits = np.unpackbits(slices.candidates(points, reach).view(np.uint8), axis=1).sum(1)
    assert (bits > 0).all() and bits.mean() < 12


def test_decoded_vectors_are_near(spark):
    rows = vector_codes.usable(spark.read.parquet(f"{FOLDER}/embeddings.parquet"))
    numbers = vector_codes.whole_numbers(rows, 4096, 64)
    books = vector_codes.fit(numbers, 8, 16, 4096, 64, 3)
    decoded = vector_codes.decode(vector_codes.encode(numbers, books), books)
    for r in decoded.join(rows.select("vec_id", "embedding"), "vec_id").collect():
        distance = ((np.array(r.approximation) - np.array(r.embedding)) ** 2).sum() ** 0.5
        assert abs(distance - r.error**0.5 / 4096) < 0.01


# quality


def plain_chain(score, transitions):
    """Probability of label good per line, and expected pairs, by listing all labellings."""
    n, total = len(score), 0.0
    good, pairs = np.zeros(n), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(s * y for s, y in zip(score, labels)) + sum(transitions[a][b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    return good / total, pairs / total


def test_forward_backward():
    rng = np.random.default_rng(7)
    lengths = [3, 1, 6, 2, 1, 5]
    edges = np.concatenate([[0], np.cumsum(lengths)])
    score, transitions = rng.normal(0, 2, edges[-1]), rng.normal(0, 1, (2, 2))
    good, pairs = quality.chains(score, transitions, edges)
    plain = [plain_chain(score[a:b], transitions) for a, b in zip(edges[:-1], edges[1:])]
    assert np.allclose(good, np.concatenate([g for g, _ in plain])) and np.allclose(pairs, sum(p for _, p in plain))
    strong, _ = quality.chains(np.array([900.0, -900.0, 900.0]), np.zeros((2, 2)), np.array([0, 3]))
    assert np.allclose(strong, [1, 0, 1])


def test_line_features():
    own, sizes = quality.line_features("Ab cd.\n\nAB!! AB!!\nAb cd.".encode())
    assert own.shape == (4, quality.OWN) and sizes.tolist() == [6, 1, 9, 6]
    assert own[:, 13].tolist() == [0, 0, 0, 1] and own[:, 20].tolist() == [0, 1, 0, 0] and np.isfinite(own).all()
    beside = quality.with_neighbours(own, np.array([0, 2, 4]))
    assert (beside[1, quality.OWN : 2 * quality.OWN] == own[0]).all() and not beside[2, quality.OWN : 2 * quality.OWN].any()
    assert not beside[1, 2 * quality.OWN :].any()


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    got = catalog.op12_quality(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id").query("held_out")
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count() and got.score.between(0, 1).all()
    assert (both.predicted[both.quality == 1] == 1).mean() > 0.97 and (both.predicted == both.quality).mean() > 0.93
    ranks = both.score.rank()
    bad, good = (both.quality == 0).sum(), (both.quality == 1).sum()
    area = (ranks[both.quality == 1].sum() - good * (good + 1) / 2) / (bad * good)
    assert area > 0.97


def test_quality_of_odd_rows(spark, texts):
    good, bad = "Some words stand here. They go on well.\nAnd so do these words, line by line.", "BUY!! NOW!! BUY!! NOW!!\n### $$$ ### &&&"
    rows = [(i, f"{good} {i}" if i % 2 else f"{bad} {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(texts(rows), labels)
    odd = [(1, None), (2, ""), (3, good), (3, good), (None, bad), (4, "\n\n"), (5, "word " * 200_000), (6, "\n".join([good] * 3000))]
    frame = texts(odd).withColumn("score", F.lit("own"))
    scored = quality.score(frame.drop("score"), model).collect()
    by_text = {r.text: r.score for r in scored}
    assert len(scored) == len(odd) and all(0 <= r.score <= 1 for r in scored)
    assert by_text[good] > 0.5 > by_text[bad] and by_text[None] == by_text[""]
    assert quality.score(texts([]), model).collect() == []
    for given in (labels.where("false"), labels.where("quality = 1")):
        assert {r.score for r in quality.score(texts(odd), quality.fit(texts(rows), given)).collect()} == {1.0}
    assert {r.score for r in quality.score(texts(odd), quality.fit(texts(rows), labels.where("quality = 0"))).collect()} == {0.0}


def test_training_rows_of_quality_are_never_held_out(spark, texts):
    import zlib

    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    rows = quality.labelled_lines(texts([(i, f"text {i}\nline") for i in range(100)]), labels, 1000, 1000)
    assert len(rows) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(100))
    assert len(quality.labelled_lines(texts([(i, "a\nb") for i in range(100)]), labels, 30, 41)) == 20


# collocations


def plain_collocations(rows, longest, least, keep, percent=100):
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for c in ".,;:!?\n\v\f\r":
            text = (text or "").replace(c, "\n")
        for piece in text.translate(lower).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for s in range(len(p) - k + 1):
                    inside[p[s : s + k]] = max(inside[p[s : s + k]], a)
        for p, a in candidates.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, cut = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, k, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(found)[:keep], 1)]
    return Counter(out)


def spoken(spark, rows, parts=3):
    frame = spark.createDataFrame([(lang, text, 1, b"x", 2, 3) for lang, text in rows], "lang string, text string, rank int, first binary, fragment int, a int")
    return frame.repartition(parts) if rows else frame


@pytest.mark.parametrize("seed, chunk", [(1, 200), (2, 16_000_000)])
def test_collocations(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rng = random.Random(seed)
    words = ["The", "of", "é", "É", "b c", "\x1f", "A", "a", "#x", "zz", "new", "York", "(", "𝒳"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words[: rng.choice([4, 14])]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r", ",", " x "]) for _ in range(rng.randint(0, 80)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    rows += [("en", None), (None, ""), ("en", ".,;:"), *[("en", "new york city hall now")] * 40, ("fr", "one " * 500)]
    for least, percent in ((5, 100), (3, 60)):
        got = collocations.collocations(spoken(spark, rows), least=least, keep=30, percent=percent).collect()
        assert Counter(tuple(r) for r in got) == plain_collocations(rows, 5, least, 30, percent)


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None)], [("en", "a b c")], [("en", "a " * 120), ("en", "b")]):
        got = collocations.collocations(spoken(spark, rows)).collect()
        assert Counter(tuple(r) for r in got) == plain_collocations(rows, 5, 100, 2000)


def test_large_products_stay_exact(spark):
    """Products of counts beyond 64 bits."""
    a, n, left, right = 9_000_000_000, 4_000_000_000_000_000, 9_000_000_000, 1_000_000_007
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").select(collocations.cut_score().alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)
