"""FTRL and order MinHash against plain Python, and token operators over rows without or with equal ids."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roadpulse.llm import fingerprints, huffman, packing, token_counts, toxicity

MASK = (1 << 64) - 1


def plain_ftrl(rows, epochs, alpha, beta, l1, l2, min_rows):
    often = Counter(int(s) for at, _ in rows for s in at)
    z, n, bias_z, bias_n = Counter(), Counter(), 0.0, 0.0

    def weight(s):
        if abs(z[s]) <= l1:
            return 0.0
        return -(z[s] - math.copysign(l1, z[s])) / ((beta + math.sqrt(n[s])) / alpha + l2)

    for _ in range(epochs):
        for at, label in rows:
            own = [int(s) for s in at if often[int(s)] >= min_rows]
            w = {s: weight(s) for s in own}
            b = -bias_z / ((beta + math.sqrt(bias_n)) / alpha)
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - label
            for s in own:
                z[s] += g - (math.sqrt(n[s] + g * g) - math.sqrt(n[s])) / alpha * w[s]
                n[s] += g * g
            bias_z += g - (math.sqrt(bias_n + g * g) - math.sqrt(bias_n)) / alpha * b
            bias_n += g * g
    return {s: weight(s) for s in z if weight(s)}, -bias_z / ((beta + math.sqrt(bias_n)) / alpha)


@pytest.mark.parametrize("l1, min_rows", [(0.5, 2), (3.0, 5)])
def test_ftrl(l1, min_rows):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(120):
        label = int(rng.random() < 0.4)
        at = rng.choice(60, 12, replace=False) + (30 * label if rng.random() < 0.8 else 0)
        rows.append((np.unique(at.astype(np.uint32) * 40_000), label))
    got = toxicity.ftrl(rows, epochs=3, alpha=1.0, l1=l1, l2=0.1, min_rows=min_rows)
    weights, bias = plain_ftrl(rows, 3, 1.0, 1.0, l1, 0.1, min_rows)
    assert got.slots.tolist() == sorted(weights) and len(weights) > 5
    assert np.allclose(got.values, [weights[s] for s in sorted(weights)]) and math.isclose(got.bias, bias)


def mix(x):
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & MASK
    x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & MASK
    return x ^ (x >> 33)


def plain_fingerprint(text):
    """The two k-mers of smallest hash per sketch, in text order; a k-mer carries the number of its occurrence."""
    size = min(fingerprints.K, len(text))
    base, kmers, seen = 0x9E3779B97F4A7C15, [], Counter()
    for i in range(len(text) - size + 1) if text else []:
        h = 0
        for c in text[i : i + size]:
            h = (h * base + ord(c) + 1) & MASK
        h = mix(h)
        kmers.append(mix((h + seen[h] * 0xC2B2AE3D27D4EB4F) & MASK))
        seen[h] += 1
    if not kmers:
        return [0] * fingerprints.SKETCHES
    out = []
    for k in range(1, fingerprints.SKETCHES + 1):
        seed = mix(k * base & MASK) | 1
        places = sorted(sorted(range(len(kmers)), key=lambda i: (kmers[i] * seed & MASK, i))[: fingerprints.KEPT])
        chosen = [kmers[i] for i in places] + [0] * (fingerprints.KEPT - len(places))
        h = seed
        for c in chosen:
            h = mix((h * base + c) & MASK)
        out.append(h >> 32)
    return out


@pytest.mark.parametrize("text", ["", "a", "short", "exactly12chr", "abcabcabcabcabcabcabc" * 3, "Größe 𝒳 und mehr Text, der etwas länger ist. " * 4])
def test_order_minhash(text):
    assert fingerprints.fingerprint(text).tolist() == plain_fingerprint(text)


ODD = [(None, "first row"), (None, None), (7, "same id"), (7, "same id"), (7, "other text"), (None, "first row"), (8, "")]


def test_packing_of_odd_ids(texts):
    """Every row is packed on its own, also without an id or with one that others have."""
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(texts(ODD), with_ids=True).collect()
    want, got = Counter(), Counter()
    for i, t in ODD:
        for token in plain.encode(t or "", add_special_tokens=False).ids + [0]:
            want[i, token] += 1
    for p in pieces:
        got.update((p.doc_id, token) for token in p.ids)
    assert got == want


def test_token_files_of_odd_ids(spark, texts):
    """Rows without an id come first, rows of one id by their ids; every row is there."""
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    folder = huffman.new_folder(spark)
    huffman.write(texts(ODD), folder)
    rows = sorted(huffman.read(spark, folder).collect(), key=lambda r: r.start)
    want = Counter()
    for i, t in ODD:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], np.uint32)
        want[i, zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == want
    assert [r.doc_id for r in rows] == [None] * 3 + [7] * 3 + [8]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


def test_counts_of_odd_ids(texts):
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(texts(ODD)).collect())
    assert got == Counter((i, len((t or "").encode()), len(processor.encode(t or ""))) for i, t in ODD)
