"""Token ids, counts, packing and token files against the tokenizers themselves."""

import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from roadpulse.llm import catalog, huffman, packing, token_counts
from roadpulse.llm.common import WordHashes
from roadpulse.llm.tokens import PieceEncoder, encoder

FOLDER = "/root/testdata/sf0.001"
FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def odd_texts(number, seed=1):
    rng = random.Random(seed)
    parts = list("ab Zé  \n\t'sll 12!?ñ中́  \x1c\x85Σσİ\0\1zo") + ["<|endoftext|>", "<|startoftext|>", "<s>", "▁", "▁▁", "  ", "'re", "x" * 70, " \n ", "\r\n", "ﬁ", "word. Next, één.\nZwei!? ab.\n", "abc$$$", "de_f-", "x\\]^", "Y~\nz.#", "don't", "a.'s"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(number)]


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name, spaces", FILES)
def test_piece_encoder(name, spaces):
    texts = odd_texts(3000)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    encode = PieceEncoder(name, spaces)
    got = [ids.tolist() for i in range(0, len(texts), 500) for ids in encode(texts[i : i + 500])]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name, spaces", FILES)
def test_piece_encoder_that_remembers_little(name, spaces):
    texts = odd_texts(3000)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    encode = PieceEncoder(name, spaces, remembered=40)
    got = []
    for i in range(0, len(texts), 100):
        got += [ids.tolist() for ids in encode(texts[i : i + 100])]
        now = {p for t in texts[i : i + 100] for p in t.split(" ")}
        assert len(encode.words) <= 40 + 3 * len(now) and len(encode.known) <= len(encode.words) + 10 + 3 * len(now)
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_words_are_learned_once_whatever_their_case_and_punctuation():
    texts = ["Word word WORD word. Word,\nword!\tWORD\r\nÉtÉ, étÉ", "\x0bword.\x0c ... été. 'word' wOrD", "", " \n"]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = PieceEncoder("word_bpe_49k.json", False)
    assert [ids.tolist() for ids in encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encode.words.keys() == {"", "word", "ÉtÉ", "étÉ", "été", ".", ",", "!", "..."} and not encode.known
    assert encode([]) == []


def test_every_plain_letter():
    letters = [chr(i) for i in range(0x250) if chr(i).isalpha()]
    texts = [t for c in letters for t in (c, f"{c}{c}", f"w{c}rt{c}", f"W{c}RT.", f"{c}\u0301 {c}\n\u0308.")]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = PieceEncoder("word_bpe_49k.json", False)
    assert [ids.tolist() for ids in encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    special = ["<|STARTOFTEXT|> <|EndOfText|>", "<|endoftext|> Word", "x<|startoftext|>.", "a\u00a0b \x1cC \x85 \u2028d ẞ K Å İ H\u0331"]
    assert [ids.tolist() for ids in encode(special)] == [e.ids for e in plain.encode_batch(special, add_special_tokens=False)]


@pytest.mark.parametrize("name, spaces", FILES)
def test_worker_gives_up_the_encoder_of_a_stage_that_is_over(name, spaces):
    own = encoder(name, spaces)
    assert encoder(name, spaces) is own
    own = weakref.ref(own)
    WordHashes()  # as tasks of the toxicity and n-gram stages make
    assert own() is None


def test_counts(texts):
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(i, t) for i, t in enumerate(odd_texts(1500, 2))] + [(None, None), (5000, ""), (5000, ""), (6000, "wort " * 30_000)]
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(texts(rows), chunk_chars=2000).where("doc_id is not null").collect())
    assert got == sorted((False, i, len(t.encode()), len(processor.encode(t))) for i, t in rows if i is not None)
    assert token_counts.count_tokens(texts([])).collect() == []


def test_counts_of_documents(spark):
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in catalog.op6_token_counts(spark, FOLDER).collect()}
    assert got == {i: (n := len(processor.encode(t)), n > 4096) for i, t in documents(spark)}


def check_pieces(rows, pieces, end_id=0):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(plain.encode(t or "", add_special_tokens=False).ids + [end_id], np.uint32) for i, t in rows}
    seen, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        own = ids[p.doc_id]
        assert p.start == seen.get(p.doc_id, 0) and p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
        seen[p.doc_id] = p.start + p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length, p.tier, p.step_group))
    assert seen == {i: len(x) for i, x in ids.items()}
    steps = {}
    for parts in sequences.values():
        at = 0
        for offset, length, _, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == parts[0][2] <= 1024 and at & (at - 1) == 0  # nothing is padded
        steps[parts[0][3]] = steps.get(parts[0][3], 0) + at
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_packing(spark, texts):
    rows = documents(spark)
    check_pieces(rows, catalog.op7_packing(spark, FOLDER).collect())
    rows = [(i, t) for i, t in enumerate(odd_texts(400, 3))] + [(800, None), (801, "lang " * 20_000)]
    pieces = packing.pack(texts(rows), with_ids=True).collect()
    check_pieces(rows, pieces)
    assert all(zlib.crc32(np.array(p.ids, np.uint32).tobytes()) == p.ids_crc32 for p in pieces)
    assert packing.pack(texts([])).collect() == []


def test_packing_of_the_pipeline(spark, texts, monkeypatch):
    rows = documents(spark) + [(i, t) for i, t in enumerate(odd_texts(400, 3), 10**6)]
    docs = texts(rows)
    whole = sorted(packing.pack(docs, with_ids=True).collect())
    for words in (corpus_pipeline.PACKING_WORDS, 100):
        monkeypatch.setattr(corpus_pipeline, "PACKING_WORDS", words)
        assert sorted(corpus_pipeline.pack_sequences(spark, docs, FOLDER).collect()) == whole


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 3000):
        counts = (rng.pareto(0.7, n) * 5 + 1).astype(np.int64)
        lengths = huffman.code_lengths(counts, 12)
        assert lengths.max() <= 12 and (2.0 ** -lengths).sum() <= 1
    import heapq

    counts = rng.integers(1, 100, 40)
    heap, total = sorted(counts.tolist()), 0
    while len(heap) > 1:
        low = heapq.heappop(heap) + heapq.heappop(heap)
        total += low
        heapq.heappush(heap, low)
    assert (huffman.code_lengths(counts) * counts).sum() == total  # optimal where the limit does not bind


def test_block_round_trip():
    rng = np.random.default_rng(2)
    blocks = [rng.zipf(1.3, n).clip(1, 40_000).astype(np.uint32) for n in (1, 511, 512, 513, 70_000)]
    ids, counts = np.unique(np.concatenate(blocks), return_counts=True)
    code = huffman.Code(ids, huffman.code_lengths(counts))
    coded = [(*huffman.encode_block(b, *code.encoding()), len(b)) for b in blocks]
    assert all((a == b).all() for a, b in zip(blocks, huffman.decode_blocks(coded, *code.decoding())))


def check_files(rows, got):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    for i, t in rows:
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], np.uint32)
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected


def test_token_files(spark, texts):
    check_files(documents(spark), catalog.op8_token_files(spark, FOLDER).collect())
    rows = [(i, t) for i, t in enumerate(odd_texts(300, 4))] + [(800, None), (801, "lang wort " * 50_000), (802, "")]
    folder = huffman.new_folder(spark)
    huffman.write(texts(rows), folder)
    got = huffman.read(spark, folder).collect()
    check_files(rows, got)
    assert all(zlib.crc32(np.array(r.ids, np.uint32).tobytes()) == r.ids_crc32 for r in got)


def test_no_token_files(spark, texts):
    folder = huffman.new_folder(spark)
    huffman.write(texts([]), folder)
    assert huffman.read(spark, folder).collect() == []
