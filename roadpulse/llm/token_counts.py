"""Token counts without token ids: pieces once per distinct pre-token, times its frequencies.

A pre-token is what stands between spaces (the word-start mark of the piece model), which no
piece crosses. Documents are read in chunks of bounded size. A chunk's distinct pre-tokens
are sent to buckets by hash; a bucket counts the pieces of each distinct pre-token once, for
all chunks, and returns the counts to the chunks. There they meet the documents' pre-token
frequencies and are summed. A frequent pre-token costs one entry per chunk, so no bucket is
hot, and nothing grows with a group beyond the number of chunks.

Defined results: null and empty texts have no tokens; long texts are counted whole (a chunk is
closed after the document that fills it); repeated rows give repeated results; an empty table
gives an empty result; further columns are ignored.
"""

import hashlib
import re

import numpy as np
import pandas as pd
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import expand, fragments_for, small_batches, squeeze

CHUNK_CHARS = 12_000_000
BUCKET_BYTES = 24_000_000

_MARK = "▁"
_RUN = re.compile(f"{_MARK}+[^{_MARK}]*|^[^{_MARK}]+")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first word-start mark; other marks are written as spaces."""
    if not text:
        return []
    if _MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    marked = _MARK + text.replace(" ", _MARK)
    return [run[1:].replace(_MARK, " ") for run in _RUN.findall(marked)]


class _Chunk:
    """Distinct pre-tokens of some documents and each document's frequencies."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.ids, self.n_bytes, self.sizes, self.at, self.counts = [], [], [], [], []
        self.chars = 0

    def add(self, doc_id, text: str | None) -> None:
        index = self.index
        words = pre_tokens(text or "")
        for w in set(words).difference(index):
            index[w] = len(index)
        at, counts = np.unique(np.fromiter(map(index.__getitem__, words), np.int64, len(words)), return_counts=True)
        self.ids.append(doc_id)
        self.n_bytes.append(len((text or "").encode("utf-8", "surrogatepass")))
        self.sizes.append(len(at))
        self.at.append(at.astype(np.uint32))
        self.counts.append(counts.astype(np.uint32))
        self.chars += len(text or "")

    def key(self) -> str:
        """Names the chunk by its pre-tokens, so both readers of the documents agree on it."""
        return hashlib.md5("\0".join(self.index).encode("utf-8", "surrogatepass")).hexdigest()


def _chunks(batches, chars: int):
    chunk = _Chunk()
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"].array, pdf["text"]):
            chunk.add(doc_id, text)
            if chunk.chars >= chars:
                yield chunk
                chunk = _Chunk()
    if chunk.ids:
        yield chunk


def _escaped(word: str) -> str:
    """The word without the separator of the list it is sent in."""
    return word.replace("\1", "\1o").replace("\0", "\1z") if "\0" in word or "\1" in word else word


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets = fragments_for(docs, BUCKET_BYTES)

    def words_out(batches):
        for chunk in _chunks(batches, chunk_chars):
            words = np.array(list(chunk.index), dtype=object)
            to = np.fromiter((xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % buckets for w in words), np.int64, len(words))
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(buckets + 1))
            key = chunk.key()
            for b in range(buckets):
                own = order[cuts[b] : cuts[b + 1]]
                if len(own):
                    steps = np.diff(own, prepend=0)
                    yield pd.DataFrame({"bucket": [b], "chunk": [key], "at": [squeeze(steps)], "words": ["\0".join(_escaped(w) for w in words[own])], "n": [len(own)]})

    def frequencies(batches):
        for chunk in _chunks(batches, chunk_chars):
            known = [i if i is not None and i is not pd.NA and i == i else None for i in chunk.ids]
            at = np.concatenate(chunk.at) if chunk.at else np.empty(0, np.uint32)
            first = np.zeros(len(at), bool)
            starts = np.cumsum([0, *chunk.sizes[:-1]])
            first[starts[np.array(chunk.sizes) > 0]] = True
            steps = np.where(first, at, at - np.roll(at, 1)) if len(at) else at
            yield pd.DataFrame(
                {"chunk": [chunk.key()], "ids": [known], "n_bytes": [chunk.n_bytes], "sizes": [chunk.sizes], "at": [squeeze(steps)], "counts": [squeeze(np.concatenate(chunk.counts))], "words": [len(chunk.index)]}
            )

    def pieces(batches):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        known: dict[str, int] = {"": 1}  # a mark that ends a text stands alone
        for pdf in batches:
            rows = []
            for text, n in zip(pdf["words"], pdf["n"]):
                words = [w.replace("\1z", "\0").replace("\1o", "\1") for w in text.split("\0")] if "\1" in text else text.split("\0")
                new = [w for w in dict.fromkeys(words) if w not in known]
                known.update(zip(new, map(len, processor.encode(new, num_threads=1))))
                rows.append(squeeze(np.fromiter(map(known.__getitem__, words), np.int64, n)))
            yield pd.DataFrame({"chunk": pdf["chunk"], "at": pdf["at"], "pieces": rows})

    def total(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples():
            table = np.full(row.words, -1, np.int64)
            for r in right.itertuples():
                table[np.cumsum(expand(r.at).astype(np.int64))] = expand(r.pieces)
            if (table < 0).any():
                raise RuntimeError("a chunk has pre-tokens without a count: its two readers saw different rows")
            sizes = np.array(row.sizes)
            counts, steps = expand(row.counts).astype(np.int64), expand(row.at).astype(np.int64)
            ends = np.cumsum(sizes)
            running = np.cumsum(steps)
            before = np.repeat(np.concatenate([[0], running])[np.concatenate([[0], ends[:-1]])], sizes)
            sums = np.concatenate([[0], np.cumsum(table[running - before] * counts)])
            tokens = sums[ends] - sums[ends - sizes]
            out.append(pd.DataFrame({"doc_id": pd.array(list(row.ids), dtype="Int64"), "n_bytes": row.n_bytes, "n_tokens": tokens}))
        return pd.concat(out) if out else pd.DataFrame({"doc_id": pd.array([], dtype="Int64"), "n_bytes": [], "n_tokens": []})

    counted = (
        docs.mapInPandas(words_out, "bucket int, chunk string, at binary, words string, n int")
        .repartition(buckets, "bucket")
        .mapInPandas(pieces, "chunk string, at binary, pieces binary")
    )
    held = docs.mapInPandas(frequencies, "chunk string, ids array<long>, n_bytes array<long>, sizes array<int>, at binary, counts binary, words int")
    return held.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInPandas(total, "doc_id long, n_bytes long, n_tokens long")
