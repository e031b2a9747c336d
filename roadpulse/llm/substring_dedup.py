"""Exact removal of repeated word windows, found by difference-cover anchors.

A window of ``SPAN`` words repeats if its words also start anywhere else. Hashes are taken only
at positions that lie in a difference cover modulo ``PERIOD``: for any two places some shift
below ``PERIOD`` brings both into the cover, so two equal windows always share an anchor of
``SPAN - PERIOD + 1`` words at the same shift. Anchors that occur twice mark the places where a
repeated window can start; only there a match is extended to whole windows, which are compared
by 96-bit hashes over all documents. Every occurrence of a repeated window has a repeated
anchor, so nothing is missed; windows are judged on the input.

Equal texts are handled once: in a text that occurs twice every window repeats. Anchors and
windows are dealt into fragments by hash, packed per document; a frequent passage costs one
entry per distinct text that holds it, never a pair.

Defined results: a null text has no words; a text with fewer words than ``SPAN`` keeps all;
long texts are read whole; repeated rows lose their windows like any repeated text; an empty
table gives an empty result; further columns are ignored.
"""

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import POSTINGS, WordHashes, expand, fragment_groups, fragments_for, gathered, materialize, mixed, scattered, small_batches, squeeze, text_key, window_hashes

SPAN = 35
# A perfect difference cover, every residue is a difference of two members.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)

FRAGMENT_BYTES = 96_000_000

_BASE, _SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MARKS = "key binary, at binary"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def anchor_places(n_words: int) -> np.ndarray:
    """Anchor positions in a text of ``n_words`` words."""
    last = n_words - (SPAN - PERIOD + 1)
    if last < 0:
        return np.empty(0, np.int64)
    starts = np.arange(0, last + PERIOD, PERIOD)
    at = (starts[:, None] + np.array(COVER)).ravel()
    return at[at <= last]


def window_starts(n_words: int, anchors: np.ndarray) -> np.ndarray:
    """Windows that hold one of ``anchors`` at a shift below ``PERIOD``."""
    if n_words < SPAN:
        return np.empty(0, np.int64)
    edge = np.zeros(n_words + PERIOD + 1, np.int64)
    np.add.at(edge, np.maximum(anchors - PERIOD + 1, 0), 1)
    np.add.at(edge, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[: n_words - SPAN + 1] > 0)


def covered(n_words: int, starts: np.ndarray) -> np.ndarray:
    """Words that lie in a window starting at one of ``starts``."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + SPAN, -1)
    return np.cumsum(edge)[:n_words] > 0


def _marks(table: list[bytes], owner: np.ndarray, places: np.ndarray, pick: np.ndarray) -> pd.DataFrame | None:
    """Places of the picked postings, per key."""
    owner, places = owner[pick], places[pick]
    if not len(owner):
        return None
    order = np.lexsort((places, owner))
    owner, places = owner[order], places[order].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    parts = np.split(places, starts[1:])
    return pd.DataFrame({"key": [table[i] for i in owner[starts]], "at": [squeeze(np.diff(p, prepend=0)) for p in parts]})


def _repeated(postings: DataFrame, fragments: int) -> DataFrame:
    """Per key, the places whose hash (and further bits) occurs twice among all postings."""

    def find(batches):
        for _, rows in fragment_groups(batches):
            table, hashes, owner, places, checks = gathered(rows)
            order = np.lexsort((checks, hashes)) if len(checks) else np.argsort(hashes, kind="stable")
            same = hashes[order][1:] == hashes[order][:-1]
            if len(checks):
                same &= checks[order][1:] == checks[order][:-1]
            twice = np.zeros(len(order), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            marks = _marks(table, owner, places, twice)
            if marks is not None:
                yield marks

    return postings.repartition(fragments, "fragment").sortWithinPartitions("fragment").mapInPandas(find, _MARKS)


def _places(parts) -> np.ndarray:
    return np.concatenate([np.cumsum(expand(x).astype(np.int64)) for x in parts])


def _distinct(keyed: DataFrame) -> DataFrame:
    """Texts without the copies a task meets, compressed: (key, packed)."""

    def run(batches):
        press, seen = zstandard.ZstdCompressor(level=1), set()
        for pdf in batches:
            rows = []
            for key, text in zip(map(bytes, pdf["key"]), pdf["text"]):
                if key not in seen:
                    seen.add(key)
                    rows.append((key, press.compress(text.encode("utf-8", "surrogatepass"))))
            if len(seen) > 200_000:
                seen.clear()
            yield pd.DataFrame(rows, columns=["key", "packed"])

    return keyed.mapInPandas(run, "key binary, packed binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the kept words, joined by spaces) of every row."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fragments = fragments_for(docs, FRAGMENT_BYTES) * 2
    keyed = docs.where("text is not null").select("text", text_key("text").alias("key"))

    def anchors(batches):
        hashes, seen = WordHashes(), set()
        for pdf in batches:
            rows = []
            for key, text in zip(map(bytes, pdf["key"]), pdf["text"]):
                if key not in seen:
                    words = hashes(split_words(text))
                    at = anchor_places(len(words))
                    rows.append((key, mixed(window_hashes(words, SPAN - PERIOD + 1, _BASE)[at]), at))
                    seen.add(key)
            if len(seen) > 200_000:
                seen.clear()
            out = list(scattered(rows, fragments))
            if out:
                yield pd.DataFrame(out)

    def windows(batches):
        hashes, expander = WordHashes(), zstandard.ZstdDecompressor()
        for pdf in batches:
            rows = []
            for key, packed, marks in zip(map(bytes, pdf["key"]), pdf["packed"], pdf["marks"]):
                words = hashes(expander.decompress(packed).split())
                starts = window_starts(len(words), _places(marks))
                second = mixed(window_hashes(mixed(words), SPAN, _SECOND)[starts]) >> np.uint64(32)
                rows.append((key, mixed(window_hashes(words, SPAN, _BASE)[starts]), starts, second))
            out = list(scattered(rows, fragments))
            if out:
                yield pd.DataFrame(out)

    def kept(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, copies, starts in zip(pdf["doc_id"].array, pdf["text"], pdf["copies"], pdf["starts"]):
                words = split_words(text)
                n = len(words)
                if n >= SPAN and copies > 1:
                    words = []
                elif starts is not None and len(starts):
                    gone = covered(n, _places(starts))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                rows.append((doc_id, n, n - len(words), b" ".join(words).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})

    def found(postings: DataFrame, name: str) -> DataFrame:
        return materialize(_repeated(postings, fragments)).groupBy("key").agg(F.collect_list("at").alias(name))

    marks = found(keyed.mapInPandas(anchors, POSTINGS), "marks")
    starts = found(_distinct(keyed).join(marks, "key").mapInPandas(windows, POSTINGS), "starts")
    copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    known = materialize(starts.join(copies, "key", "full"))
    placed = docs.withColumn("key", text_key("text")).join(known, "key", "left")
    return placed.select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "starts").mapInPandas(kept, "doc_id long, n_words long, n_removed long, kept string")
