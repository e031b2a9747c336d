"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, of pairs of neighbours and of pairs with one word between,
hashed into ``2 ** BITS`` slots. Every coordinate has its own learning rate, and the L1 term
leaves few weights other than zero, which is what is sent to the tasks: at most ``2 ** BITS``
pairs, whatever the corpus.

Defined results: null and empty texts get the score of the bias alone; long texts are read
whole; equal texts get equal scores; without labels every score is 0.5 and every prediction 1;
rows without doc_id are scored; further columns are
kept, but for one named as the score, which is replaced.
"""

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import WordHashes, mixed, small_batches

BITS = 22
#: At most so many labelled rows are used for fitting.
MAX_ROWS = 6_000

_TOKEN = re.compile(r"[^\W_]+")


class Weights(NamedTuple):
    slots: np.ndarray  # sorted slots with a weight
    values: np.ndarray
    bias: float


def slots_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Distinct slots of a text's words, pairs of neighbours and pairs with a gap."""
    h = hashes(_TOKEN.findall(text.lower())) if text else np.empty(0, np.uint64)
    both = [mixed(h), mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]), mixed(h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:])]
    return np.unique((np.concatenate(both) >> np.uint64(64 - BITS)).astype(np.uint32))


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = 6, alpha: float = 3.0, beta: float = 1.0, l1: float = 10.0, l2: float = 0.0, min_rows: int = 5) -> Weights:
    """Fit on (slots, label) in the given order, ``epochs`` times.

    A slot that fewer than ``min_rows`` of these rows have gets no weight.
    """
    seen = np.zeros(1 << BITS, np.uint32)
    for at, _ in rows:
        seen[at] += 1  # slots of a row are distinct
    slots = np.flatnonzero(seen >= min_rows).astype(np.uint32)
    del seen
    dense = np.full(1 << BITS, -1, np.int32)
    dense[slots] = np.arange(len(slots), dtype=np.int32)
    rows = [(own[own >= 0], label) for own, label in ((dense[at], label) for at, label in rows)]
    del dense
    z, n = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)

    def weights(at):
        part = z[at]
        out = -(part - np.sign(part) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        out[np.abs(part) <= l1] = 0.0
        return out

    def bias():
        return -z[-1] / ((beta + np.sqrt(n[-1])) / alpha)

    for _ in range(epochs if rows else 0):
        for at, label in rows:
            w, b = weights(at), bias()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - label
            old = n[at]
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
            n[at] = old + g * g
            z[-1] += g - (np.sqrt(n[-1] + g * g) - np.sqrt(n[-1])) / alpha * b
            n[-1] += g * g
    every = weights(np.arange(len(slots)))
    used = np.flatnonzero(every)
    return Weights(slots[used], every[used], float(bias()))


def train_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> list[tuple[np.ndarray, int]]:
    """At most ``max_rows`` labelled rows as (slots, label): those with the smallest id hashes.

    Only rows whose crc32(doc_id) is not divisible by 5 are taken; of several labels of a
    document the highest counts, of several texts the smallest.
    """
    small_batches(docs.sparkSession)
    usable = labels.where("doc_id is not null and toxic is not null").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    ids = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def read(batches):
        hashes = WordHashes()
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "slots": [slots_of(t, hashes).tobytes() for t in pdf["text"]], "toxic": pdf["toxic"]})

    got = sorted((hash_order(r.doc_id), r.doc_id, bytes(r.slots), r.toxic) for r in chosen.mapInPandas(read, "doc_id long, slots binary, toxic int").toLocalIterator())
    return [(np.frombuffer(s, np.uint32), int(t > 0)) for *_, s, t in got]


def hash_order(doc_id: int) -> int:
    return int(mixed(np.array([doc_id % (1 << 64)], np.uint64))[0])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Weights:
    return ftrl(train_rows(docs, labels, max_rows))


def fitted(weights: Weights) -> bool:
    """False where no labelled row was there to fit on, so that every score is 0.5."""
    return len(weights.slots) > 0 or weights.bias != 0.0


def score(docs: DataFrame, weights: Weights, name: str = "score") -> DataFrame:
    """The documents with the probability of label 1 as a further column."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    state: dict = {}

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        if not state:
            table = np.zeros(1 << BITS, np.float32)
            table[sent.value.slots] = sent.value.values
            state["table"], state["hashes"] = table, WordHashes()
        sums = [state["table"][slots_of(t, state["hashes"])].sum(dtype=float) for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums) + sent.value.bias, -30, 30))))

    return docs.withColumn(name, probability("text"))
