"""Document fingerprints by order MinHash.

A text's k-mers of ``K`` code points are numbered by occurrence. For each of ``SKETCHES`` hash
functions the ``KEPT`` smallest numbered k-mers are chosen, put back into text order and hashed
as a tuple. Two texts agree in a sketch with a probability that falls with their edit distance,
reordering included; the likeness is the share of agreeing sketches.

Neighbours in descending order of doc_id are found without a global window: ids are cut into
ranges, a range is sorted in one task, and the first row of a range is sent to the range before
it as well. Only the cuts and the first id of each range reach the driver (one pair per range).

Defined results: a null text counts as empty; an empty text has the fingerprint of no k-mers; a
text shorter than ``K`` is one k-mer; long texts are read whole, in slices of bounded memory;
rows with equal doc_id are ordered by their text, rows without doc_id come last; an empty table
gives an empty result; further columns are ignored.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import mixed, shuffle_tasks, small_batches, window_hashes

K = 12
SKETCHES = 32
KEPT = 2

_SLICE = 1 << 11
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_FIRST = np.uint64(0x9E3779B97F4A7C15)
_MOST = np.uint64((1 << 64) - 1)


def numbered_kmers(text: str) -> np.ndarray:
    """A hash of each k-mer with the number of its occurrence, in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(codes):
        return codes
    h = mixed(window_hashes(codes + np.uint64(1), min(K, len(codes)), 0x9E3779B97F4A7C15))
    ranked = np.sort(h)
    again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    number = np.zeros(len(h), np.uint64)
    if len(again):
        at = np.flatnonzero(again[np.minimum(np.searchsorted(again, h), len(again) - 1)] == h)
        order = at[np.argsort(h[at], kind="stable")]
        new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        starts = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        number[order] = (np.arange(len(order)) - starts).astype(np.uint64)
    return mixed(h + number * np.uint64(0xC2B2AE3D27D4EB4F))


def fingerprint(text: str) -> np.ndarray:
    """One 32-bit value per sketch."""
    kmers = numbered_kmers(text)
    if not len(kmers):
        return np.zeros(SKETCHES, np.uint32)
    least = np.full((SKETCHES, KEPT), _MOST)  # hashes, and where they stand
    where = np.full((SKETCHES, KEPT), len(kmers))
    rows = np.arange(SKETCHES)
    for start in range(0, len(kmers), _SLICE):
        part = kmers[start : start + _SLICE]
        hashed = part[None, :] * _SEEDS[:, None]  # k-mer hashes are mixed: an odd factor reorders them
        values, places = [least], [where]
        for _ in range(min(KEPT, len(part))):
            at = hashed.argmin(1)
            values.append(hashed[rows, at][:, None])
            places.append((start + at)[:, None])
            hashed[rows, at] = _MOST
        values, places = np.hstack(values), np.hstack(places)
        order = np.argsort(values, axis=1, kind="stable")[:, :KEPT]
        least, where = np.take_along_axis(values, order, 1), np.take_along_axis(places, order, 1)
    order = np.argsort(where, axis=1, kind="stable")
    chosen = np.append(kmers, np.uint64(0))[np.take_along_axis(where, order, 1)]
    out = _SEEDS.copy()
    for j in range(KEPT):
        out = mixed(out * _FIRST + chosen[:, j])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many code points of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """The documents with their fingerprint as hexadecimal text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "").tobytes().hex() for t in texts], dtype=object)

    return docs.withColumn("fingerprint", of("text"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness."""
    spark = small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = F.col("doc_id").desc_nulls_last()
    ranges = shuffle_tasks(spark) * 4
    cuts = docs.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    # range 0 holds the largest ids, the last one the rows without an id
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<long>")
    above = F.aggregate(bounds, F.lit(0), lambda n, c: n + F.when(F.col("doc_id") < c, 1).otherwise(0))
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above)
    placed = docs.withColumn("part", part)
    heads = {r.part: r.head for r in placed.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    present = sorted(heads)
    # the first row of each range follows the last row of the range before it (after the last: the first)
    before = {p: present[i - 1] for i, p in enumerate(present)}
    links = spark.createDataFrame([(heads[p], p, before[p]) for p in present], "head long, own int, target int")
    null_safe = placed.join(F.broadcast(links), (placed.part == links.own) & placed.doc_id.eqNullSafe(links["head"]))
    first_text = null_safe.groupBy("own", "target").agg(F.min("text").alias("text"))
    copies = first_text.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("target").alias("part"), F.lit(True).alias("borrowed"))
    rows = placed.withColumn("borrowed", F.lit(False)).unionByName(copies)

    def run(batches):
        held = None  # the row that waits for the next one: part, doc_id, text, fingerprint
        for pdf in batches:
            out = []
            for p, doc_id, text, borrowed in zip(pdf["part"], pdf["doc_id"].array, pdf["text"], pdf["borrowed"]):
                own = None if borrowed else fingerprint(text)
                if held is not None and held[0] == p:
                    out.append(result(held, text, own if own is not None else fingerprint(text)))
                held = None if borrowed else (p, doc_id, text, own)
            yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc_id": "Int64"})

    ordered = rows.repartition(ranges, "part").sortWithinPartitions("part", F.col("borrowed"), order, "text")
    return ordered.select("part", "doc_id", "text", "borrowed").mapInPandas(run, _SCHEMA)


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def result(held: tuple, following: str, next_print: np.ndarray) -> tuple:
    _, doc_id, text, own = held
    changed = edited(text, following)
    changed_print = own if changed == text else fingerprint(changed)
    doc_id = None if pd.isna(doc_id) else int(doc_id)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        own.tobytes().hex(),
        changed_print.tobytes().hex(),
        likeness(own, changed_print),
        likeness(own, next_print),
    )
