"""Vector codes: product quantization whose nearest entries are found by slice-and-intersect bitmasks.

A vector becomes whole numbers, is cut into equal consecutive parts, and every part is named by
the nearest entry of its position's codebook. To find it, a codebook keeps for every dimension
its entries' sorted coordinates and, for every place in that order, a mask of the entries before
it. A radius around a part cuts a slice of the order out of each dimension, whose entries are the
difference of two prefix masks, and the intersection of the slices holds every entry within the
radius. The initial radius is half a usual distance between neighbouring entries; it is doubled
while the intersection is empty, and set to the distance of the nearest candidate where that is
larger, so that no entry outside can be as near. Only candidates are measured. Masks are uint64
words, one for each 64 entries.

All arithmetic is in whole numbers, so results do not depend on how rows are spread. The codebooks
are ``entries`` numbers per component, sent to the tasks; a round returns one sum per entry and
component from all tasks together.

Defined results: rows whose vector is null, or holds null or non-finite components, are left
out; rows without id are kept and begin the codebooks after all others; rows of equal id begin
them in the order of their components; with fewer rows than entries there are as many entries
as rows; shorter vectors, and those whose length the parts do not divide, count as filled up with
zeros, so an empty vector is all zeros; components are limited to ``_limit`` so that errors fit
64 bits (beyond 32,768 in magnitude for 64 components); an empty table gives an empty result;
further columns are ignored.
"""

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize

#: Components handled at once in a task.
_AT_ONCE = 2_000_000
#: A label with more than one in so many rows is joined with its total by broadcast: there are at most so many.
_HOT_LABELS = 1_000


class Slices:
    """One codebook (entries x dimensions, whole numbers), ready to be searched."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        size, width = entries.shape
        words = -(-size // 64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, 0).T)
        bits = np.zeros((size, words), np.uint64)
        bits[np.arange(size), np.arange(size) >> 6] = np.uint64(1) << (np.arange(size, dtype=np.uint64) & np.uint64(63))
        self.every = np.bitwise_or.reduce(bits, axis=0, keepdims=True)
        self.masks = np.zeros((width, size + 1, words), np.uint64)
        for d in range(width):
            self.masks[d, 1:] = np.bitwise_or.accumulate(bits[order[:, d]], axis=0)
        apart = np.array([np.sort(self._measure(entries, k).astype(float))[min(1, size - 1)] for k in range(size)])
        self.radius = int(np.sqrt(np.median(apart)) / 2) + 1

    def _measure(self, points: np.ndarray, entry: int) -> np.ndarray:
        return ((points - self.entries[entry]) ** 2).sum(1)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (points x words) of the entries that are within the radius in every dimension."""
        found = np.repeat(self.masks[0, -1:] if len(self.masks) else self.every, len(points), 0)
        for d in range(len(self.sorted)):
            low = np.searchsorted(self.sorted[d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], points[:, d] + radius, "right")
            found &= self.masks[d][high] ^ self.masks[d][low]
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the lowest of equally near ones) and its squared distance."""
        none = np.iinfo(np.int64).max
        best, index = np.full(len(points), none), np.zeros(len(points), np.int64)
        radius, left = np.full(len(points), self.radius), np.arange(len(points))
        while len(left):
            found = self.candidates(points[left], radius[left])
            best[left] = none
            for k in range(len(self.entries)):
                at = left[((found[:, k >> 6] >> np.uint64(k & 63)) & np.uint64(1)).astype(bool)]
                own = self._measure(points[at], k)
                less = own < best[at]
                best[at[less]], index[at[less]] = own[less], k
            empty, reach = best[left] == none, np.sqrt(best[left].astype(float)).astype(np.int64) + 1
            wider = np.where(empty, radius[left] * 2, reach)
            again = empty | (wider > radius[left] + 1)  # the distance rounded down is within the radius
            radius[left[again]] = wider[again]
            left = left[again]
        return index, best


class Codebooks(NamedTuple):
    entries: np.ndarray  # parts x entries x dimensions
    scale: int

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _limit(width: int) -> int:
    """Largest magnitude of a component with which a squared distance of ``width`` components fits 62 bits."""
    return int(((1 << 62) // max(width, 1)) ** 0.5) // 2 - 1


def whole_numbers(vectors: DataFrame, scale: int, width: int) -> DataFrame:
    """vec_id, label and the whole-number components (64-bit, little-endian, not yet filled up) of usable rows."""
    most = _limit(width)

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.clip(np.floor(values * scale), -most, most).astype("<i8")
            parts = [whole[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.binary())], ["vec_id", "label", "numbers"])

    return vectors.mapInArrow(run, f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, numbers binary")


def usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.coalesce(finite, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))


def _filled(rows: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, data in enumerate(rows):
        own = np.frombuffer(data, "<i8")
        out[k, : len(own)] = own
    return out


def _blocks(batch: pa.RecordBatch, column: int, width: int):
    """Slices of a batch of which no one holds more than ``_AT_ONCE`` components, with their components."""
    step = max(1, _AT_ONCE // max(width, 1))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield part, _filled(part.column(column).to_pylist(), width)


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floor of its parts' mean."""
    parts, size, dims = books.entries.shape
    sent = rows.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches):
        slices = [Slices(e) for e in sent.value]
        sums = np.zeros((parts, size, dims + 1), np.int64)
        for batch in batches:
            for _, numbers in _blocks(batch, 0, books.width):
                for p in range(parts):
                    own = numbers[:, p * dims : (p + 1) * dims]
                    index, _ = slices[p].nearest(own)
                    order = np.argsort(index, kind="stable")
                    used, starts = np.unique(index[order], return_index=True)
                    counted = np.concatenate([own, np.ones((len(own), 1), np.int64)], 1)
                    sums[p, used] += np.add.reduceat(counted[order], starts, axis=0)
        at = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums.ravel()[at], pa.int64())], ["slot", "total"])

    per_task = rows.select("numbers").mapInArrow(run, "slot long, total long")
    # at most parts x entries x (dimensions + 1) sums, whatever the number of rows
    totals = per_task.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sent.destroy()
    found = np.zeros(parts * size * (dims + 1), object)
    for r in totals:
        found[r.slot] = int(r.total)
    found = found.reshape(parts, size, dims + 1)
    entries = books.entries.copy()
    for p in range(parts):
        for k in range(size):
            if count := found[p, k, dims]:
                entries[p, k] = [int(x) // count for x in found[p, k, :dims]]
    return Codebooks(entries, books.scale)


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int, width: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    if not chosen:
        return None
    filled = _filled([bytes(r.numbers) for r in chosen], width)
    return Codebooks(np.ascontiguousarray(filled.reshape(len(chosen), parts, width // parts).transpose(1, 0, 2)), scale)


def fit(rows: DataFrame, parts: int, entries: int, scale: int, width: int, rounds: int) -> Codebooks | None:
    books = first_codebooks(rows, parts, entries, scale, width)
    for _ in range(rounds if books else 0):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code and error of whole-number rows. A code is two hex digits per part while entries fit them."""
    parts, size, dims = books.entries.shape
    digits = max(2, len(f"{size - 1:x}"))
    sent = rows.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches):
        slices = [Slices(e) for e in sent.value]
        names = np.array([f"{k:0{digits}x}" for k in range(size)], dtype=object)
        for batch in batches:
            for part, numbers in _blocks(batch, 2, books.width):
                found = [slices[p].nearest(numbers[:, p * dims : (p + 1) * dims]) for p in range(parts)]
                codes = names[found[0][0]]
                for index, _ in found[1:]:
                    codes = codes + names[index]
                error = np.sum([e for _, e in found], axis=0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes.tolist(), pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "numbers").mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """The codes with the vectors they stand for, in the column ``approximation``."""
    parts, size, dims = books.entries.shape
    digits = max(2, len(f"{size - 1:x}"))
    sent = codes.sparkSession.sparkContext.broadcast(books.entries)

    @F.pandas_udf("array<double>")
    def vectors(codes_):
        middle = (sent.value + 0.5) / books.scale
        return codes_.map(lambda c: np.concatenate([middle[p, int(c[p * digits : (p + 1) * digits], 16)] for p in range(parts)]).tolist())

    return codes.withColumn("approximation", vectors("code"))


def _with_label_error(coded: DataFrame) -> DataFrame:
    """The sum of errors over equal labels as a column; rows of common labels do not meet in one task."""
    totals = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n_rows")).withColumnRenamed("label", "total_label"))
    rows = totals.agg(F.sum("n_rows")).first()[0] or 0
    hot = totals.where(F.col("n_rows") * _HOT_LABELS > rows).drop("n_rows")
    rare = totals.where(F.col("n_rows") * _HOT_LABELS <= rows).drop("n_rows")
    same = F.col("label").eqNullSafe(F.col("total_label"))
    return coded.join(F.broadcast(hot), same).unionByName(coded.join(rare, same)).drop("total_label")


def vector_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, scale: int = 4096, rounds: int = 6) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every usable row of ``vectors``."""
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // parts) * parts
    numbers = materialize(whole_numbers(rows, scale, width))
    books = fit(numbers, parts, entries, scale, width, rounds)
    if books is None:
        nothing = numbers.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return nothing.withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    return _with_label_error(materialize(encode(numbers, books))).withColumn("codebooks_sha256", F.lit(books.digest()))


def vector_codes_sql(parts: int = 8, entries: int = 16, scale: int = 4096, rounds: int = 6) -> str:
    """For tables whose vectors have one length that ``parts`` divides."""
    own = "len(embedding) // " + str(parts)
    texts = [
        f"""WITH v AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 cut AS (SELECT vec_id, label, unnest(range({parts})) AS part, embedding FROM v),
 p AS MATERIALIZED (SELECT vec_id, label, part, list_transform(embedding[part * ({own}) + 1 : (part + 1) * ({own})],
   lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM cut),
 seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}),
 b0 AS MATERIALIZED (SELECT part, entry, c AS e FROM p JOIN seed USING (vec_id))"""
    ]
    for r in range(rounds + 1):
        texts.append(f"""a{r} AS MATERIALIZED (SELECT * FROM (SELECT p.*, entry, e,
   list_sum(list_transform(list_zip(c, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{r} USING (part))
   QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            texts.append(f"""m{r} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e
   FROM (SELECT part, entry, i, sum(x) AS s, count(*) AS n FROM (SELECT part, entry, unnest(c) AS x, unnest(range(len(c))) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL),
 b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{r}.e, b{r}.e) AS e FROM b{r} LEFT JOIN m{r} USING (part, entry))""")
    texts.append(f"""coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
 digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(e) AS x, unnest(range(len(e))) AS i FROM b{rounds}))
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded CROSS JOIN digest""")
    return ",\n ".join(texts)
