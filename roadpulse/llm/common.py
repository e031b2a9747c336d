"""Helpers shared by the corpus operators."""

import re
import uuid

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import checkpoint_dir

#: Words are maximal runs of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Documents handed to Python at once. A batch holds so many whole texts, whatever the input size.
BATCH_ROWS = 512

_CACHE_WORDS = 400_000


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand Python few documents at a time, since a document can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table of its own in the shared checkpoint folder and read it from there.

    Unlike a checkpointed frame, the table brings no constraints of the plan it came from,
    which grow without end when a loop plans one round on the last.
    """
    at = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(docs: DataFrame, *needed: str):
    """``docs`` with all but the needed columns in one, and a function that restores the columns.

    Operators that join or add columns of their own then cannot meet the caller's.
    """
    others = [c for c in docs.columns if c not in needed]
    if not others:
        return docs, lambda frame: frame.select(*docs.columns)
    name = free_name(docs, "columns_set_aside")
    packed = docs.select(*needed, F.struct(*[docs[f"`{c}`"].alias(c) for c in others]).alias(name))
    return packed, lambda frame: frame.select(*[F.col(c) if c in needed else F.col(name).getField(c).alias(c) for c in docs.columns])


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fragments_for(docs: DataFrame, bytes_each: int) -> int:
    """How many fragments a corpus is cut into so that one holds about ``bytes_each`` of text."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-total // bytes_each))


def text_key(text: str | Column) -> Column:
    """Sixteen bytes that stand for a text: rows with equal texts share all results."""
    return F.unhex(F.md5(text))


_KEPT: dict = {}


def kept(name, make):
    """``make()``, which this worker's later tasks find again until one of them needs other tables.

    Workers outlive their stage and serve those that follow. Tables of a stage that is over would
    stay beside the tables of every later one.
    """
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


class WordHashes:
    """64-bit hashes of words (text or UTF-8), remembered up to a fixed number of words.

    What the worker has kept of other tasks goes.
    """

    def __init__(self):
        _KEPT.clear()
        self.known: dict[str | bytes, int] = {}

    def __call__(self, words: list) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE_WORDS:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass"))
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of every window of ``size`` values, by doubling."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    out, have, power = None, 0, 1
    part, width, factor = words, 1, base
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, have, power = part, width, factor
            else:
                out = out[: len(words) - have - width + 1] * np.uint64(factor) + part[have : len(words) - width + 1][: len(words) - have - width + 1]
                have, power = have + width, power * factor & (1 << 64) - 1
        rest >>= 1
        if rest:
            part = part[:-width] * np.uint64(factor) + part[width:]
            factor = factor * factor & (1 << 64) - 1
            width *= 2
    return out[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.asarray(values).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def expand(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def key_table(keys: bytes) -> tuple[list[bytes], np.ndarray]:
    """Distinct 16-byte keys in order, and the place of every given key among them."""
    values = np.frombuffer(keys, ">u8").reshape(-1, 2)
    order = np.lexsort((values[:, 1], values[:, 0]))
    ranked = values[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(1)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    table = ranked[new].tobytes()
    return [table[i : i + 16] for i in range(0, len(table), 16)], place


POSTINGS = "fragment int, keys binary, counts binary, hashes binary, places binary, checks binary"


def scattered(docs: list[tuple], fragments: int):
    """Postings of some documents, one row per fragment of the hash range.

    A document is (key, hashes) and perhaps the places of the hashes and 32 further bits of
    each. A row lists the documents that have hashes in its fragment, how many, and these
    hashes, places and further bits, document by document.
    """
    docs = [d for d in docs if len(d[1])]
    if not docs:
        return
    hashes, places, checks = ([np.concatenate(c) for c in list(zip(*docs))[1:]] + [None, None])[:3]
    owner = np.repeat(np.arange(len(docs)), [len(d[1]) for d in docs])
    to = ((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(fragments + 1))
    for f in range(fragments):
        own = order[cuts[f] : cuts[f + 1]]
        if len(own):
            counts = np.bincount(owner[own], minlength=len(docs))
            used = np.flatnonzero(counts)
            yield {
                "fragment": f,
                "keys": b"".join([docs[i][0] for i in used]),
                "counts": squeeze(counts[used]),
                "hashes": hashes[own].tobytes(),
                "places": squeeze(places[own]) if places is not None else b"",
                "checks": checks[own].astype(np.uint32).tobytes() if checks is not None else b"",
            }


def fragment_groups(batches, by: str = "fragment"):
    """Rows of a task, which come sorted by fragment (or ``by``), one fragment at a time."""
    held, current = [], None
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            if held and getattr(row, by) != current:
                yield current, held
                held = []
            current = getattr(row, by)
            held.append(row)
    if held:
        yield current, held


def gathered(rows) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order and, for each posting of a fragment, its hash, key number, place and further bits.

    A key that several tasks sent counts once.
    """
    keys, numbers = key_table(b"".join([r.keys for r in rows]))
    counts = np.concatenate([expand(r.counts) for r in rows]).astype(np.int64)
    first = np.zeros(len(numbers), bool)
    first[np.unique(numbers, return_index=True)[1]] = True
    keep = np.repeat(first, counts)
    hashes = np.frombuffer(b"".join([r.hashes for r in rows]), np.uint64)[keep]
    places = np.concatenate([expand(r.places) for r in rows])[keep] if rows[0].places else np.empty(0, np.uint32)
    checks = np.frombuffer(b"".join([r.checks for r in rows]), np.uint32)[keep] if rows[0].checks else np.empty(0, np.uint32)
    return keys, hashes, np.repeat(numbers, counts)[keep], places, checks


#: Links that one task follows at once; more are followed by rounds of joins, to the same end.
FEW_LINKS = 100_000


def _sets(batches) -> list[tuple]:
    """All nodes of some links with the smallest node of their sets."""
    parent: dict = {}

    def find(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"], pdf["b"]):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in list(parent)]


def _joined(batches):
    """Links of one task as links to the smallest node of each of its sets."""
    yield pd.DataFrame([r for r in _sets(batches) if r[0] != r[1]], columns=["a", "b"])


def _followed(batches):
    yield pd.DataFrame(_sets(batches), columns=["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, root), root the smallest node reachable.

    Each task first joins its own part of the links, which leaves one link per node and task; a
    small, counted number of them is followed to the end by one task.
    Each round then points every node to the smallest label around it, then follows the
    labels once (pointer jumping), so the rounds grow with the logarithm of a chain. A hub's
    many links meet in an aggregate with map-side combine, never in one list. Labels are
    written to the checkpoint folder each round; only a count reaches the driver.
    """
    kind = links.schema["a"].dataType.simpleString()
    links = materialize(links.select("a", "b").where("a <> b").mapInPandas(_joined, f"a {kind}, b {kind}"))
    if links.limit(FEW_LINKS + 1).count() <= FEW_LINKS:
        return materialize(links.coalesce(1).mapInPandas(_followed, f"node {kind}, root {kind}"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")))
    while True:
        around = both.join(roots, both.b == roots.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = roots.join(around, "node").select("node", F.least("root", "near").alias("next"), F.col("root").alias("old"))
        # the smallest label offered to a root's own set moves the whole set at once
        moved = hooked.groupBy(F.col("old").alias("root")).agg(F.min("next").alias("target"))
        step = hooked.join(moved, hooked.old == moved.root).select("node", "old", F.least("next", "target").alias("next"))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("further"))
        new = materialize(
            step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("further", "next")).alias("root"), (F.least("next", F.coalesce("further", "next")) != F.col("old")).alias("changed"))
        )
        roots = new.select("node", "root")
        if new.where("changed").limit(1).count() == 0:
            return roots
