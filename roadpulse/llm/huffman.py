"""Token ids in files, coded with a canonical length-limited Huffman code from global counts.

Format: a folder of Parquet with two tables. ``code`` holds the code length of every id that
occurs; ids sorted by length and value get consecutive codes, so lengths are the whole code.
``blocks`` holds one row per block: documents in ascending order of doc_id, their sizes, the
coded bits, and the bit offset of every ``CHECKPOINT``-th id. A block is decoded without any
other, and inside it all checkpoints are decoded side by side through one look-up table.

Texts are tokenized once: ids are staged as a table, with a row per task that counts its ids (one
row per id of the vocabulary reaches the driver), dealt into ranges of doc_id, sorted and coded. The staged table is
removed when the blocks are written. Rows without doc_id come first.

Defined results: a null or empty text is the end id alone; a long text is one long block; rows
with equal doc_id follow each other, ordered by their ids; an empty table gives an empty
folder and no rows; further columns are ignored.
"""

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import shuffle_tasks, small_batches
from roadpulse.llm.tokens import encoder
from roadpulse.session import checkpoint_dir

MAX_BITS = 18
BLOCK_IDS = 65_536
CHECKPOINT = 512
#: ids of a staged text; vocabularies have fewer than 65,536 ids, else the type has to be wider.
_STAGED = "<u2"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    packages, masks = np.empty(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        masks.append(at < n)
        both = both[at]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for mask in reversed(masks):
        own = int(mask[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes of ids with given lengths, and the table that decodes them."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.uint32), lengths[order].astype(np.int64)
        steps = np.left_shift(np.int64(1), MAX_BITS - self.lengths)
        self.starts = np.cumsum(steps) - steps  # codes, aligned to MAX_BITS

    def encoding(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max(initial=0)) + 1
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.ids] = (self.starts >> (MAX_BITS - self.lengths)).astype(np.uint64)
        lengths[self.ids] = self.lengths
        return codes, lengths

    def decoding(self) -> tuple[np.ndarray, np.ndarray]:
        steps = 1 << (MAX_BITS - self.lengths)
        symbols, lengths = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
        filled = int(steps.sum())
        symbols[:filled], lengths[:filled] = np.repeat(self.ids, steps), np.repeat(self.lengths, steps)
        return symbols, lengths


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of ``ids`` and the bit offset of every checkpoint."""
    own = lengths[ids]
    ends = np.cumsum(own)
    starts = ends - own
    shift = (64 - (starts & 31) - own).astype(np.uint64)
    placed = codes[ids] << shift
    words = np.zeros((int(ends[-1]) >> 5) + 3, np.uint32)
    at = starts >> 5
    first = np.flatnonzero(np.diff(at, prepend=-1))  # codes of one word follow each other
    words[at[first]] = np.add.reduceat((placed >> np.uint64(32)).astype(np.uint32), first)
    words[at[first] + 1] += np.add.reduceat(placed.astype(np.uint32), first)
    return words.astype(">u4").tobytes(), starts[::CHECKPOINT].astype(np.int64)


def decode_blocks(blocks: list[tuple[bytes, np.ndarray, int]], symbols: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """ids of blocks (bits, checkpoints, number of ids), all checkpoints side by side."""
    if not blocks:
        return []
    data, bits, base, outs = [], [], 0, 0
    first, left, to = [], [], []
    for coded, checkpoints, n in blocks:
        data.append(np.frombuffer(coded, ">u4").astype(np.uint64))
        first.append(checkpoints + base * 32)
        at = np.arange(len(checkpoints)) * CHECKPOINT
        left.append(np.minimum(n - at, CHECKPOINT))
        to.append(at + outs)
        base += len(data[-1])
        outs += n
    words = np.concatenate([*data, np.zeros(2, np.uint64)])
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    bits, left, to = np.concatenate(first), np.concatenate(left), np.concatenate(to)
    out = np.empty(outs, np.uint32)
    order = np.argsort(-left, kind="stable")  # lanes that end early stand last
    bits, left, to = bits[order], left[order], to[order]
    for k in range(int(left[0])):
        lanes = int(np.searchsorted(-left, -k))
        bits, to = bits[:lanes], to[:lanes]
        key = (pairs[bits >> 5] >> (64 - MAX_BITS - (bits & 31)).astype(np.uint64)) & np.uint64((1 << MAX_BITS) - 1)
        out[to + k] = symbols[key]
        bits = bits + lengths[key]
    return np.split(out, np.cumsum([b[2] for b in blocks])[:-1])


def write(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", keeps_spaces: bool = False, end_id: int = 2) -> None:
    """Tokenize ``docs`` and write their ids to ``folder`` in ascending order of doc_id."""
    spark = small_batches(docs.sparkSession)
    staged_at = f"{folder}-staged"
    if len(encoder(tokenizer, keeps_spaces).edges) > 1 << 16 or end_id >= 1 << 16:
        raise ValueError("the staged ids hold 16 bits")

    def tokenize(batches):
        encode, press = encoder(tokenizer, keeps_spaces), zstandard.ZstdCompressor(level=1)
        end, counts = np.array([end_id], np.uint32), np.zeros(0, np.int64)
        names = ["doc_id", "n_tokens", "ids", "counts"]
        for batch in batches:
            ids = [np.concatenate([x, end]) for x in encode([t or "" for t in batch.column(1).to_pylist()])]
            if ids:
                own = np.bincount(np.concatenate(ids))
                if len(own) > len(counts):
                    own, counts = counts, own.astype(np.int64)
                counts[: len(own)] += own
            sizes = pa.array([len(x) for x in ids], pa.int64())
            parts = pa.array([press.compress(x.astype(_STAGED).tobytes()) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), sizes, parts, pa.nulls(len(ids), pa.binary())], names)
        if counts.any():
            told = pa.array([press.compress(counts.tobytes())], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), told], names)

    docs.select("doc_id", "text").mapInArrow(tokenize, "doc_id long, n_tokens long, ids binary, counts binary").write.parquet(staged_at)
    staged = spark.read.parquet(staged_at)

    def count(batches):
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                counts = np.frombuffer(expand.decompress(data), np.int64)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["id", "n"])

    totals = staged.where("counts is not null").select("counts").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    ids = np.array([r.id for r in totals], np.uint32)
    lengths = code_lengths(np.array([r.n for r in totals], np.int64))
    rows = [(int(i), int(n)) for i, n in zip(ids, lengths)]
    spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    sent = spark.sparkContext.broadcast((ids, lengths))

    def code(batches):
        table, expand = Code(*sent.value).encoding(), zstandard.ZstdDecompressor()
        part, waiting, held, first = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting.append((doc_id, np.frombuffer(expand.decompress(data), _STAGED)))
                held += len(waiting[-1][1])
                if held >= BLOCK_IDS:
                    yield block(part, first, waiting, table)
                    waiting, held, first = [], 0, first + held
        if waiting:
            yield block(part, first, waiting, table)

    def block(part, first, docs_, table):
        bits, checkpoints = encode_block(np.concatenate([x for _, x in docs_]), *table)
        values = [[part], [first], [[d for d, _ in docs_]], [[len(x) for _, x in docs_]], [bits], [checkpoints.tolist()]]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["part", "first", "doc_ids", "sizes", "bits", "checkpoints"])

    (
        staged.where("ids is not null")
        .select("doc_id", "ids")
        .repartitionByRange(shuffle_tasks(spark) * 2, "doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(code, "part int, first long, doc_ids array<long>, sizes array<long>, bits binary, checkpoints array<long>")
        .write.option("compression", "uncompressed")
        .parquet(f"{folder}/blocks")
    )
    path = spark._jvm.org.apache.hadoop.fs.Path(staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, with ``with_ids``, the ids of every document."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    code = [(r.id, r.bits) for r in spark.read.parquet(f"{folder}/code").collect()]
    # ids before each part: parts are as few as the tasks of the writer
    by_part = {r.part: r.n for r in blocks.select("part", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(by_part):
        before[part] = total
        total += by_part[part]
    sent = spark.sparkContext.broadcast((np.array([c[0] for c in code], np.uint32), np.array([c[1] for c in code], np.int64), before))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def decode(batches):
        ids, bits, starts = sent.value
        table = Code(ids, bits).decoding()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for i in range(0, batch.num_rows, 32):
                some = [c[i : i + 32] for c in columns]
                decoded = decode_blocks([(b, np.array(c, np.int64), sum(s)) for s, b, c in zip(some[3], some[4], some[5])], *table)
                rows = []
                for part, first, doc_ids, sizes, own in zip(*some[:4], decoded):
                    at = 0
                    for doc_id, n in zip(doc_ids, sizes):
                        ids_ = own[at : at + n]
                        rows.append((doc_id, starts[part] + first + at, n, zlib.crc32(ids_.tobytes()), ids_))
                        at += n
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                arrays = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                if with_ids:
                    arrays.append(pa.array([r[4].astype(np.int32) for r in rows], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    return blocks.select("part", "first", "doc_ids", "sizes", "bits", "checkpoints").mapInArrow(decode, schema)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
