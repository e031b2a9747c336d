"""Phrase collocation mining by set-oriented (SETM) joins of occurrence relations.

The relation of length k holds, in order of piece and position, where a frequent phrase of k
words occurs and which one. The relation of length k + 1 is a merge join of it with itself by
piece and adjacent position; its phrases are counted in groups, and the groups that are
frequent are semi-joined back before the next length. A relation is persisted in the checkpoint
folder, one row per chunk of pieces, as sorted positions (a gap ends a piece) and numbers of
phrases. Every chunk sends each of its distinct phrases once, with its count, to the fragment of
the phrase; the fragment sums them and returns the identifiers of the frequent ones. A very
common word thus costs one entry per chunk, wherever it occurs.

Words are told apart by their bytes and longer phrases by the identifiers of their first and
last k - 1 words, so all counts are exact. Scores are computed in 38-digit decimals.

Defined results: a null or empty text has no words; a language of null is ``und``; long texts
and long pieces are read whole, and a chunk ends only between documents; repeated rows count
each time; equal scores are ordered by count, then phrase; an empty table gives an empty result;
further columns are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import fragments_for, materialize, mixed, small_batches

#: A chunk is closed once it holds so many bytes of text, a fragment counts the phrases of about so many.
CHUNK_BYTES, FRAGMENT_BYTES = 16_000_000, 32_000_000
#: Parts that a language's phrases are ranked in before the parts' best are ranked together.
RANK_PARTS = 64

_BREAK = b"\n"
_TABLE = bytes(10 if chr(i) in ".,;:!?\n\v\f\r" else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
_STEP = pa.schema(
    [("fragment", pa.int32()), ("chunk", pa.int64()), ("lang", pa.string()), ("total", pa.int64()), ("at", pa.binary()), ("local", pa.binary()), ("first", pa.binary()), ("last", pa.binary()), ("counts", pa.binary())]
)
_STEP_SQL = "fragment int, chunk long, lang string, total long, at binary, local binary, first binary, last binary, counts binary"
_GROUP = pa.schema([("chunk", pa.int64()), ("local", pa.binary()), ("ids", pa.binary()), ("lang", pa.string()), ("id", pa.int64()), ("word", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("f", pa.int64())])
_GROUP_SQL = "chunk long, local binary, ids binary, lang string, id long, word string, first long, last long, f long"


def _press(values: np.ndarray | bytes) -> bytes:
    """Compressed bytes; numbers byte plane by byte plane."""
    if not isinstance(values, bytes):
        values = np.ascontiguousarray(values)
        values = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(values)


def _numbers(data: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _press_rising(values: np.ndarray) -> bytes:
    """Numbers that never fall, as steps."""
    return _press(np.diff(values, prepend=values.dtype.type(0)))


def _rising(data: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(_numbers(data, kind), dtype=kind)


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _relation(chunk: int, lang: str, total: int, at: np.ndarray, local: np.ndarray) -> dict:
    return {"chunk": chunk, "lang": lang, "total": total, "at": _press_rising(at.astype(np.uint32)), "local": _press(local.astype(np.uint32))}


def _sent(chunk: int, lang: str, to: np.ndarray, fragments: int, pack) -> list[dict]:
    """One row per fragment of a chunk's distinct phrases; ``pack`` packs the phrases with given numbers."""
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(fragments + 1))
    parts = [(f, order[cuts[f] : cuts[f + 1]]) for f in range(fragments)]
    return [{"fragment": f, "chunk": chunk, "lang": lang, "local": _press_rising(own.astype(np.uint32)), **pack(own)} for f, own in parts if len(own)]


class _Chunk:
    """Words of some documents of one language, numbered in the order of their first appearance."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b"": -2, _BREAK: -1}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_TABLE).replace(_BREAK, b" \n ").split(b" ")
        numbers = self.numbers
        try:
            own = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        except KeyError:
            for w in words:
                numbers.setdefault(w, len(numbers) - 2)
            own = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.parts += [own[own != -2], np.array([-1], np.int32)]
        self.size += len(text)

    def rows(self, chunk: int, lang: str, fragments: int) -> list[dict]:
        occurring = np.concatenate(self.parts)
        at = np.flatnonzero(occurring >= 0)
        local = occurring[at]
        words = list(self.numbers)[2:]
        counts = np.bincount(local, minlength=len(words)).astype(np.int64)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        to = ((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        return [_relation(chunk, lang, len(at), at, local)] + _sent(
            chunk, lang, to.astype(np.int64), fragments, lambda own: {"first": _press(b" ".join([words[i] for i in own])), "counts": _press(counts[own])}
        )


def word_relation(docs: DataFrame, fragments: int) -> DataFrame:
    """The relation of single words (rows without fragment) and the words to be counted."""

    def run(batches):
        open_chunks: dict[str, _Chunk] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, langs = batch.column(0).cast(pa.binary()), batch.column(1)
            for text, lang in zip(texts, langs):
                if data := text.as_py():
                    name = lang.as_py()
                    chunk = open_chunks.setdefault(name, _Chunk())
                    chunk.add(data)
                    if chunk.size >= CHUNK_BYTES:
                        yield _rows(_STEP, chunk.rows(number, name, fragments))
                        number += 1
                        del open_chunks[name]
            # many languages in one task: close the largest so that all open ones hold a bounded text
            while sum(c.size for c in open_chunks.values()) > 2 * CHUNK_BYTES:
                name = max(open_chunks, key=lambda n: open_chunks[n].size)
                yield _rows(_STEP, open_chunks.pop(name).rows(number, name, fragments))
                number += 1
        for name, chunk in open_chunks.items():
            yield _rows(_STEP, chunk.rows(number, name, fragments))
            number += 1

    return docs.select(F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).mapInArrow(run, _STEP_SQL)


def _group_words(rows: list[dict], least: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Frequent words of one language in a fragment, and for every entry sent its group and whether that is frequent."""
    numbers: dict[bytes, int] = {}
    group = []
    for r in rows:
        words = zstandard.ZstdDecompressor().decompress(r["first"]).split(b" ")
        for w in words:
            numbers.setdefault(w, len(numbers))
        group.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    group = np.concatenate(group)
    counts = np.zeros(len(numbers), np.int64)
    np.add.at(counts, group, np.concatenate([_numbers(r["counts"]) for r in rows]))
    frequent = [(i, w) for w, i in numbers.items() if counts[i] >= least]
    return [{"number": i, "word": w.decode(), "f": int(counts[i])} for i, w in frequent], group, counts >= least


def _group_pairs(rows: list[dict], least: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
    first = np.concatenate([_rising(r["first"]) for r in rows])
    last, n = (np.concatenate([_numbers(r[c]) for r in rows]) for c in ("last", "counts"))
    order = np.lexsort((last, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(last[order]) != 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    heads = order[new]
    counts = np.zeros(len(heads), np.int64)
    np.add.at(counts, group, n)
    found = np.flatnonzero(counts >= least)
    return [{"number": int(i), "first": int(first[heads[i]]), "last": int(last[heads[i]]), "f": int(counts[i])} for i in found], group, counts >= least


def group_count(step: DataFrame, least: int, words: bool) -> DataFrame:
    """Frequent phrases (rows with id) and, for every chunk, the numbers it gave them and their ids."""

    def run(table: pa.Table) -> pa.Table:
        out, first_id = [], int(table.column("fragment")[0].as_py()) << 36
        by_lang: dict[str, list[dict]] = {}
        for r in table.to_pylist():
            by_lang.setdefault(r["lang"], []).append(r)
        for lang in sorted(by_lang):
            rows = by_lang[lang]
            found, group, frequent = (_group_words if words else _group_pairs)(rows, least)
            ids = np.full(len(frequent), -1, np.int64)
            for k, g in enumerate(found):
                ids[g.pop("number")] = first_id + k
                out.append({"lang": lang, "id": first_id + k, **g})
            first_id += len(found)
            edge = 0
            for r in rows:
                local = _rising(r["local"], np.uint32)
                own = ids[group[edge : edge + len(local)]]
                edge += len(local)
                if (own >= 0).any():
                    out.append({"chunk": r["chunk"], "local": _press_rising(local[own >= 0]), "ids": _press(own[own >= 0])})
        return pa.Table.from_pylist(out, schema=_GROUP)

    return step.where("fragment is not null").select("fragment", "chunk", "lang", "local", "first", "last", "counts").groupBy("fragment").applyInArrow(run, _GROUP_SQL)


def extend(relation: DataFrame, kept: DataFrame, fragments: int) -> DataFrame:
    """Semi-join a relation with its frequent phrases, then merge-join it with itself at the next position."""

    def run(own: pa.Table, frequent: pa.Table) -> pa.Table:
        if not own.num_rows or not frequent.num_rows:
            return _STEP.empty_table()
        row = own.to_pylist()[0]
        at = _rising(row["at"], np.uint32).astype(np.int64)
        local = _numbers(row["local"], np.uint32).astype(np.int64)
        ids = np.full(int(local.max(initial=-1)) + 1, -1, np.int64)
        for r in frequent.to_pylist():
            ids[_rising(r["local"], np.uint32)] = _numbers(r["ids"])
        names = ids[local]
        at, names = at[names >= 0], names[names >= 0]
        known, place = np.unique(names, return_inverse=True)
        next_to = np.flatnonzero(np.diff(at) == 1)
        if not len(next_to):
            return _STEP.empty_table()
        pair, number, counts = np.unique(place[next_to] * len(known) + place[next_to + 1], return_inverse=True, return_counts=True)
        first, last = known[pair // len(known)], known[pair % len(known)]
        to = mixed(first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64))
        to = (((to >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)
        rows = [_relation(row["chunk"], row["lang"], 0, at[next_to], number)]
        rows += _sent(row["chunk"], row["lang"], to, fragments, lambda x: {"first": _press_rising(first[x]), "last": _press(last[x]), "counts": _press(counts[x].astype(np.int64))})
        return pa.Table.from_pylist(rows, schema=_STEP)

    left = relation.select("chunk", "lang", "at", "local").groupBy("chunk")
    return left.cogroup(kept.groupBy("chunk")).applyInArrow(run, _STEP_SQL)


def frequent_phrases(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all frequent phrases of up to ``longest`` words, and (lang, n) of all words."""
    small_batches(docs.sparkSession)
    fragments = fragments_for(docs, FRAGMENT_BYTES)
    step = materialize(word_relation(docs, fragments))
    totals = step.where("fragment is null").groupBy("lang").agg(F.sum("total").alias("n"))
    found, names = [], None
    for size in range(1, longest + 1):
        groups = materialize(group_count(step, least, size == 1))
        own = groups.where("id is not null")
        if size == 1:
            names = own.select("lang", "id", F.col("word").alias("phrase"), F.col("word").alias("end"), "f")
        else:
            before = names.select(F.col("id").alias("first"), "phrase")
            ends = names.select(F.col("id").alias("last"), "end")
            names = own.select("lang", "id", "first", "last", "f").join(before, "first").join(ends, "last")
            names = materialize(names.select("lang", "id", F.concat_ws(" ", "phrase", "end").alias("phrase"), "end", "f"))
        found.append(names.select("lang", "phrase", F.lit(size).alias("size"), "f"))
        if size == longest or names.limit(1).count() == 0:
            break
        relation, kept = step.where("fragment is null"), groups.where("chunk is not null").select("chunk", "local", "ids")
        step = materialize(extend(relation, kept, fragments))
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return phrases, totals


def cut_score() -> Column:
    """1000 a n / (l r) rounded down, of columns with these names."""
    return F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").cast("long")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, keep: int = 2000, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to ``longest`` words.

    A phrase's score is 1000 a n / (l r), rounded down, at its lowest-scoring cut. A phrase inside
    a longer one with at least ``percent`` per cent of its count is dropped. ``least`` is also the
    count below which no phrase is a candidate.
    """
    phrases, totals = frequent_phrases(docs, longest, least)
    phrases = materialize(phrases)
    words = F.split("phrase", " ")
    candidates = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    # the parts of a phrase are as frequent as it is, so both joins find a row for every cut
    cut = candidates.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("head"), joined(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail"))
    heads, tails = (phrases.select("lang", F.col("phrase").alias(p), F.col("f").alias(c)) for p, c in (("head", "l"), ("tail", "r")))
    cut = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    scored = cut.withColumn("score", cut_score()).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))

    # shorter phrases inside each longer one, with the longer one's count
    sizes = F.filter(F.sequence(F.lit(2), F.lit(longest)), lambda k: k < F.col("size"))
    inner = candidates.where("size > 2").select("lang", "size", "words", F.col("a").alias("f_longer"), F.explode(sizes).alias("k"))
    inner = inner.select("lang", "words", "f_longer", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("start"))
    inner = inner.select("lang", joined(F.col("start"), F.col("k")).alias("phrase"), "f_longer").groupBy("lang", "phrase").agg(F.max("f_longer").alias("f_longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("f_longer").isNull() | (F.col("f_longer") * 100 < F.col("best.a") * percent))
    rows = kept.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part"))
    order = "order by score desc, a desc, phrase"
    rows = rows.withColumn("rank", F.expr(f"row_number() over (partition by lang, part {order})")).where(F.col("rank") <= keep)
    rows = rows.withColumn("rank", F.expr(f"row_number() over (partition by lang {order})").cast("long")).where(F.col("rank") <= keep)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(longest: int = 5, least: int = 100, keep: int = 2000, percent: int = 100) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sizes = " UNION ALL ".join(f"SELECT lang, array_to_string(w[i:i+{k - 1}], ' ') AS phrase, {k} AS size FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})" for k in range(1, longest + 1))
    return f"""WITH split_ AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
 pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM split_),
 total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
 phrases AS (SELECT lang, phrase, size, count(*) AS f FROM ({sizes}) GROUP BY ALL HAVING count(*) >= {least}),
 candidates AS (SELECT *, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1),
 cuts AS (SELECT *, unnest(range(1, size)) AS cut FROM candidates),
 scored AS (SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, n, cut, CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
   FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:cut], ' ')
   JOIN phrases t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[cut+1:c.size], ' ') JOIN total ON total.lang = c.lang),
 lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
 inside AS (SELECT lang, array_to_string(w[s:s+k-1], ' ') AS phrase, max(a) AS longer
   FROM (SELECT *, unnest(range(1, size - k + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS k FROM candidates)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {percent} * a
QUALIFY rank <= {keep}"""
