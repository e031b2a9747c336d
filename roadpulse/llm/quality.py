"""Document quality by a linear-chain conditional random field over lines.

Every line has features of its own (shares of kinds of characters, word lengths, repeated words,
whether the line occurred before in its document) and those of the lines before and after it. The
field labels each line good or bad: a weight per feature, and one for each pair of neighbouring
labels. Forward-backward gives the probability that a line is good. The mean of these, weighted by
the lines' lengths, is the document's quality; a logistic curve of its log-odds, fitted on the same
documents, turns it into the probability of label 1 without changing the order of documents.

Labels exist for documents only. A line takes its document's label at first; after a first fit,
lines of bad documents that the field takes for clearly good ones change their label, and the
field is fitted again. Fitting takes at most ``MAX_ROWS`` labelled documents with the smallest id
hashes, and of these as many as have ``MAX_LINES`` lines together. Features are counted where the
texts are; the driver fits some thousand numbers per line-feature on that bounded sample, and
sends the weights.

Defined results: a null or empty text is one empty line; lines end at line feeds only; long texts
and long lines are read whole; equal texts have equal scores; of several labels of a document the
highest counts, of several texts the smallest; with no labelled row, or labels of one kind only,
the score is that label (1 without any); rows without doc_id are scored; further columns are
ignored.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches

#: Bounds of the labelled sample.
MAX_ROWS, MAX_LINES = 4_000, 60_000
#: A bad document's line that is good with more than this probability is refitted as good.
RELABEL = 0.9

# kinds of bytes; letters of other alphabets are two or more bytes of kind _OTHER
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _BAR, _MARK, _OTHER, _CONTROL = range(9)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[:32] = _CONTROL
_KIND[127] = _CONTROL
_KIND[128:] = _OTHER
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[65:91], _KIND[97:123], _KIND[48:58] = _UPPER, _LOWER, _DIGIT
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = _STOP
_KIND[[ord(c) for c in "|<>{}[]=/\\_~"]] = _BAR

#: Features of a line: nine shares of bytes, then those that ``line_features`` names, then a constant.
OWN = 22


class Model(NamedTuple):
    weights: np.ndarray  # of the features of a line, the one before and the one after
    transitions: np.ndarray  # 2 x 2, labels bad and good
    curve: tuple[float, float]  # slope and offset of the logistic curve
    constant: float | None  # a score for all documents, where there was nothing to fit


def line_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x OWN) and lengths of the lines of a text in UTF-8."""
    lines = data.split(b"\n")
    sizes = np.array([len(x) for x in lines], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    out = np.zeros((len(lines), OWN), np.float32)
    kinds = _KIND[np.frombuffer(data + b"\n", np.uint8)]
    whole = np.maximum(sizes, 1)
    for kind in range(9):
        out[:, kind] = np.add.reduceat((kinds == kind).astype(np.int32), starts) / whole
    out[:, _SPACE] -= 1 / whole  # the line feed
    # visible runs of marks: how often a letter is followed by a mark
    letter, odd = (kinds <= _LOWER) | (kinds == _OTHER), (kinds == _MARK) | (kinds == _BAR)
    turns = np.append(letter[:-1] & odd[1:], False)
    out[:, 9] = np.add.reduceat(turns.astype(np.int32), starts)
    seen: set[bytes] = set()
    known: set[bytes] = set()
    for k, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if not n:
            out[k, 20] = 1
            continue
        distinct = set(words)
        letters = sizes[k] - n + 1
        out[k, 9] /= n
        out[k, 10] = len(distinct) / n
        out[k, 11] = min(letters / n, 40.0) / 10
        out[k, 12] = len(distinct & known) / len(distinct)
        out[k, 13] = line in seen
        out[k, 14] = line[-1:] in b".!?"
        out[k, 15] = np.log1p(n) / 5
        out[k, 16] = n == 1
        out[k, 17] = n >= 8 and len(distinct) * 4 <= n
        out[k, 18] = line[:1].isupper()
        out[k, 19] = n >= 4 and sum(a == b for a, b in zip(words, words[1:])) * 2 >= n
        seen.add(line)
        known |= distinct
    out[:, OWN - 1] = 1
    return out, whole


def with_neighbours(own: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Features of lines beside those of the lines before and after; ``edges`` are the documents' bounds."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = edges[:-1], edges[1:] - 1
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after], 1)


def chains(score: np.ndarray, transitions: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many documents at once.

    ``score`` is the weight of label good at each line. Returns the probability of good per line,
    and the expected number of each pair of neighbouring labels, 2 x 2.
    """
    lengths = np.diff(edges)
    order = np.argsort(-lengths, kind="stable")
    first, lengths = edges[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    lanes = np.searchsorted(-lengths, -np.arange(steps), side="left")  # documents with a line number t
    top = np.maximum(score, 0)
    local = np.stack([np.exp(-top), np.exp(score - top)], 1)
    pair = np.exp(transitions - transitions.max())
    forward = np.empty((len(score), 2))
    for t in range(steps):
        at = first[: lanes[t]] + t
        now = local[at] if t == 0 else local[at] * (forward[at - 1] @ pair)
        forward[at] = now / now.sum(1, keepdims=True)
    backward = np.ones((len(score), 2))
    for t in range(steps - 2, -1, -1):
        at = first[: lanes[t + 1]] + t
        before = (local[at + 1] * backward[at + 1]) @ pair.T
        backward[at] = before / before.sum(1, keepdims=True)
    both = forward * backward
    both /= both.sum(1, keepdims=True)
    inner = np.ones(len(score), bool)
    inner[edges[:-1]] = False
    at = np.flatnonzero(inner)
    joint = forward[at - 1][:, :, None] * pair[None] * (local[at] * backward[at])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return both[:, 1], joint.sum(0)


def fit_lines(features: np.ndarray, labels: np.ndarray, edges: np.ndarray, weight: np.ndarray, start=None, rounds: int = 100, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by gradient steps of their own size per coordinate (Adam) on the likelihood.

    ``weight`` tells how much each document's lines count, ``start`` where to begin.
    """
    size = features.shape[1]
    parameters = np.zeros(size + 4) if start is None else np.concatenate([start[0], start[1].ravel()])
    mean, spread = np.zeros(size + 4), np.zeros(size + 4)
    inner = np.ones(len(labels), bool)
    inner[edges[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at - 1], labels[at]), 1.0)
    total = weight.sum()
    for k in range(1, rounds + 1):
        good, expected = chains(features @ parameters[:size], parameters[size:].reshape(2, 2), edges)
        step = np.concatenate([features.T @ ((good - labels) * weight) / total, ((expected - seen) / max(len(at), 1)).ravel()])
        step += decay * parameters
        mean, spread = 0.9 * mean + 0.1 * step, 0.999 * spread + 0.001 * step**2
        parameters = parameters - rate * (mean / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.999**k)) + 1e-8)
    return parameters[:size], parameters[size:].reshape(2, 2)


def labelled_lines(docs: DataFrame, labels: DataFrame, max_rows: int, max_lines: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, line features, line lengths) of labelled documents, in the order of their id hashes."""
    usable = labels.where("doc_id is not null and quality is not null").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    ids = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    own = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    # of each document its number of lines first: the sum over the rows before it bounds the sample
    counted = own.groupBy("doc_id").agg(F.min_by("text", F.coalesce("text", F.lit(""))).alias("text"), F.max("quality").alias("quality"))
    counted = counted.withColumn("lines", lines).withColumn("order", F.xxhash64("doc_id"))
    sizes = sorted((r.order, r.doc_id, r.lines) for r in counted.select("order", "doc_id", "lines").collect())
    upto = np.cumsum([s[2] for s in sizes]) if sizes else np.empty(0)
    chosen = [int(s[1]) for s, n in zip(sizes, upto) if n <= max_lines]
    if not chosen:
        return []
    picked = counted.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")), "doc_id")

    def read(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = [line_features(t or b"") for t in texts]
            columns = [pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["order", "quality", "features", "sizes"])

    got = picked.select("order", "quality", "text").mapInArrow(read, "order long, quality int, features binary, sizes binary").collect()
    return [
        (int(r.quality > 0), np.frombuffer(r.features, np.float32).reshape(-1, OWN), np.frombuffer(r.sizes, np.int64))
        for r in sorted(got, key=lambda r: (r.order, r.quality))
    ]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_lines: int = MAX_LINES) -> Model:
    small_batches(docs.sparkSession)
    rows = labelled_lines(docs, labels, max_rows, max_lines)
    kinds = {label for label, *_ in rows}
    if len(kinds) < 2:
        return Model(np.zeros(3 * OWN), np.zeros((2, 2)), (1.0, 0.0), float(next(iter(kinds), 1)))
    edges = np.concatenate([[0], np.cumsum([len(f) for _, f, _ in rows])])
    lengths = np.diff(edges)
    features = with_neighbours(np.concatenate([f for _, f, _ in rows]).astype(np.float64), edges)
    document = np.repeat([label for label, *_ in rows], lengths)
    weight = np.repeat(1 / np.sqrt(lengths), lengths)
    first = fit_lines(features, document, edges, weight)
    good, _ = chains(features @ first[0], first[1], edges)
    refined = np.where((document == 0) & (good > RELABEL), 1, document)
    weights, transitions = fit_lines(features, refined, edges, weight, first, 40)
    good, _ = chains(features @ weights, transitions, edges)
    sizes = np.concatenate([n for _, _, n in rows]).astype(float)
    return Model(weights, transitions, fit_curve(weighted(good, sizes, edges), np.array([label for label, *_ in rows])), None)


def weighted(good: np.ndarray, sizes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Log-odds of each document's mean over its lines."""
    mean = np.add.reduceat(good * sizes, edges[:-1]) / np.add.reduceat(sizes, edges[:-1])
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def fit_curve(odds: np.ndarray, labels: np.ndarray, rounds: int = 30, decay: float = 1.0) -> tuple[float, float]:
    """Slope (not negative) and offset by Newton's method; ``decay`` keeps them finite where labels are apart."""
    x = np.stack([odds, np.ones(len(odds))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - labels) + decay * (at - [1.0, 0.0])
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + decay * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, slope), -1, 1)
    return max(float(at[0]), 1e-3), float(at[1])


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    found = [line_features(t) for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(n) for _, n in found])])
    own = np.concatenate([f for f, _ in found]).astype(np.float64)
    good, _ = chains(with_neighbours(own, edges) @ model.weights, model.transitions, edges)
    odds = weighted(good, np.concatenate([n for _, n in found]).astype(float), edges)
    return 1 / (1 + np.exp(-np.clip(model.curve[0] * odds + model.curve[1], -30, 30)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents with the length-weighted probability of good lines as a further column."""
    small_batches(docs.sparkSession)
    if model.constant is not None:
        return docs.withColumn(name, F.lit(model.constant))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        return pd.Series(np.concatenate([scores(data[i : i + 128], sent.value) for i in range(0, len(data), 128)]) if data else np.empty(0))

    return docs.withColumn(name, quality("text"))
