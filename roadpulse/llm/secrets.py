"""Secret scans: fixed rules plus two character Markov models compared by log-likelihood ratio.

One model describes random strings, the other ordinary identifiers and words. A candidate (a
run of 16 or more key characters, or what a rule match leaves of one) is reported when the
random model explains it better by ``threshold`` nats, or by its share for less than 20.

Defined results: a null or empty text has no spans; long texts are scanned whole; equal rows
give equal rows; an empty table gives an empty result (the models then rest on the generated
samples alone); further columns of the input are ignored.
"""

import random
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import WORD, small_batches

# Fixed values of the contract: the three rules.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")

_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Candidates have ``SHORTEST`` characters; the threshold is that of ``FULL`` characters.
SHORTEST, FULL = 16, 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)

SPANS_TYPE = "array<struct<kind:string,start:int,end:int>>"

#: At most so many documents give labelled samples.
SAMPLE_DOCS = 2_000


class MarkovPair(NamedTuple):
    """Log probabilities of a character after another, for random strings and identifiers."""

    ratio: np.ndarray  # [128, 128] log random - log ordinary
    threshold: float

    def score(self, text: str) -> float:
        codes = np.frombuffer(("\x02" + text).encode("ascii"), np.uint8)
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def is_random(self, text: str) -> bool:
        return self.score(text) >= self.threshold * min(1.0, len(text) / FULL)


def rule_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the fixed rules as (start, end, kind), by start and then by kind as listed."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _outside(start: int, end: int, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of a run outside ``spans``, which come by their start."""
    parts = []
    for a, b, _ in spans:
        if b > start and a < end:
            parts.append((start, a))
            start = b
    return [(a, b) for a, b in [*parts, (start, end)] if a < b]


def all_spans(text: str | None, models: MarkovPair) -> list[tuple[int, int, str]]:
    """Rule spans and added spans of kind ``markov``, which never overlap a rule span."""
    if not text:
        return []
    base = rule_spans(text)
    added = []
    for m in _CANDIDATE.finditer(text):
        for start, end in _outside(*m.span(), base):
            if end - start >= SHORTEST and models.is_random(text[start:end]):
                added.append((start, end, "markov"))
    return sorted(base + added, key=lambda x: (x[0], (*KINDS, "markov").index(x[2]))) if added else base


def _generated(seed: int, number: int) -> list[str]:
    """Labelled random strings over the alphabets that keys are usually written in."""
    rng = random.Random(seed)
    alphabets = (
        "0123456789abcdef",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    )
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 48))) for i in range(number)]


def _composed(seed: int, number: int) -> list[str]:
    """Labelled identifiers: words joined in the usual styles, with numbers, dates and paths."""
    rng = random.Random(seed)
    words = (
        "user name first last order item list map value key index count total time date start end file path read write get set is has make build "
        "test data table column row page view model state event handler service client server request response config default version release"
    ).split()
    out = []
    for i in range(number):
        some = rng.choices(words, k=rng.randint(2, 6))
        style = i % 5
        if style == 0:
            text = "_".join(some) + f"_{rng.randint(0, 99)}"
        elif style == 1:
            text = "-".join([f"{rng.randint(1990, 2030)}", f"{rng.randint(1, 12):02}", f"{rng.randint(1, 28):02}", *some])
        elif style == 2:
            text = some[0] + "".join(w.title() for w in some[1:]) + str(rng.randint(1, 9))
        elif style == 3:
            text = "/".join(some) + f"/{rng.randint(1, 2000)}"
        else:
            text = "_".join(w.upper() for w in some)
        out.append(text)
    return out


def _count(strings: list[str]) -> np.ndarray:
    counts = np.zeros((128, 128))
    for s in strings:
        codes = np.frombuffer(("\x02" + s).encode("ascii", "ignore"), np.uint8)
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return counts


def labelled_samples(docs: DataFrame, max_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Pair counts of labelled strings (label, first, second, n) from at most ``max_docs`` documents.

    The documents are those with the smallest hashes; values matched by a rule are labelled
    random, all other words of eight or more characters ordinary.
    """
    small_batches(docs.sparkSession)
    keyed = docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("h"), "text")
    cut = keyed.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h").alias("cut")).first()["cut"]
    chosen = keyed.where(F.col("h") <= F.lit(cut)).dropDuplicates(["h"]).select("text")

    def pairs(batches):
        for pdf in batches:
            found = {0: [], 1: []}
            for text in pdf["text"]:
                spans = rule_spans(text)
                found[1] += [text[a:b] if kind != "assign" else ASSIGN.match(text, a)[2] for a, b, kind in spans]
                found[0] += [m[0] for m in WORD.finditer(text) if len(m[0]) >= 8 and m[0].isascii() and all(m.end() <= a or m.start() >= b for a, b, _ in spans)]
            for label, strings in found.items():
                counts = _count(strings)
                first, second = counts.nonzero()
                yield pd.DataFrame({"label": label, "first": first, "second": second, "n": counts[first, second].astype("int64")})

    counted = chosen.mapInPandas(pairs, "label int, first int, second int, n long")
    return counted.groupBy("label", "first", "second").agg(F.sum("n").alias("n"))


def fit(samples: DataFrame | None, threshold: float = 12.0, seed: int = 7) -> MarkovPair:
    """Both models from labelled pair counts (at most 2 x 128 x 128 rows) and generated samples."""
    counts = np.stack([_count(_composed(seed, 2_000)), _count(_generated(seed + 1, 4_000))])
    for row in samples.collect() if samples is not None else []:
        counts[row.label, row.first, row.second] += row.n
    # a corpus must not drown the generated samples: both parts get the same weight
    generated = np.stack([_count(_composed(seed, 2_000)), _count(_generated(seed + 1, 4_000))])
    corpus = counts - generated
    probabilities = []
    for own, known in zip(generated, corpus):
        scale = own.sum() / known.sum() if known.sum() > own.sum() else 1.0
        mixed = own + known * scale + 0.5
        probabilities.append(np.log(mixed / mixed.sum(1, keepdims=True)))
    return MarkovPair(probabilities[1] - probabilities[0], threshold)


def spans_of(text: str | Column, models: MarkovPair) -> Column:
    """All spans of a text as an array of (kind, start, end); offsets are code points."""

    @F.pandas_udf(SPANS_TYPE)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for a, b, k in all_spans(t, models)] for t in texts], dtype=object)

    return spans(text)


def find_secrets(docs: DataFrame, models: MarkovPair | None = None) -> DataFrame:
    """doc_id and spans of every document; the models are fitted on ``docs`` where none are given."""
    small_batches(docs.sparkSession)
    models = models or fit(labelled_samples(docs))
    return docs.select("doc_id", spans_of("text", models).alias("spans"))


def redact(docs: DataFrame, models: MarkovPair | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by one)."""
    small_batches(docs.sparkSession)
    models = models or fit(labelled_samples(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            spans = all_spans(text, models)
            if spans:
                parts, done = [], 0
                for a, b, _ in spans:
                    if a >= done:
                        parts += [text[done:a], mark]
                    done = max(done, b)
                text = "".join(parts) + text[done:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", clean("text"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from doc_id and spans."""
    written = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.transform(F.filter("spans", lambda s: s["kind"] != "markov"), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", written).alias("spans"),
        number("markov").alias("n_markov"),
    )
