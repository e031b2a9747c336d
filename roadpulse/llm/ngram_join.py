"""Exact n-gram Jaccard join by vertical partitioning.

Every document is a set of hashed word n-grams. The global order of n-grams (by hash) is cut
into fragments; a task holds one fragment of all documents, counts partial overlaps of pairs
there, and the counts are summed per pair. Documents with equal sets are one node.

First each fragment returns which n-grams it has met more than once. Sets that share too few for
any link are done; only the others (a tenth of the n-grams of the check tables) go on.

A member of a group is not counted with every other one. Per round, a member of an n-gram's
group is counted only with a few centres of other components (the smallest members under a
seeded order), so the work is linear in the postings. A sum is a lower bound of the overlap: where
it reaches the threshold the link is certain, and its components are contracted. After each round,
a document stays only if enough of its n-grams are shared with other components to allow any
further link, and n-grams whose members are all of one component drop out.

What is then left open is counted by prefixes. The n-grams that a set shares with other components
are ordered from rare to common; two sets that link must share one among the first few of each
(those without which the rest cannot reach the threshold), be of like size, each no larger than
what the other shares allows, and have enough in common when n-grams are counted by a hash.
Fragments count these for each pair, counts are summed per pair, and the pairs found are checked over the sets'
whole shared n-grams, the likeliest of every document first: once two components are one, pairs
between them need no check. So no link between components is lost. Links within a component are
not listed.

Hashes have 64 bits; sets are told apart by 128 bits.

Defined results: words are lower-cased in A-Z only; a text with fewer words than ``n`` is one
n-gram; a null text, or one without words, has an empty set and links with nothing; long texts
are read whole; repeated rows share a component; rows without doc_id take part, and a
component's id is its smallest id; an empty table gives an empty result; further columns are
ignored.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import POSTINGS, WordHashes, components, expand, fragment_groups, fragments_for, gathered, materialize, mixed, scattered, set_aside, small_batches, squeeze, text_key, window_hashes

#: Text, and n-grams of linkable sets, in a fragment.
FRAGMENT_BYTES = 8_000_000
#: N-grams that a batch of documents sends at once.
PACK = 1 << 19
ROUNDS = 4
#: Centres of one group that a member is counted with in a round.
CENTRES = 8

_BASE = 0x9E3779B97F4A7C15
#: Counts of a set's n-grams by a hash; pairs of a fragment that are held until they are judged by these.
BINS, HELD_PAIRS = 128, 2_000_000
_PAIRS = "a binary, b binary, shared long"
#: Rounds in which only the likeliest pairs of every set are checked, and how many; the next round checks all that are left.
BEST_ROUNDS, BEST = 3, 4


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams."""
    words = hashes(text.encode("utf-8", "surrogatepass").lower().split()) if text else np.empty(0, np.uint64)
    if 0 < len(words) < n:
        return mixed(window_hashes(words, len(words), _BASE) + np.uint64(len(words)))
    return np.unique(mixed(window_hashes(words, n, _BASE)))


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.md5(hashes.tobytes()).digest()


def _split_keys(keys: bytes) -> list[bytes]:
    return [keys[i : i + 16] for i in range(0, len(keys), 16)]


_POSTINGS = "fragment int, batch binary, sent int, keys binary, counts binary, hashes binary, often binary"
_TOLD = "text_key binary, key binary, n long, sent boolean, elements binary, often binary"


def told_sets(docs: DataFrame, n: int, percent: int, fragments: int) -> DataFrame:
    """text_key, key and n of every text with words, and the n-grams of those that may link.

    Postings go to the fragments in batches of documents, without the documents' keys. A fragment
    returns the n-grams that it has met more than once, and how often. Where these are enough for a
    link, ``elements`` holds them in ascending order and ``often`` their numbers. Rows whose set was
    told by their task before are not ``sent``.
    """

    def packed(held, again, task: str):
        sizes = np.array([len(s) for _, _, s in held], np.int64)
        names = b"".join([name + key for name, key, _ in [*held, *again]])
        batch = hashlib.md5(task.encode() + names).digest()
        rows = [(-1 - int.from_bytes(batch[:4]) % fragments, batch, len(held), names, squeeze(np.append(sizes, [m for _, _, m in again])), b"", b"")]
        if held:
            hashes, owner = np.concatenate([s for _, _, s in held]), np.repeat(np.arange(len(held)), sizes)
            to = ((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(fragments + 1))
            for f in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[f] : cuts[f + 1]]
                rows.append((f, batch, 0, b"", squeeze(np.bincount(owner[own], minlength=len(held))), hashes[own].tobytes(), b""))
        return pd.DataFrame(rows, columns=["fragment", "batch", "sent", "keys", "counts", "hashes", "often"])

    def postings(batches):
        hashes, seen = WordHashes(), set()
        task, number, held, again, many = TaskContext.get().partitionId(), 0, [], [], 0
        for pdf in batches:
            for t in pdf["text"]:
                name = hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest()
                if name in seen:
                    continue
                seen.add(name)
                own = shingles(t, n, hashes)
                if not len(own):
                    continue
                key = _key(own)
                if key in seen:
                    again.append((name, key, len(own)))
                    continue
                seen.add(key)
                held.append((name, key, own))
                many += len(own)
                if many >= PACK:
                    yield packed(held, again, f"{task}:{number}:")
                    number, held, again, many = number + 1, [], [], 0
            if len(seen) > 200_000:
                seen.clear()
        if held or again:
            yield packed(held, again, f"{task}:{number}:")

    def returned(batches):
        for fragment, rows in fragment_groups(batches):
            if fragment < 0:
                yield pd.DataFrame(rows)
                continue
            own = [np.frombuffer(r.hashes, np.uint64) for r in rows]
            hashes = np.concatenate(own)
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            sizes = np.diff(np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1], [True]])))
            often = np.empty(len(hashes), np.uint32)
            often[order] = np.repeat(sizes, sizes)
            out, cuts = [], np.cumsum([0, *map(len, own)])
            for r, h, i in zip(rows, own, cuts.tolist()):
                times = often[i : i + len(h)]
                keep = times > 1
                if keep.any():
                    counts = expand(r.counts)
                    left = np.bincount(np.repeat(np.arange(len(counts)), counts)[keep], minlength=len(counts))
                    out.append((fragment, r.batch, 0, b"", squeeze(left), h[keep].tobytes(), squeeze(times[keep])))
            if out:
                yield pd.DataFrame(out, columns=["fragment", "batch", "sent", "keys", "counts", "hashes", "often"])

    def whole(batches):
        for _, rows in fragment_groups(batches, "batch"):
            told = next(r for r in rows if r.keys)
            keys, sizes, parts = _split_keys(told.keys), expand(told.counts).astype(np.int64), [r for r in rows if not r.keys]
            owner = np.concatenate([np.empty(0, np.int64), *[np.repeat(np.arange(told.sent), expand(r.counts)) for r in parts]])
            hashes = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r.hashes, np.uint64) for r in parts]])
            often = np.concatenate([np.empty(0, np.uint32), *[expand(r.often) for r in parts]])
            shared = np.bincount(owner, minlength=len(sizes))
            able = np.flatnonzero((shared > 0) & (shared * 100 >= percent * sizes))
            order = np.lexsort((hashes, owner))
            hashes, often, cuts = hashes[order], often[order], np.cumsum([0, *shared.tolist()])
            elements, times = [b""] * len(sizes), [b""] * len(sizes)
            for i in able:
                elements[i], times[i] = hashes[cuts[i] : cuts[i + 1]].tobytes(), squeeze(often[cuts[i] : cuts[i + 1]])
            yield pd.DataFrame({"text_key": keys[::2], "key": keys[1::2], "n": sizes, "sent": np.arange(len(sizes)) < told.sent, "elements": elements, "often": times})

    return (
        docs.select("text")
        .mapInPandas(postings, _POSTINGS)
        .repartition(fragments, "fragment")
        .sortWithinPartitions("fragment")
        .mapInPandas(returned, _POSTINGS)
        .repartition(fragments, "batch")
        .sortWithinPartitions("batch")
        .mapInPandas(whole, _TOLD)
    )


def set_of_text(told: DataFrame) -> DataFrame:
    """text_key, the key of its set and the set's size, for every distinct text with words."""
    return told.groupBy("text_key").agg(F.max(F.struct("key", "n")).alias("own")).select("text_key", "own.*")


def linkable(told: DataFrame, percent: int) -> DataFrame:
    """The sets (key, n, elements) that share enough n-grams with different sets to link with any.

    A set that was sent so many times has met each n-gram as often itself.
    """

    def others(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                own = np.frombuffer(r.elements, np.uint64)[expand(r.often) > r.times]
                if len(own) and len(own) * 100 >= percent * r.n:
                    rows.append((r.key, r.n, own.tobytes()))
            yield pd.DataFrame(rows, columns=["key", "n", "elements"])

    # rows of a key are equal; those that were not sent have no elements
    some = told.where("length(elements) > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("elements").alias("elements"), F.first("often").alias("often"), F.count("*").alias("times"))
    return some.mapInPandas(others, "key binary, n long, elements binary")


_GROUPS = "fragment int, keys binary, sizes binary, members binary"


def shared_groups(sets: DataFrame, fragments: int) -> DataFrame:
    """Per fragment: the n-grams that several sets have, as group sizes and member numbers."""

    def postings(batches):
        for pdf in batches:
            rows = list(scattered([(k, np.frombuffer(e, np.uint64)) for k, e in zip(pdf["key"], pdf["elements"])], fragments))
            if rows:
                yield pd.DataFrame(rows)

    def group(batches):
        for fragment, rows in fragment_groups(batches):
            keys, hashes, owner, _, _ = gathered(rows)
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            edges = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1], [True]]))
            sizes = np.diff(edges)
            keep = np.repeat(sizes > 1, sizes)
            sizes, owner = sizes[sizes > 1], owner[keep]
            used, numbers = np.unique(owner, return_inverse=True)
            if len(used):
                yield pd.DataFrame({"fragment": [fragment], "keys": [b"".join([keys[i] for i in used])], "sizes": [squeeze(sizes)], "members": [squeeze(numbers)]})

    return (
        sets.select("key", "elements")
        .mapInPandas(postings, POSTINGS)
        .repartition(fragments, "fragment")
        .sortWithinPartitions("fragment")
        .mapInPandas(group, _GROUPS)
    )


def _open_groups(row, nodes: dict[bytes, bytes] | None):
    """Groups of a fragment that hold two components: keys, component numbers, members, starts, sizes."""
    keys = _split_keys(row.keys)
    sizes, at = expand(row.sizes).astype(np.int64), expand(row.members).astype(np.int64)
    if nodes is None:
        label = np.arange(len(keys))
    else:
        names = {name: i for i, name in enumerate(sorted(set(nodes.values())))}
        label = np.array([names[nodes[k]] if k in nodes else -1 for k in keys], np.int64)
    group = np.repeat(np.arange(len(sizes)), sizes)
    keep = label[at] >= 0
    at, group = at[keep], group[keep]
    none = np.empty(0, np.int64)
    if not len(at):
        return keys, label, at, none, none
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    several = np.minimum.reduceat(label[at], starts) != np.maximum.reduceat(label[at], starts)
    at, sizes = at[np.repeat(several, sizes)], sizes[several]
    return keys, label, at, np.cumsum(sizes) - sizes, sizes


def _star_counts(row, nodes, seed: int) -> pd.DataFrame:
    """Shared n-grams of each member with its groups' centres (a, b) and with any other component (a, null)."""
    keys, label, at, starts, sizes = _open_groups(row, nodes)
    if not len(starts):
        return pd.DataFrame({"a": [], "b": [], "shared": []})
    own = np.bincount(at, minlength=len(keys))
    rank = np.empty(len(keys), np.int64)
    first = np.frombuffer(b"".join(k[:8] for k in keys), ">u8").astype(np.uint64)
    order = np.argsort(mixed(first + np.uint64(seed * 2 + 1)), kind="stable")
    rank[order] = np.arange(len(keys))
    ranks = rank[at]
    best = np.minimum.reduceat(ranks, starts)
    best_label = label[order[best]]
    # members of the centre's own component take the smallest of another one
    inside = label[at] == np.repeat(best_label, sizes)
    second = np.minimum.reduceat(np.where(inside, len(keys), ranks), starts)
    centre = order[np.where(inside, np.repeat(second, sizes), np.repeat(best, sizes))]
    found = [at * len(keys) + centre]
    # further centres of large groups, each counted with the members of other components
    ranked = at[np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))]
    for c in range(1, min(CENTRES, int(sizes.max()))):
        wide = sizes > c
        further = np.repeat(ranked[(starts + c)[wide]], sizes[wide])
        inside_wide = np.repeat(wide, sizes)
        near = at[inside_wide]
        apart = (label[near] != label[further]) & (further != centre[inside_wide])  # counted above
        found.append(near[apart] * len(keys) + further[apart])
    pair, counts = np.unique(np.concatenate(found), return_counts=True)
    a, b = pair // len(keys), pair % len(keys)
    likely = counts * 2 >= own[a]
    a, b, counts = a[likely], b[likely], counts[likely]
    present = np.flatnonzero(own)
    return pd.DataFrame(
        {"a": [keys[i] for i in a] + [keys[i] for i in present], "b": [keys[i] for i in b] + [None] * len(present), "shared": np.concatenate([counts, own[present]])}
    )


def _with_nodes(groups: DataFrame, nodes: DataFrame, run, schema: str) -> DataFrame:
    """``run(row, labels of open sets by key)`` for every fragment."""

    def present(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield pd.DataFrame({"fragment": row.fragment, "key": _split_keys(row.keys)})

    where = groups.select("fragment", "keys").mapInPandas(present, "fragment int, key binary").join(nodes.select("key", "label"), "key")

    def together(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = dict(zip(right["key"], right["label"]))
        return pd.concat([run(row, known) for row in left.itertuples(index=False)])

    return groups.groupBy("fragment").cogroup(where.groupBy("fragment")).applyInPandas(together, schema)


def _count(groups: DataFrame, nodes: DataFrame | None, seed: int) -> DataFrame:
    """Sums over all fragments of one round's partial counts."""
    if nodes is None:

        def alone(batches):
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    yield _star_counts(row, None, seed)

        partial = groups.mapInPandas(alone, _PAIRS)
    else:
        partial = _with_nodes(groups, nodes, lambda row, known: _star_counts(row, known, seed), _PAIRS)
    return partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def open_sets(groups: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The open sets of ``nodes`` (key, label, n): their n-grams that other components have, and which are the prefix.

    ``elements`` names them in ascending order; ``prefix`` holds those of the prefix, the rarest;
    ``most`` is the size of the largest set that they are enough for; ``bins`` counts them by a
    hash, so that the smaller counts of two sets together bound what these can share.
    """

    def own(row, known):
        keys, _, at, _, sizes = _open_groups(row, known)
        element = (np.int64(row.fragment) << 32) + np.repeat(np.arange(len(sizes)), sizes)
        often = np.repeat(sizes, sizes).astype(np.int64)
        order = np.argsort(at, kind="stable")
        used, starts = np.unique(at[order], return_index=True)
        cuts = [*starts.tolist(), len(order)]
        element, often = element[order], often[order]
        rows = [(keys[k], element[i:j].tobytes(), often[i:j].tobytes()) for k, i, j in zip(used, cuts, cuts[1:])]
        return pd.DataFrame(rows, columns=["key", "elements", "often"])

    parts = _with_nodes(groups, nodes, own, "key binary, elements binary, often binary")
    whole = parts.groupBy("key").agg(F.collect_list(F.struct("elements", "often")).alias("parts")).join(nodes, "key")

    def ordered(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                element = np.frombuffer(b"".join(p["elements"] for p in r.parts), np.int64)
                often = np.frombuffer(b"".join(p["often"] for p in r.parts), np.int64)
                first = len(element) + (percent * r.n) // -100 + 1  # all but what the threshold needs, and one
                if first > 0:
                    rank = np.lexsort((element, often))[:first]
                    most = len(element) * (100 + percent) // percent - r.n
                    bins = np.bincount((mixed(element.view(np.uint64)) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
                    rows.append((r.key, r.label, r.n, most, np.sort(element).tobytes(), np.sort(element[rank]).tobytes(), bins.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["key", "label", "n", "most", "elements", "prefix", "bins"])

    return whole.select("key", "label", "n", "parts").mapInPandas(ordered, "key binary, label binary, n long, most long, elements binary, prefix binary, bins binary")


def candidates(sets: DataFrame, percent: int, fragments: int) -> DataFrame:
    """Pairs (a, b) of different components that share prefix n-grams and may reach the threshold, with their number."""

    def scattered_prefix(batches):
        for pdf in batches:
            prefix = [np.frombuffer(p, np.int64) for p in pdf["prefix"]]
            owner, element = np.repeat(np.arange(len(prefix)), [len(p) for p in prefix]), np.concatenate([np.empty(0, np.int64), *prefix])
            part = element % fragments
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(fragments + 1))
            keys, labels, sizes, most = (pdf[c].to_numpy() for c in ("key", "label", "n", "most"))
            bins = np.frombuffer(b"".join(pdf["bins"]), "<u4").reshape(-1, BINS)
            rows = []
            for f in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[f] : cuts[f + 1]]
                used, counts = np.unique(owner[own], return_counts=True)
                rows.append((f, b"".join(keys[used]), b"".join(labels[used]), sizes[used].tobytes(), most[used].tobytes(), squeeze(bins[used].ravel()), counts.tobytes(), element[own].tobytes()))
            yield pd.DataFrame(rows, columns=["fragment", "keys", "labels", "sizes", "most", "bins", "counts", "elements"])

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        size, most, counts, element = (np.frombuffer(b"".join(pdf[c]), np.int64) for c in ("sizes", "most", "counts", "elements"))
        bins = np.concatenate([expand(b) for b in pdf["bins"]]).reshape(-1, BINS)
        keys = np.array(_split_keys(b"".join(pdf["keys"])), dtype=object)
        label = np.unique(np.array(_split_keys(b"".join(pdf["labels"])), dtype=object), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(keys)), counts)

        def likely(found):
            code, shared = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            keep = np.empty(len(code), bool)
            for i in range(0, len(code), 20_000):
                one, two = code[i : i + 20_000] // len(keys), code[i : i + 20_000] % len(keys)
                both = np.minimum(bins[one], bins[two]).sum(1).astype(np.int64)
                keep[i : i + 20_000] = both * (100 + percent) >= percent * (size[one] + size[two])
            return code[keep], shared[keep]

        # inside a group from small to large, so that a member meets only the next ones of like size
        order = np.lexsort((size[owner], element))
        owner, element = owner[order], element[order]
        found, kept, many, step = [], [], 0, 1
        left = np.arange(len(owner) - 1)
        while len(left):
            left = left[left + step < len(owner)]
            a, b = owner[left], owner[left + step]
            near = element[left] == element[left + step]
            near &= (size[a] * 100 >= percent * size[b]) & (size[b] <= most[a])
            left, a, b = left[near], a[near], b[near]
            apart = (label[a] != label[b]) & (size[a] <= most[b])
            found.append(np.minimum(a, b)[apart] * len(keys) + np.maximum(a, b)[apart])
            many += len(found[-1])
            if many > HELD_PAIRS:
                kept.append(likely(found))
                found, many = [], 0
            step += 1
        kept.append(likely(found))
        code, at = np.unique(np.concatenate([c for c, _ in kept]), return_inverse=True)
        shared = np.bincount(at, np.concatenate([n for _, n in kept]), len(code)).astype(np.int64)
        one, two = keys[code // len(keys)], keys[code % len(keys)]
        return pd.DataFrame({"a": np.where(one < two, one, two), "b": np.where(one < two, two, one), "shared": shared})

    split = sets.select("key", "label", "n", "most", "prefix", "bins").mapInPandas(
        scattered_prefix, "fragment int, keys binary, labels binary, sizes binary, most binary, bins binary, counts binary, elements binary"
    )
    partial = split.groupBy("fragment").applyInPandas(pairs, _PAIRS)
    return partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold, counted over all n-grams they can share."""
    sides = [sets.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("elements").alias(f"in_{s}")) for s in "ab"]

    def run(batches):
        for pdf in batches:
            keep = []
            for r in pdf.itertuples(index=False):
                both = len(np.intersect1d(np.frombuffer(r.in_a, np.int64), np.frombuffer(r.in_b, np.int64), assume_unique=True))
                keep.append(both * 100 >= percent * (r.n_a + r.n_b - both))
            yield pdf.loc[keep, ["a", "b"]]

    return pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b").mapInPandas(run, "a binary, b binary")


def contracted(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, root) after new links; only the links between labels are followed."""
    if roots is None:
        return components(links)
    named = links
    for side in "ab":
        own = roots.select(F.col("node").alias(side), F.col("root").alias("name"))
        named = named.join(own, side, "left").withColumn(side, F.coalesce("name", side)).drop("name")
    moved = components(named.distinct()).select("node", F.col("root").alias("target"))
    old = roots.join(moved.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("target", "root").alias("root"))
    fresh = moved.join(roots, "node", "left_anti").select("node", F.col("target").alias("root"))
    return materialize(old.unionByName(fresh))


def _labelled(frame: DataFrame, roots: DataFrame | None, key: str, name: str) -> DataFrame:
    if roots is None:
        return frame.withColumn(name, F.col(key))
    own = roots.select(F.col("node").alias(key), F.col("root").alias("found"))
    return frame.join(own, key, "left").withColumn(name, F.coalesce("found", key)).drop("found")


def residual_links(groups: DataFrame, nodes: DataFrame, roots: DataFrame | None, percent: int, fragments: int) -> DataFrame | None:
    """Labels after all links that are left between the open sets ``nodes`` (key, label, n)."""
    sets = materialize(open_sets(groups, nodes, percent))
    pairs = materialize(candidates(sets, percent, fragments))
    for number in range(BEST_ROUNDS + 1):
        if pairs.limit(1).count() == 0:
            break
        now, later = pairs, None
        if number < BEST_ROUNDS:
            # max_by keeps one pair per bucket and set: a few likely ones of every set, without a window
            bucket = F.pmod(F.xxhash64("b", F.lit(number)), F.lit(BEST))
            best = pairs.groupBy("a", bucket.alias("bucket")).agg(F.max_by("b", F.struct("shared", "b")).alias("b")).select("a", "b")
            now, later = best, pairs.join(best, ["a", "b"], "left_anti")
        found = materialize(checked(now, sets, percent))
        if found.limit(1).count():
            roots = contracted(roots, found)
        if later is None:
            break
        if roots is not None:
            later = _labelled(_labelled(later, roots, "a", "label_a"), roots, "b", "label_b").where("label_a <> label_b").drop("label_a", "label_b")
        pairs = materialize(later)
    return roots


def set_components(groups: DataFrame, sets: DataFrame, percent: int, fragments: int) -> DataFrame | None:
    """The root of each linked set of ``sets`` (key, n), where there are links."""
    sizes = sets.select("key", "n")

    def certain(counts: DataFrame) -> DataFrame:
        pairs = counts.where("b is not null")
        sized = pairs.join(sizes.select(F.col("key").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("key").alias("b"), F.col("n").alias("n_b")), "b")
        return sized.where(F.col("shared") * 100 >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")

    roots, nodes = None, None
    for seed in range(ROUNDS):
        counts = materialize(_count(groups, nodes, seed))
        able = counts.where("b is null").join(sizes.withColumnRenamed("key", "a"), "a").where(F.col("shared") * 100 >= F.lit(percent) * F.col("n")).select(F.col("a").alias("key"), "n")
        found = materialize(certain(counts))
        more = found.limit(1).count() > 0
        if more:
            roots = contracted(roots, found)
        nodes = materialize(_labelled(able, roots, "key", "label"))
        if not more or nodes.limit(1).count() == 0:
            break
    if nodes.limit(1).count():
        roots = residual_links(groups, nodes, roots, percent, fragments)
    return roots


def _joined(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, text_key, key, n) and the roots of linked sets."""
    told = materialize(told_sets(docs, n, percent, fragments_for(docs, FRAGMENT_BYTES)))
    rows = docs.select("doc_id", text_key(F.coalesce("text", F.lit(""))).alias("text_key")).join(set_of_text(told), "text_key", "left")
    rows = materialize(rows.select("doc_id", "text_key", "key", F.coalesce("n", F.lit(0).cast("long")).alias("n")))
    sets = materialize(linkable(told, percent))
    fragments = max(8, -(-(sets.select(F.sum(F.octet_length("elements"))).first()[0] or 0) // FRAGMENT_BYTES))
    groups = materialize(shared_groups(sets, fragments))
    return rows, set_components(groups, sets, percent, fragments)


def join_components(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, roots = _joined(docs, n, percent)
    per_set = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("head"))
    per_set = materialize(_labelled(per_set, roots, "key", "root"))
    if roots is None:
        per_set = per_set.select("key", F.col("head").alias("least"))
    else:
        least = per_set.groupBy("root").agg(F.min("head").alias("least"))
        per_set = per_set.join(least, "root").select("key", "least")
    return rows.join(per_set, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def drop_duplicates(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """The documents without near duplicates: one row of each component stays.

    It is the row with the smallest doc_id (rows without one come last), of these the one with
    the smallest hash of its text. Rows without words are linked with nothing and all stay.
    """
    small_batches(docs.sparkSession)
    docs, restored = set_aside(docs, "doc_id", "text")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.where(worded).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, roots = _joined(own, n, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
    per_set = rows.groupBy("key").agg(first)
    if roots is not None:
        per_set = per_set.join(roots.withColumnRenamed("node", "key"), "key", "left").groupBy(F.coalesce("root", "key").alias("key")).agg(F.min("first").alias("first"))
    kept = materialize(per_set.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")))
    keyed = docs.where(worded).withColumn("near_key", text_key("text"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("near_key") == F.col("kept_key"))
    # rows that repeat both id and text are told apart by nothing: one of them stays
    repeated = rows.groupBy(F.col("doc_id").alias("row_id"), F.col("text_key").alias("row_key")).count().where("count > 1")
    own_row = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_key") == F.col("kept_key"))
    again = materialize(kept.join(repeated, own_row, "left_semi"))
    out = docs.where(~worded)
    if again.limit(1).count():
        out = out.unionByName(keyed.join(again, same).dropDuplicates(["kept_id", "kept_key"]).select(*docs.columns))
        kept = kept.join(repeated, own_row, "left_anti")
    return restored(out.unionByName(keyed.join(kept, same).select(*docs.columns)))
