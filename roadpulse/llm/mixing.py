"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The tree has one level per column in ``levels`` (domain, language, source). A budget of tokens
is propagated from the root: the children of a node share its budget by their weights, no child
gets more than its leaves can give (their tokens times ``max_epochs``), and what a child cannot
take goes to its siblings by their weights. Only when all siblings are full does the shortage
reach the node's own siblings, since no node is offered more than its leaves hold.

A leaf serves its budget from seeded epochs: every full epoch gives each document once, and the
last epoch gives the documents whose first token lies before the rest of the budget, in the
order of a seeded hash. That order is never sorted as a whole: documents are summed by the
first digits of their hash, then by the next ones inside the one bucket that a leaf's cut falls
into, and only the last, small bucket is ordered, by its distinct pairs of hash and size. Rows
that share the pair at which a leaf's budget ends (rows without doc_id, or copies) are counted,
and exactly as many of them are taken as still begin before its end.

Whole-number arithmetic throughout, so results do not depend on the order of sums.

Defined results: a token is a word; null and empty texts have no tokens and are never chosen;
null levels form a node named ``(none)``; a child without a listed weight gets the default;
weight 0 gives nothing; rows with equal doc_id and size are interchangeable; an empty table
gives an empty result; columns of the documents that start with ``mix_``, as the helpers and
results do, come back with ``own_`` before their names.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize


#: The hash is followed ``DIGITS`` hexadecimal digits at a time, ``DEPTH`` times.
DIGITS, DEPTH = 2, 3
#: A table of leaves up to this size is sent to all tasks; a larger one is joined by shuffle.
BROADCAST_LEAVES = 20_000

_WHOLE = "decimal(38,0)"


def words_in(text: str | Column) -> Column:
    """Number of words: places where a word begins."""
    text = F.col(text) if isinstance(text, str) else text
    begins = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), r"[\x20\x09-\x0D]+", "")
    return F.coalesce(F.length(begins), F.lit(0)).cast("long")


def name_of(expression: str) -> Column:
    return F.coalesce(F.expr(expression), F.lit("(none)"))


def weight_of(level: str, weights: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("long")


def budgets(leaves: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int, default: int = 1) -> DataFrame:
    """``leaves`` (levels, mix_supply) with ``mix_budget``: what each leaf has to give.

    ``budget`` is an expression over the one row (total). One window pass per level; windows
    hold the children of one node.
    """
    frame = leaves.withColumn("mix_capacity", F.col("mix_supply") * max_epochs)
    # capacity below every node, counting only children that have a weight
    for level in levels:
        frame = frame.withColumn(f"mix_w_{level}", weight_of(level, weights.get(level, {}), default))
    usable = F.lit(True)
    for level in levels:
        usable = usable & (F.col(f"mix_w_{level}") > 0)
    frame = frame.where(usable)
    total = leaves.agg(F.coalesce(F.sum("mix_supply"), F.lit(0)).alias("total")).select(budget.cast("long").alias("mix_budget"))
    nodes = None
    for depth, level in enumerate(levels):
        path, parent = levels[: depth + 1], levels[:depth]
        children = frame.groupBy(*path).agg(F.sum("mix_capacity").alias("mix_capacity"), F.max(f"mix_w_{level}").alias("mix_w"))
        if nodes is None:
            above = children.join(F.broadcast(total))  # one row
        else:
            above = children.join(nodes, parent)
        by_ratio = Window.partitionBy(*parent or [F.lit(0)]).orderBy(F.col("mix_capacity") / F.col("mix_w"), level)
        upto, after = by_ratio.rowsBetween(Window.unboundedPreceding, 0), by_ratio.rowsBetween(1, Window.unboundedFollowing)
        every = Window.partitionBy(*parent or [F.lit(0)])
        c, w, b = F.col("mix_capacity").cast(_WHOLE), F.col("mix_w").cast(_WHOLE), F.col("mix_budget").cast(_WHOLE)
        above = above.withColumn("mix_upto", F.sum("mix_capacity").over(upto)).withColumn("mix_after", F.coalesce(F.sum("mix_w").over(after), F.lit(0)))
        # full when raising all open siblings to this child's ratio does not use up the budget
        above = above.withColumn("mix_full", (b - F.col("mix_upto")) * w >= c * F.col("mix_after"))
        open_w = F.when(~F.col("mix_full"), F.col("mix_w")).otherwise(0)
        above = (
            above.withColumn("mix_left", F.greatest(F.col("mix_budget") - F.sum(F.when(F.col("mix_full"), F.col("mix_capacity")).otherwise(0)).over(every), F.lit(0)))
            .withColumn("mix_open", F.sum(open_w).over(every))
            .withColumn("mix_run", F.sum(open_w).over(upto))
        )
        share = F.expr(
            "CAST(CAST(mix_left AS DECIMAL(20,0)) * CAST(mix_run AS DECIMAL(15,0)) DIV mix_open AS BIGINT)"
            " - CAST(CAST(mix_left AS DECIMAL(20,0)) * CAST(mix_run - mix_w AS DECIMAL(15,0)) DIV mix_open AS BIGINT)"
        )
        nodes = above.select(*path, F.when(F.col("mix_full"), F.col("mix_capacity")).otherwise(share).alias("mix_budget"))
    return frame.select(*levels, "mix_supply").join(nodes, levels)


def mix(
    docs: DataFrame,
    levels: Mapping[str, str],
    weights: Mapping[str, Mapping[str, int]],
    share: tuple[int, int] = (1, 1),
    max_epochs: int = 1,
    seed: int = 1,
    default: int = 1,
    columns: list[str] | None = None,
) -> DataFrame:
    """The chosen rows of ``docs`` with their levels, ``mix_tokens`` and ``mix_epoch``.

    ``levels`` names the tree's levels from the root and gives their SQL expressions over
    ``docs``. The budget is ``share`` (a fraction) of all tokens. A document of an epoch is one
    row. ``columns`` are the columns of ``docs`` to return, all by default; with a few short
    ones the documents are read only once.
    """
    own = {c: f"own_{c}" for c in docs.columns if c.lower().startswith("mix_")}
    kept = [F.col(f"`{own.get(c, c)}`") for c in (docs.columns if columns is None else columns)]
    few = ["doc_id", *(F.col(f"`{own.get(c, c)}`") for c in columns or [] if c != "doc_id")]
    if own:
        # the levels are taken first: their expressions may name such columns
        at = {n: f"own_level_{k}" for k, n in enumerate(levels)}
        docs = docs.withColumns({at[n]: F.expr(e) for n, e in levels.items()}).withColumnsRenamed(own)
        levels = at
    names = [f"mix_{n}" for n in levels]
    named = {f"mix_{n}": w for n, w in weights.items()}
    marked = docs.withColumns({f"mix_{n}": name_of(e) for n, e in levels.items()} | {"mix_tokens": words_in("text")}).where("mix_tokens > 0")
    sizes = materialize(marked.select(*few, *names, "mix_tokens"))
    leaves = materialize(sizes.groupBy(*names).agg(F.sum("mix_tokens").alias("mix_supply")))
    budget = F.expr(f"total * {share[0]} DIV {share[1]}")
    given = _small(
        budgets(leaves, names, named, budget, max_epochs, default).select(
            *names, F.expr("mix_budget DIV mix_supply").alias("mix_whole"), F.expr("mix_budget % mix_supply").alias("mix_rest")
        )
    )
    text = F.concat_ws(":", F.lit(str(seed)), F.col("mix_whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    def hashed(frame: DataFrame) -> DataFrame:
        return frame.join(given, names).where("mix_whole > 0 or mix_rest > 0").withColumn("mix_hash", F.md5(text))

    # where each leaf's rest ends: the hash is followed digit group by digit group, and only the
    # rows below the place found so far are summed again
    cuts = None
    placed = hashed(sizes)
    for depth in range(DEPTH):
        below = placed.withColumns({"mix_prefix": F.lit(""), "mix_before": F.lit(0).cast("long")}) if cuts is None else placed.join(cuts, names).where("startswith(mix_hash, mix_prefix)")
        sums = below.groupBy(*names, "mix_rest", "mix_prefix", "mix_before", F.substring("mix_hash", 1 + depth * DIGITS, DIGITS).alias("mix_next")).agg(F.sum("mix_tokens").alias("mix_sum"))
        ordered = Window.partitionBy(*names).orderBy("mix_next")
        running = sums.withColumn("mix_start", F.col("mix_before") + F.sum("mix_sum").over(ordered) - F.col("mix_sum"))
        cuts = _small(
            running.where("mix_start < mix_rest and mix_rest <= mix_start + mix_sum").select(
                *names, F.concat("mix_prefix", "mix_next").alias("mix_prefix"), F.col("mix_start").alias("mix_before")
            )
        )
    within = Window.partitionBy(*names).orderBy("mix_hash", "mix_tokens").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.join(cuts, names).where("startswith(mix_hash, mix_prefix)")
    alike = inside.groupBy(*names, "mix_rest", "mix_before", "mix_hash", "mix_tokens").agg(F.count(F.lit(1)).alias("mix_count"))
    last = _small(
        alike.withColumn("mix_start", F.col("mix_before") + F.coalesce(F.sum(F.col("mix_tokens") * F.col("mix_count")).over(within), F.lit(0)))
        .where("mix_start < mix_rest")
        .withColumn("mix_take", F.expr("least(mix_count, (mix_rest - mix_start + mix_tokens - 1) DIV mix_tokens)"))
        .groupBy(*names)
        .agg(F.max(F.struct("mix_hash", "mix_tokens", "mix_count", "mix_take")).alias("mix_last"))
    )
    chosen = hashed(marked if columns is None else sizes).join(last, names, "left")
    split = F.expr("mix_hash = mix_last.mix_hash and mix_tokens = mix_last.mix_tokens and mix_last.mix_take < mix_last.mix_count")
    partly = F.struct("mix_hash", "mix_tokens") <= F.struct("mix_last.mix_hash", "mix_last.mix_tokens")
    partly = F.coalesce(F.col("mix_last").isNotNull() & partly, F.lit(False))
    if last.where("mix_last.mix_take < mix_last.mix_count").limit(1).count():
        tied = _numbered(chosen.where(split), names)
        taken = F.col("mix_number") <= F.col("mix_last.mix_take")
        parts = [(chosen.where(~F.coalesce(split, F.lit(False))), partly), (tied, taken)]
    else:
        parts = [(chosen, partly)]
    out = None
    for frame, once_more in parts:
        rows = frame.withColumn("mix_copies", (F.col("mix_whole") + F.when(once_more, 1).otherwise(0)).cast("int")).where("mix_copies > 0")
        rows = rows.select(*kept, *names, "mix_tokens", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)).alias("mix_epoch"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _numbered(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows with ``mix_number``, from 1 inside each leaf; a window holds rows of one part of the table."""
    at = materialize(rows.withColumn("mix_at", F.monotonically_increasing_id()))
    at = at.withColumn("mix_part", F.shiftright("mix_at", 33))
    sums = at.groupBy(*names, "mix_part").agg(F.count(F.lit(1)).alias("mix_sum"))
    before = Window.partitionBy(*names).orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "mix_part", F.coalesce(F.sum("mix_sum").over(before), F.lit(0)).alias("mix_offset"))
    order = F.row_number().over(Window.partitionBy(*names, "mix_part").orderBy("mix_at"))
    numbers = at.select(*names, "mix_part", "mix_at", order.alias("mix_order")).join(sums, [*names, "mix_part"])
    return at.join(numbers.select("mix_at", (F.col("mix_offset") + F.col("mix_order")).alias("mix_number")), "mix_at")


def _small(frame: DataFrame) -> DataFrame:
    """A table with a row per leaf, sent to all tasks if it is as small as expected."""
    frame = materialize(frame)
    return F.broadcast(frame) if frame.count() <= BROADCAST_LEAVES else frame
