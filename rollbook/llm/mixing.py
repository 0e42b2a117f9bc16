"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .repeats import told_apart
from .store import rows_again, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Steps of equal probability that the keys of a source are counted in before any sorting.
STEPS = 4096
#: Sources beyond this many are met by a shuffle over salted keys instead of a broadcast.
BROADCAST_SOURCES = 100_000
SALTS = 32
_SPREAD = float(1 << 52)


def exponential_key(identity: Column, weight: Column, seed: int = 0) -> Column:
    """``-ln(u) / weight`` with ``u`` in (0, 1) drawn from the identity and the seed.

    The rows with the smallest keys are a sample without replacement in which a row is drawn
    in proportion to its weight. The same identity has the same key in every run.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    uniform = (bits + F.lit(0.5)) / F.lit(_SPREAD)
    return -F.ln(uniform) / weight


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Targets for ``source, source_size`` rows, one row a source.

    Sources in code point order, null last, get ``weights`` in turn. They share ``share``
    times all sizes in proportion, but none gets over ``most`` times its own size; what that
    leaves over goes to the others by weight. Sorted by how soon a source is full, the full
    ones come first, so that running sums over this one table give the end of the resharing.
    """
    if share > most:
        raise ValueError("the share is more than all sources may give")
    turn = F.expr("row_number() over (order by source asc nulls last)") - 1
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")
    ).cast("long")
    full = F.col("source_size") * most
    ranked = sources.withColumn("turn", turn).withColumn("weight", weight)
    ranked = ranked.withColumn("full", full)
    order = "order by full / weight, turn"
    before = f"over ({order} rows between unbounded preceding and 1 preceding)"
    after = f"over ({order} rows between current row and unbounded following)"
    open_share = ranked.withColumns({
        "left": F.lit(share) * F.expr("sum(source_size) over ()")
        - F.expr(f"coalesce(sum(full) {before}, 0)"),
        "weights": F.expr(f"sum(weight) {after}"),
    })
    is_full = F.col("full") * F.col("weights") <= F.col("weight") * F.col("left")
    level = open_share.withColumn("is_full", is_full)
    left = F.expr("first(if(is_full, null, left), true) over (order by full / weight, turn "
                  "rows between unbounded preceding and unbounded following)")
    weights_left = F.expr("first(if(is_full, null, weights), true) over (order by full / weight, "
                          "turn rows between unbounded preceding and unbounded following)")
    level = level.withColumns({"level_left": left, "level_weights": weights_left})
    target = F.when(F.col("is_full"), F.col("full").cast("double")).otherwise(
        F.col("weight") * F.col("level_left") / F.col("level_weights")
    )
    return level.select("source", "source_size", target.alias("target"))


def _mixed(
    docs: DataFrame, size: Column, weight: Column, identity: Column, tie: Column, source: str,
    weights: Sequence[int], share: float, most: int, seed: int, broadcast_sources: int,
) -> DataFrame:
    """Wrapped rows with ``size, source_size, target, copies``."""
    step = F.least(
        F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * STEPS), F.lit(STEPS - 1)
    ).cast("int")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
        F.col(f"`{source}`").alias("_source"), size.cast("long").alias("_size"),
        weight.alias("_weight"), identity.cast("string").alias("_own"), tie.alias("_tie"),
    )
    # Rows without identity are told by their tie, and equal rows by a number.
    rows = told_apart(rows, F.col("_source"), F.col("_own"), F.col("_tie"))
    named = F.coalesce(F.col("_own"), F.concat(F.lit("null:"), F.coalesce(F.col("_tie").cast("string"), F.lit(""))))
    named = F.when(F.col("_number") == 0, named).otherwise(F.concat(named, F.lit("#"), F.col("_number")))
    rows = rows.withColumn("_key", exponential_key(named, F.col("_weight"), seed)).withColumn("_step", step)
    rows = rows.select("_row", "_source", "_size", "_key", "_tie", "_step")
    steps = stored(
        rows.groupBy(F.col("_source").alias("source"), F.col("_step").alias("step")).agg(
            F.sum("_size").alias("step_size")
        ),
        "mix_steps",
    )
    targets = stored(
        source_targets(
            steps.groupBy("source").agg(F.sum("step_size").alias("source_size")),
            weights, share, most,
        ),
        "mix_targets",
    )
    plan = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long")
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = F.expr("sum(step_size) over (partition by source order by step)")
    ended = steps.withColumn("until", running).join(
        plan.select(F.col("source").alias("of"), "rest"), F.col("source").eqNullSafe(F.col("of"))
    ).filter(F.col("until") > F.col("rest")).groupBy("source").agg(
        F.min(F.struct("step", (F.col("until") - F.col("step_size")).alias("before"))).alias("end")
    ).select(F.col("source").alias("of"), "end.step", "end.before")
    plan = stored(
        plan.join(ended, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("_of"), "source_size", "target",
            F.col("epochs").alias("_epochs"), F.col("rest").alias("_rest"),
            F.col("step").alias("_end"), F.col("before").alias("_before"),
        ),
        "mix_plan",
    )
    same = F.col("_source").eqNullSafe(F.col("_of"))
    if plan.count() <= broadcast_sources:
        planned = rows.join(F.broadcast(plan), same)
    else:
        salt = F.pmod(F.xxhash64("_key", "_tie"), F.lit(SALTS)).cast("int")
        spread = plan.withColumn("_lot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        planned = rows.withColumn("_salt", salt).join(
            spread, same & (F.col("_salt") == F.col("_lot"))
        )
    # Steps before the last are taken whole and steps after it not at all; a source without
    # a last step has no more than its rest, so all of it is taken.
    in_last = F.col("_end").isNotNull() & (F.col("_step") == F.col("_end"))
    plain = planned.filter(~in_last).withColumn(
        "_more", (F.col("_end").isNull() | (F.col("_step") < F.col("_end"))).cast("long")
    )
    before = F.coalesce(F.expr(
        "sum(_size) over (partition by _of order by _key, _tie "
        "rows between unbounded preceding and 1 preceding)"
    ), F.lit(0)) + F.col("_before")
    last = planned.filter(in_last).withColumn(
        "_more", (before * 2 + F.col("_size") <= F.col("_rest") * 2).cast("long")
    )
    return plain.unionByName(last).select(
        "_row", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_epochs") + F.col("_more")).alias("copies"),
    )


def mix(
    docs: DataFrame,
    *,
    size: Column,
    weight: Column,
    identity: Column,
    tie: Column,
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``: how often the mix has each row.

    A source first gives as many whole epochs as its target holds. What is left of the target
    goes to the rows with the smallest exponential keys, as long as a row's middle lies within
    it, so a source misses its target by half a row at most. ``weight`` must be above zero.

    A source is never sorted whole: its keys are counted in 4096 steps, running sums over the
    steps find the one in which the target ends, and only that step's rows are sorted.

    Null and empty texts have size 0; null is a source of its own. ``tie`` orders rows of the
    same identity and stands for one that is null; where over a thousandth of all rows are equal
    in both and in their source, each has a key of its own by a number. No rows give no rows. The added columns replace
    those of the same name; others stay.
    """
    found = _mixed(
        docs, size, weight, identity, tie, source, weights, share, most, seed, broadcast_sources
    )
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [F.col("_row").getField(n).alias(n) for n in docs.columns if n not in added]
    return found.select(
        *kept, *added[:4], (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat_mixed(
    docs: DataFrame,
    *,
    size: Column,
    weight: Column,
    identity: Column,
    tie: Column,
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` says, with its own columns."""
    found = _mixed(
        docs, size, weight, identity, tie, source, weights, share, most, seed, broadcast_sources
    )
    return rows_again(found.filter("copies > 0").select("_row", "copies"), "copies").select("_row.*")
