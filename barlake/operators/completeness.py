"""Landing completeness: which bars of a universe of keys did not land.

A slot is a time at which any key has a bar (a trading hour seen). Each bar takes the
number of its slot; where a key's numbers jump, bars are missing. So runs of missing
bars come from the landed bars alone, and the product of keys and slots is never
made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import POS, lead_target, with_position


def landing_gaps(bars: DataFrame, universe: DataFrame, key: str = "ticker", time: str = "event_time", **kw) -> DataFrame:
    """(key, first_missing, last_missing, n_missing): maximal runs of slots without a
    bar, for every key of ``universe`` (one column; nulls and repeats are ignored).
    A key without any bar misses all slots, a bar of a key outside the universe only
    counts as a slot. Without bars there are no slots and no gaps. ``kw`` goes to the
    series window (strategy, chunk_rows)."""
    landed = bars.select(key, time).where(F.col(key).isNotNull() & F.col(time).isNotNull()).distinct()
    members = universe.select(F.col(universe.columns[0]).alias(key)).na.drop().distinct()
    slots = with_position(landed.select(time).distinct(), [], [time]).select(F.col(time).alias("slot_time"), (F.col(POS) + 1).alias("slot"))
    n = slots.count()
    if not n:
        return landed.select(key, F.col(time).alias("first_missing"), F.col(time).alias("last_missing"), F.lit(0).cast("long").alias("n_missing"))
    # every key gets an end on both sides of the slots, so that edges are gaps like others
    have = landed.join(members, key, "left_semi").join(slots, F.col(time) == F.col("slot_time")).select(key, "slot")
    ends = members.select(key, F.explode(F.array(F.lit(0).cast("long"), F.lit(n + 1).cast("long"))).alias("slot"))
    numbered = lead_target(have.unionByName(ends), [key], ["slot"], "slot", "next_slot", **kw)
    gaps = numbered.where(F.col("next_slot") > F.col("slot") + 1).select(
        key, (F.col("slot") + 1).alias("lo"), (F.col("next_slot") - 1).alias("hi"))
    first, last = (slots.select(F.col("slot").alias(c), F.col("slot_time").alias(name)) for c, name in (("lo", "first_missing"), ("hi", "last_missing")))
    return gaps.join(first, "lo").join(last, "hi").select(key, "first_missing", "last_missing", (F.col("hi") - F.col("lo") + 1).alias("n_missing"))
