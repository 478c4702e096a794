"""Replay of interventions: what the same rules say of frames as they are and as an intervention leaves them.

Every intervention of a plan is a set of virtual frames, told apart by its id; the rules run once over all of them and over
the baseline, as one aggregation by (intervention, entity), and a full outer join gives the deltas.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ratio

#: Changes below this don't count.
LEAST = 1e-12


def virtual_frames(frames: DataFrame, plan: DataFrame, by: str, order: str, value: str, change: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """frames once for each intervention of their entity, with its columns, inside (its interval) and value as change(value,
    family, level) leaves it there. plan: intervention_id, by, family, level, start_frame, end_frame (exclusive)."""
    met = frames.join(plan, by)
    inside = (F.col(order) >= F.col("start_frame")) & (F.col(order) < F.col("end_frame"))
    return met.withColumn("inside", inside).withColumn(value, F.when(inside, change(F.col(value), F.col("family"), F.col("level"))).otherwise(F.col(value)))


def evidence(frames: DataFrame, keys: list[str], experts: dict[str, Column]) -> DataFrame:
    """keys, expert, score: what each expert (an aggregate) says of each group of frames."""
    said = frames.groupBy(*keys).agg(*[c.cast("double").alias(n) for n, c in experts.items()])
    return said.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("expert"), F.col(n).alias("score")) for n in experts])).alias("_e")).select(*keys, "_e.*")


def deltas(plan: DataFrame, baseline: DataFrame, intervened: DataFrame, by: str) -> DataFrame:
    """A row for each intervention and expert: baseline, intervened, delta (null if either is), changed, target.

    plan also has expected: the experts that its family should move. Experts of issues and bad frames ("issue:", "bad_frame:")
    say 0 where they say nothing; others are null there.
    """
    head = plan.select("intervention_id", by, "family", "level", "expected")
    before = head.join(baseline, by).select("intervention_id", "expert", F.col("score").alias("_before"))
    after = intervened.select("intervention_id", "expert", F.col("score").alias("_after"))
    hoped = head.select("intervention_id", F.explode("expected").alias("expert"))
    both = before.join(after, ["intervention_id", "expert"], "full_outer").join(hoped.distinct().withColumn("_hoped", F.lit(True)), ["intervention_id", "expert"], "full_outer")
    counted = F.col("expert").startswith("issue:") | F.col("expert").startswith("bad_frame:")
    zero = lambda c: F.when(F.col(c).isNull() & counted, 0.0).otherwise(F.col(c))
    both = both.select("intervention_id", "expert", zero("_before").alias("baseline"), zero("_after").alias("intervened"), F.coalesce("_hoped", F.lit(False)).alias("target"))
    both = both.withColumn("delta", F.col("intervened") - F.col("baseline")).withColumn("changed", F.coalesce(F.abs("delta") > LEAST, F.lit(False)))
    return head.drop("expected").join(both, "intervention_id")


def responses(found: DataFrame, by: str) -> DataFrame:
    """A row an intervention: target_hit, numbers of target and other experts that changed, and the target's response: the sum
    of |delta| / (1 + |baseline|) over the targets that changed."""
    hit, other = F.col("changed") & F.col("target"), F.col("changed") & ~F.col("target")
    return found.groupBy("intervention_id", by, "family", "level").agg(
        F.count_if(hit).alias("target_changed"), F.count_if(other).alias("other_changed"),
        F.coalesce(F.sum(F.when(hit, F.abs("delta") / (1.0 + F.abs("baseline")))), F.lit(0.0)).alias("response"),
    ).withColumn("target_hit", F.col("target_changed") > 0)


def monotonic(answered: DataFrame, by: str) -> DataFrame:
    """by, family, low, high, non_decreasing: whether the greater dose has the greater response, where both were given."""
    dose = lambda level: F.max_by(F.when(F.col("level") == level, F.col("response")), F.when(F.col("level") == level, F.col("intervention_id")))
    pairs = answered.groupBy(by, "family").agg(dose("low").alias("low"), dose("high").alias("high")).filter("low IS NOT NULL AND high IS NOT NULL")
    return pairs.withColumn("non_decreasing", F.col("high") + LEAST >= F.col("low"))


def localisation(events: DataFrame) -> DataFrame:
    """intervention_id, events, inside_events, precision (null without events), recall of the interval's frames.

    events: intervention_id, frame, start_frame, end_frame; a frame may have several."""
    inside = (F.col("frame") >= F.col("start_frame")) & (F.col("frame") < F.col("end_frame"))
    found = events.groupBy("intervention_id").agg(F.count("frame").alias("events"), F.count_if(inside).alias("inside_events"), F.count_distinct(F.when(inside, F.col("frame"))).alias("_hit"), F.max(F.col("end_frame") - F.col("start_frame")).alias("_n"))
    return found.select("intervention_id", "events", "inside_events", ratio(F.col("inside_events"), F.col("events")).alias("precision"), (F.col("_hit") / F.greatest(F.lit(1), F.col("_n"))).alias("recall"))


def by_family(answered: DataFrame, pairs: DataFrame, local: DataFrame) -> DataFrame:
    """family, interventions, target_hit_rate, mean_target_changed, mean_precision, monotonic_rate."""
    rates = answered.join(local.select("intervention_id", "precision"), "intervention_id", "left").groupBy("family").agg(
        F.count(F.lit(1)).alias("interventions"), F.avg(F.col("target_hit").cast("double")).alias("target_hit_rate"), F.avg("target_changed").alias("mean_target_changed"), F.avg("precision").alias("mean_precision"))
    steady = pairs.groupBy("family").agg(F.avg(F.col("non_decreasing").cast("double")).alias("monotonic_rate"))
    return rates.join(steady, "family", "left")
