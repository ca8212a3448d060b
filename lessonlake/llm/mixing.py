"""Problem 8: mixing sources to target weights.

Time-varying curriculum: over training time t in [0, 1) source s has the weight
w_s(t) = w_s (1 + a_s (2 t - 1)), whose integral is its target weight; the slopes a_s sum to 0 under the
weights, so the weights sum to 1 at any time. Its token demand up to t is D_s(t) = N_s (t + a_s (t^2 - t));
a document whose middle token is the c-th of its source stands at t = D_s^-1(c). Documents are then
range-sorted by t.

The total is by default the tokens that the listed sources have, one epoch's worth. A source too small for
its share of it gives all its texts max_repeats times, and the rest is spread over the other sources by
weight, as is the weight of sources without documents; `shares` reports what is reached. With total="exact"
the total is the largest at which every source that has documents meets its target. Running sums within a
source are taken in two levels (sums of hash buckets, then within buckets of about `bucket_rows`), so a source with a
third of all rows is spread over its buckets. Unlisted sources, null sources and texts without tokens are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per bucket of a running sum; the number of buckets grows with the data.
BUCKET_ROWS = 50_000
#: How far the steepest source's weight departs from its target at either end.
STEEPNESS = 0.5


def demands(available: dict[str, int], weights: dict[str, tuple[float, int]], total: float | str | None = None) -> dict[str, float]:
    """Tokens taken from each source. available: tokens by source; weights: (target, max_repeats) by source."""
    live = {s: (w, available[s] * max(0, r)) for s, (w, r) in weights.items() if w > 0 and available.get(s, 0) > 0 and r > 0}
    if not live:
        return {}
    sum_w = sum(w for w, _ in live.values())
    if total is None:
        total = sum(available[s] for s in live)
    elif total == "exact":
        total = min(cap * sum_w / w for w, cap in live.values())
    total = min(total, sum(cap for _, cap in live.values()))
    out: dict[str, float] = {}
    rest = dict(live)
    while rest:
        left, sum_w = total - sum(out.values()), sum(w for w, _ in rest.values())
        full = [s for s, (w, cap) in rest.items() if left * w / sum_w > cap * (1 + 1e-12)]
        if not full:
            return out | {s: left * w / sum_w for s, (w, _) in rest.items()}
        for s in full:
            out[s] = float(rest.pop(s)[1])
    return out


def slopes(taken: dict[str, float], weights: dict[str, tuple[float, int]], steepness: float = STEEPNESS, schedule: dict[str, float] | None = None) -> dict[str, float]:
    """How the weight of each source changes over training; the slopes cancel under the weights.

    schedule: the wish of each source, higher for later (0 where it has none). By default sources that may be repeated
    more come later. `steepness`, below 1, is the slope of the source that changes most.
    """
    wish = {s: float(weights[s][1] if schedule is None else schedule.get(s, 0.0)) for s in taken}
    total = sum(taken.values()) or 1.0
    mean = sum(n * wish[s] for s, n in taken.items()) / total
    most = max((abs(x - mean) for x in wish.values()), default=0.0)
    return {s: steepness * (x - mean) / most if most else 0.0 for s, x in wish.items()}


def invert(y: Column, a: Column) -> Column:
    """t with t + a (t^2 - t) = y."""
    b = 1 - a
    return F.when(F.abs(a) < 1e-9, y).otherwise((F.sqrt(b * b + 4 * a * y) - b) / (2 * a))


def mix(sizes: DataFrame, weights: DataFrame, total: float | str | None = None, bucket_rows: int = BUCKET_ROWS, key: str = "doc_id", schedule: dict[str, float] | None = None, steepness: float = STEEPNESS) -> DataFrame:
    """(key, source, repeat_no, position, n_tokens), sorted by position. sizes: key, source, n_tokens.

    weights is a short fixed list of sources; per listed source one row of sums reaches the driver.
    """
    spark = sizes.sparkSession
    listed = {r["source"]: (float(r["target_weight"]), int(r["max_repeats"])) for r in weights.where("source is not null and target_weight is not null and max_repeats is not null").collect()}
    used = sizes.where("n_tokens > 0").join(F.broadcast(weights.select("source").distinct()), "source")
    sums = used.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()
    available, buckets = {r["source"]: r["n"] for r in sums}, -(-max((r["rows"] for r in sums), default=1) // bucket_rows)
    taken = demands(available, listed, total)
    slope = slopes(taken, listed, steepness, schedule)
    plan = spark.createDataFrame([(s, float(n), float(available[s]), float(slope[s])) for s, n in taken.items()], "source string, demand double, available double, a double")
    ordered = used.select(key, "source", "n_tokens", F.xxhash64(key, F.lit(11)).alias("h")).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 20), F.lit(buckets)))
    sums = ordered.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("earlier"))
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "bucket").orderBy("h", key).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = ordered.withColumn("inside", inside).join(before, ["source", "bucket"]).join(F.broadcast(plan), "source")
    passes = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("demand") / F.col("available")).cast("int") - 1, F.lit(0)))
    uses = placed.withColumn("repeat", F.explode(passes)).withColumn("middle", F.col("repeat") * F.col("available") + F.col("earlier") + F.col("inside") + F.col("n_tokens") / 2)
    chosen = uses.where("middle < demand")
    return chosen.select(key, "source", (F.col("repeat") + 1).cast("int").alias("repeat_no"), invert(F.col("middle") / F.col("demand"), F.col("a")).alias("position"), "n_tokens").orderBy("position", "source", key)


def shares(mixture: DataFrame, sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """Per listed source: target and reached share, tokens used and available, the most uses of a text."""
    used = mixture.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), F.count("*").alias("used_texts"), F.max("repeat_no").alias("most_uses"))
    have = sizes.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    out = weights.join(used, "source", "left").join(have, "source", "left").fillna(0, ["used_tokens", "used_texts", "most_uses", "available_tokens"])
    total = mixture.agg(F.sum("n_tokens")).first()[0] or 0
    return out.select("source", "target_weight", (F.col("used_tokens") / max(1, total)).alias("reached_share"), "used_tokens", "available_tokens", "used_texts", "most_uses", "max_repeats")


def checks(mixture: DataFrame, sizes: DataFrame, weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """(source, max_repeats, n_available, n_too_often, n_outside) per listed source: texts with tokens, texts used more often
    than allowed, uses placed outside the training time; the last two must be 0."""
    have = sizes.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n_available"))
    times = mixture.groupBy("source", key).agg(F.count("*").alias("uses"), F.count_if((F.col("position") < 0) | (F.col("position") >= 1)).alias("outside"))
    used = times.join(weights.select("source", "max_repeats"), "source").groupBy("source").agg(F.count_if(F.col("uses") > F.col("max_repeats")).alias("n_too_often"), F.sum("outside").alias("n_outside"))
    return weights.join(have, "source", "left").join(used, "source", "left").fillna(0, ["n_available", "n_too_often", "n_outside"]).select("source", "max_repeats", "n_available", "n_too_often", "n_outside")
