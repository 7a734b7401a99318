"""Mixing sources to target weights.

Capped water-filling gives each source its part of the total: sources whose part
exceeds what their cap on repetitions allows are clamped and the excess is spread
over the others in proportion to their targets until nothing exceeds.  Each
source's whole repetitions take all its records; the fractional one takes the
records with the smallest seeded hashes up to its size, goes on past the record
that does not fit, and fills what is left with the largest records that do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.session import materialise

#: hash ranges per source in which sizes are summed to find where the fractional repetition ends
RANGES = 4096
#: records of a source kept per size class (a quarter of a power of two) to fill what the draw leaves
FILLERS = 16


def source_name(column):
    """Case and surrounding blanks do not matter."""
    return F.lower(F.trim(column))


def water_fill(sizes: dict[str, float], targets: dict[str, tuple[float, float]], total: float | None = None) -> dict[str, float]:
    """Size each source contributes.

    ``targets``: source -> (share, most repetitions).  Shares are taken relative
    to their sum.  With ``total``, clamped sources give their most, their excess
    goes to the others, and the result falls short of ``total`` only if all are
    clamped.  Without it every share is to hold exactly, so the excess cannot go to
    others: starting from all that repetitions allow, the total sinks to what the
    tightest of the clamped sources supports.  Sources without records give 0 and their share goes
    to the others.
    """
    caps = {s: sizes.get(s, 0) * max(0.0, repeats) for s, (_, repeats) in targets.items()}
    live = {s: share for s, (share, _) in targets.items() if share > 0 and caps[s] > 0}
    out = dict.fromkeys(targets, 0.0)
    if not live:
        return out
    weight = sum(live.values())
    if total is None:
        total = sum(caps[s] for s in live)
        clamped = [s for s, share in live.items() if total * share / weight > caps[s]]
        total = min([total, *[caps[s] * weight / live[s] for s in clamped]])
    rest = float(total)
    while live:
        weight = sum(live.values())
        over = [s for s, share in live.items() if rest * share / weight >= caps[s] * (1 + 1e-12)]
        if not over:
            out |= {s: min(caps[s], rest * share / weight) for s, share in live.items()}
            break
        for s in over:
            out[s] = caps[s]
            rest -= caps[s]
            del live[s]
        rest = max(rest, 0.0)
    return out


def mix(records: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", size: str = "n_tokens", share: str = "target_share", repeats: str = "max_repeats", total: float | str | None = None, seed: int = 0, max_sources: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``(selection, report)``.

    ``selection``: key, source (lower case, trimmed), tokens, n_copies >= 1 for
    every selected record.  ``report``: per target source available, wanted and
    actual tokens and shares, records, repetitions and whether it was clamped.
    ``total`` is the size of the mixture, "available" for that of all records of
    the target sources, None for the greatest with which every share holds
    exactly.  A source misses its size by less than the smallest record the
    fractional repetition leaves out, as far as its ``FILLERS`` allow.  Records with
    a null source, one without target, or a null or zero size are not selected.
    Repeated target rows are an error; a null share counts 0, null repetitions 1.

    Targets are a table of sources, bounded by ``max_sources`` (checked); records
    are summed in the cluster to one row per source and hash range, and at most
    those of one source's last range, ``1 / RANGES`` of it, meet in one task.
    """
    spark = records.sparkSession
    wanted = targets.select(source_name(F.col(source)).alias("s"), F.coalesce(F.col(share), F.lit(0.0)).alias("w"), F.coalesce(F.col(repeats), F.lit(1)).alias("r")).filter(F.col("s").isNotNull()).distinct().limit(max_sources + 1).collect()
    if len(wanted) > max_sources or len({r.s for r in wanted}) != len(wanted):
        raise ValueError("targets: too many sources, or one source twice")
    goal = {r.s: (float(r.w), float(r.r)) for r in wanted}
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40))
    rows = records.select(F.col(key).alias("k"), source_name(F.col(source)).alias("s"), F.col(size).cast("bigint").alias("t"), draw.alias("u")).filter((F.col("t") > 0) & F.col("s").isNotNull())
    targets_df = spark.createDataFrame([(s,) for s in goal], "s string")
    # written once, so that a record keeps its number
    rows = materialise(rows.join(targets_df, "s", "left_semi").withColumn("range", F.shiftright("u", 40 - 12).cast("int")).withColumn("row", F.monotonically_increasing_id()), "mix")
    sums = rows.groupBy("s", "range").agg(F.sum("t").alias("t"))
    have = {r.s: r.t for r in sums.groupBy("s").agg(F.sum("t").alias("t")).collect()}
    give = water_fill(have, goal, float(sum(have.values())) if total == "available" else total)
    plan = []
    for s in goal:
        whole, part = (int(give[s] // have[s]), give[s] % have[s]) if have.get(s) else (0, 0.0)
        full = bool(have.get(s)) and give[s] >= have[s] * int(goal[s][1])
        if full:
            whole, part = int(goal[s][1]), 0.0
        plan.append((s, goal[s][0], float(give[s]), int(have.get(s, 0)), whole, float(part), full))
    plan_df = spark.createDataFrame(plan, "s string, target_share double, wanted double, available bigint, whole int, part double, clamped boolean")
    # where each source's fractional repetition ends: sums over at most RANGES rows per source
    before = F.expr("coalesce(sum(t) OVER (PARTITION BY s ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    cut = (
        sums.withColumn("before", before).join(plan_df.select("s", "part"), "s")
        .filter((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("t")))
        .select("s", F.col("range").alias("cut"), (F.col("part") - F.col("before")).alias("left"))
    )
    placed = rows.join(plan_df.select("s", "whole"), "s").join(cut, "s", "left")
    clear = placed.filter(~F.col("range").eqNullSafe(F.col("cut"))).withColumn("extra", F.when(F.col("range") < F.col("cut"), 1).otherwise(0))
    edge = placed.filter(F.col("range") == F.col("cut")).withColumn("run", F.expr("sum(t) OVER (PARTITION BY s ORDER BY u, k, t, row)"))
    edge = edge.withColumn("extra", F.when(F.col("run") <= F.col("left"), 1).otherwise(0)).drop("run")
    drawn = materialise(clear.unionByName(edge).select("k", "s", "t", "u", "row", "whole", "extra"), "drawn")
    chosen = drawn.join(_fillers(drawn, plan_df), "row", "left").withColumn("n_copies", F.col("whole") + F.col("extra") + F.coalesce("fill", F.lit(0))).filter(F.col("n_copies") > 0)
    selection = chosen.select(F.col("k").alias(key), F.col("s").alias(source), F.col("t").alias("tokens"), "n_copies")
    per = selection.groupBy(source).agg(F.sum(F.col("tokens") * F.col("n_copies")).alias("actual_tokens"), F.count("*").alias("n_records"), F.max("n_copies").alias("most_copies"))
    everything = per.agg(F.sum("actual_tokens").alias("all_tokens"))
    report = plan_df.withColumnRenamed("s", source).join(per, source, "left").crossJoin(everything).select(
        source, "target_share", F.col("available").alias("available_tokens"), F.col("wanted").alias("wanted_tokens"),
        F.coalesce("actual_tokens", F.lit(0)).alias("actual_tokens"), F.coalesce(F.col("actual_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "clamped",
    )
    return selection, report


def _fillers(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """(row, fill = 1) of the records that fill what the draw left of each source's fractional repetition.

    Of every source and size class the ``FILLERS`` records of the smallest hashes
    are kept, one per sixteenth of the hashes, a bounded number however large the
    source; of these the largest that fit are taken in turn.
    """
    taken = drawn.groupBy("s").agg(F.sum(F.col("t") * F.col("extra")).alias("taken"))
    gap = plan.filter(F.col("part") > 0).join(taken, "s").select("s", F.floor(F.col("part") - F.col("taken") + 1e-6).alias("gap"))
    spare = drawn.filter("extra = 0").join(F.broadcast(gap), "s").filter((F.col("t") <= F.col("gap")))
    size_class = F.floor(F.log2("t") * 4)
    kept = spare.groupBy("s", "gap", size_class.alias("class"), (F.col("u") % FILLERS).alias("slot")).agg(F.min(F.struct("u", "t", "row")).alias("r"))
    lists = kept.groupBy("s", "gap").agg(F.sort_array(F.collect_list(F.struct(F.col("r.t").alias("t"), F.col("r.u").alias("u"), F.col("r.row").alias("row"))), asc=False).alias("spare"))
    state = "aggregate(spare, struct(gap AS gap, cast(array() AS array<bigint>) AS rows), (a, x) -> IF(x.t <= a.gap, struct(a.gap - x.t AS gap, array_append(a.rows, x.row) AS rows), a))"
    return lists.select(F.explode(F.expr(state).getField("rows")).alias("row"), F.lit(1).alias("fill"))
