"""Folds, samples, permutations and bootstraps. Every draw is a hash of keys, so no result depends on partitions."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import key_hash
from ..session import stored
from .metrics import ranking_metrics
from .ordered import HASH_BITS, exact_quantiles, hash_positions, hash_sample, range_count, range_edges


# Task functions travel with their helpers, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sums per score and class that a task keeps before it writes them.
HELD_SUMS = 16_384
# Draws that one task makes, and rows hashed at once.
TASK_DRAWS, HASHED_ROWS = 4_000_000, 1024


def stratified_sample(df: DataFrame, share: float, target: str, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """round(share * n) rows of each class without replacement; all rows when the share is 1 or more."""
    if share >= 1.0:
        return df
    return hash_sample(df, keys, seed, F.rint(F.col("n_total") * F.lit(share)), by=[target])


def group_folds(
    df: DataFrame, group: str, folds: int = 5, target: str | None = None, seed: int = 42, strata: int = 10
) -> DataFrame:
    """Adds `fold`: whole groups per fold. With a target, groups are dealt inside bands of their positive rate."""
    return df.join(group_fold_table(df, group, folds, target, seed, strata), group)


def group_fold_table(
    df: DataFrame, group: str, folds: int = 5, target: str | None = None, seed: int = 42, strata: int = 10
) -> DataFrame:
    rate = F.avg(F.col(target).cast("double")) if target else F.lit(0.0)
    groups = df.dropna(subset=[group]).groupBy(group).agg(rate.alias("rate"))
    band = F.least(F.lit(strata - 1), F.floor(F.coalesce("rate", F.lit(0.0)) * strata)).cast("int")
    placed = hash_positions(groups.withColumn("band", band), [group], seed, by=["band"])
    # Starting at the band's number keeps the remainders of the bands from all landing in the first fold.
    return placed.select(group, ((F.col("position") + F.col("band")) % folds).cast("int").alias("fold"))


def shuffled(
    df: DataFrame, value: str, keys: Sequence[str], by: Sequence[str] = (), seed: int = 42, name: str = "shuffled"
) -> DataFrame:
    """Permutes one column over all rows or inside each group: rows in one hash order take the values of another."""
    by = list(by)
    receivers = hash_positions(df, keys, f"{seed}r", by)
    givers = hash_positions(df.select(*by, *keys, value), keys, f"{seed}g", by).select(*by, "position", F.col(value).alias(name))
    return receivers.join(givers, [*by, "position"]).drop("position")


def cluster_draws(df: DataFrame, group: str, resamples: int, seed: int = 42) -> DataFrame:
    """(group, rep, times): how often each group comes up when as many groups as there are are drawn with replacement."""
    groups = hash_positions(df.select(group).dropna().distinct(), [group], seed, name="slot", size="n_groups")
    reps = groups.select("slot", "n_groups", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("rep"))
    picked = (key_hash(["rep", "slot"], seed) % F.col("n_groups")).alias("picked")
    times = reps.select("rep", picked).groupBy("rep", "picked").agg(F.count("*").alias("times"))
    return groups.select(group, F.col("slot").alias("picked")).join(times, "picked").drop("picked")


def _interval(values: DataFrame, value: str, level: float) -> DataFrame:
    tail = (1.0 - level) / 2.0
    return exact_quantiles(values, value, {"low": tail, "high": 1.0 - tail})


def _named_slots(rows: DataFrame, resamples: int) -> DataFrame:
    """(slot, reps): rows hold the slot that each resample picks; tasks turn that around and send one row per slot they
    name, with the packed numbers of the resamples that name it, not one row per draw."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.asarray(batch.column(0).flatten())
            rep = np.tile(np.arange(resamples, dtype="<u4"), batch.num_rows)
            order = np.argsort(slot, kind="stable")
            slot, rep = slot[order], rep[order]
            edges = np.flatnonzero(np.diff(slot, prepend=-1))
            parts = [rep[a:b].tobytes() for a, b in zip(edges, [*edges[1:], len(rep)])]
            yield pa.RecordBatch.from_arrays([pa.array(slot[edges], pa.int64()), pa.array(parts, pa.binary())], names=["slot", "reps"])

    return rows.mapInArrow(turn, "slot bigint, reps binary")


def _picked_slots(rows: DataFrame, resamples: int, seed: int) -> DataFrame:
    """(picked): the slot that each resample picks for each row (slot, n), by the hash of `key_hash`."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = [f"{seed}|{r}|".encode() for r in range(resamples)]
        for batch in batches:
            for at in range(0, batch.num_rows, HASHED_ROWS):
                part = batch.slice(at, HASHED_ROWS)
                slots = [str(s).encode() for s in part.column(0).to_pylist()]
                digests = b"".join([md5(head + slot, usedforsecurity=False).digest() for slot in slots for head in heads])
                picked = (np.frombuffer(digests, ">u8")[::2].astype(np.int64) >> 4 & (1 << HASH_BITS) - 1).reshape(-1, resamples) % np.asarray(part.column(1))[:, None]
                offsets = np.arange(0, picked.size + 1, resamples, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, picked.ravel())], names=["picked"])

    return rows.mapInArrow(pick, "picked array<bigint>")


def multiplicities(df: DataFrame, group: str, resamples: int, seed: int = 42) -> DataFrame:
    """(group, times): per group, packed unsigned 32-bit counts of how often each resample draws it.

    The draws are those of `cluster_draws`.
    """
    groups = hash_positions(df.select(group).dropna().distinct(), [group], seed, name="slot", size="n_groups")
    reps = F.sequence(F.lit(0), F.lit(resamples - 1))
    picked = F.transform(reps, lambda r: key_hash([r, F.col("slot")], seed) % F.col("n_groups"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.bincount(np.frombuffer(b"".join(parts), "<u4"), minlength=resamples).astype("<u4").tobytes() for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["slot", "times"])

    times = _named_slots(groups.select(picked.alias("picked")), resamples).groupBy("slot").agg(F.collect_list("reps").alias("reps")).mapInArrow(count, "slot bigint, times binary")
    return groups.select(group, "slot").join(times, "slot").drop("slot")


def _weighed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the positives and of the negatives of each row of (which, s, y, w, times), per resample."""
    times = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<u4").reshape(batch.num_rows, -1).astype(float)
    weight = times * np.asarray(batch.column(3))[:, None]
    positive = (np.asarray(batch.column(2)) == 1)[:, None]
    return np.where(positive, weight, 0.0), np.where(positive, 0.0, weight)


def _resampled_auc(drawn: DataFrame, resamples: int) -> DataFrame:
    """(which, rep, value): the rows of a task collapse to arrays per score, scores are ordered in ranges, and every range
    gives its pairs won, inside it, and its weights; the ranges before it do the rest."""
    packed = "which string, s double, sums binary"

    def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One row per score and class."""
        score, positive, sums = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((positive, score))
        score, positive = score[order], positive[order]
        first = np.flatnonzero(np.r_[True, (np.diff(score) != 0) | (positive[1:] != positive[:-1])])
        return score[first], positive[first], np.add.reduceat(sums[order], first, axis=0)

    def written(name: str, score: np.ndarray, positive: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        values, at = np.unique(score, return_inverse=True)
        both = np.zeros((len(values), 2, resamples))
        both[at, np.where(positive, 0, 1)] = sums
        return pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values), pa.array([r.tobytes() for r in both], pa.binary())], names=["which", "s", "sums"])

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}  # what a task has summed so far, bounded
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                times = np.frombuffer(b"".join(part.column(4).to_pylist()), "<u4").reshape(part.num_rows, resamples)
                weight = times * np.asarray(part.column(3))[:, None]
                coded, score, positive = part.column(0).dictionary_encode(), np.asarray(part.column(1)), np.asarray(part.column(2)) == 1
                codes = np.asarray(coded.indices)
                for k, name in enumerate(coded.dictionary.to_pylist()):
                    of = np.flatnonzero(codes == k)
                    parts = held.setdefault(name, [])
                    parts.append(merged([(score[of], positive[of], weight[of])]))
                    if sum(len(p[0]) for p in parts) > HELD_SUMS:
                        parts[:] = [merged(parts)]
                        if len(parts[0][0]) > HELD_SUMS // 2:
                            yield written(name, *parts.pop())
        for name, parts in held.items():
            if parts:
                yield written(name, *merged(parts))

    def won(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {}  # per score set: won, positives, negatives, and the open score with its weights
        place = 0

        def close(state: list) -> None:
            _, pos, neg = state[3]
            state[0] += pos * (state[2] + neg / 2)
            state[1] += pos
            state[2] += neg

        for batch in batches:
            for which, s, sums, place in zip(*(c.to_pylist() for c in batch.columns)):
                pos, neg = np.frombuffer(sums).reshape(2, -1)
                state = out.setdefault(which, [np.zeros(resamples), np.zeros(resamples), np.zeros(resamples), None])
                if state[3] is not None and state[3][0] == s:
                    state[3] = (s, state[3][1] + pos, state[3][2] + neg)
                    continue
                if state[3] is not None:
                    close(state)
                state[3] = (s, pos, neg)
        for state in out.values():
            close(state)
        rows = [(w, place, np.concatenate(st[:3]).tobytes()) for w, st in out.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.binary()))], names=["which", "place", "sums"])

    def together(key, table):
        table = table.sort_by("place")
        total, pos, neg = np.zeros(resamples), np.zeros(resamples), np.zeros(resamples)
        for sums in table["sums"].to_pylist():
            w, p, n = np.frombuffer(sums).reshape(3, -1)
            total, pos, neg = total + w + p * neg, pos + p, neg + n
        known = pos * neg > 0
        value = np.where(known, total / np.where(known, pos * neg, 1.0), np.nan)
        return pa.table({"which": pa.array([key[0].as_py()] * resamples), "rep": pa.array(np.arange(resamples), pa.int32()), "value": pa.array(value, mask=~known)})

    # Stored, as cutting the scores into ranges reads them twice.
    sums = stored(drawn.mapInArrow(collapse, packed), "score-sums")
    ordered = sums.repartitionByRange("which", "s").sortWithinPartitions("which", "s").withColumn("place", F.spark_partition_id())
    ranges = ordered.mapInArrow(won, "which string, place int, sums binary")
    return ranges.groupBy("which").applyInArrow(together, "which string, rep int, value double")


def resampled_metric(
    df: DataFrame, y: str, score: str, group: str, metric: str, resamples: int,
    weight: str | None = None, seed: int = 42, extra: Sequence[str] = (),
) -> DataFrame:
    """Metric per resample. Rows first collapse to weights per (group, score), then take the group's multiplicities: one
    packed vector for all resamples, so no row is copied per resample. Average precision and KS, whose terms depend on
    all totals, take one row per resample that draws the group."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    known = df.dropna(subset=[y, score, group])
    compact = known.groupBy(*extra, group, score, y).agg(F.sum(w).alias("w"))
    by = [*extra, "rep"]
    if metric in ("auc", "brier") and len(extra) <= 1:
        which = F.col(extra[0]).cast("string") if extra else F.lit("")
        met = compact.join(multiplicities(known, group, resamples, seed), group)
        drawn = met.select(which.alias("which"), F.col(score).cast("double").alias("s"), F.col(y).cast("int").alias("y"), "w", "times")
        found = (_resampled_auc if metric == "auc" else _resampled_brier)(drawn, resamples)
        return found.withColumnRenamed("which", extra[0]) if extra else found.drop("which")
    drawn = compact.join(cluster_draws(known, group, resamples, seed), group).withColumn("w", F.col("w") * F.col("times"))
    out = ranking_metrics(drawn, y, score, "w", by, names=(metric,), edges=range_edges(known, score))
    return out.withColumnRenamed(metric, "value")


def _resampled_brier(drawn: DataFrame, resamples: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                pos, neg = _weighed(part)
                gap = np.asarray(part.column(1)) - np.asarray(part.column(2))
                which = np.array(part.column(0).to_pylist(), object)
                for name in dict.fromkeys(which):
                    of = which == name
                    sums = np.stack([((pos + neg)[of] * (gap[of] ** 2)[:, None]).sum(axis=0), (pos + neg)[of].sum(axis=0)])
                    total[name] = total.get(name, 0.0) + sums
        rows = [(name, int(r), float(v[0, r]), float(v[1, r])) for name, v in total.items() for r in range(resamples)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.float64(), pa.float64()))], names=["which", "rep", "e", "w"])

    summed = drawn.mapInArrow(add, "which string, rep int, e double, w double").groupBy("which", "rep").agg(F.sum("e").alias("e"), F.sum("w").alias("w"))
    return summed.filter("w > 0").select("which", "rep", (F.col("e") / F.col("w")).alias("value"))


def point_metric(df: DataFrame, y: str, score: str, metric: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    from .metrics import brier

    if metric == "brier":
        return brier(df, y, score, weight, by).withColumnRenamed("brier", "value")
    return ranking_metrics(df, y, score, weight, by, names=(metric,)).withColumnRenamed(metric, "value")


def cluster_bootstrap(
    df: DataFrame, y: str, score: str, group: str, metric: str = "auc", resamples: int = 200,
    weight: str | None = None, seed: int = 42, level: float = 0.95,
) -> DataFrame:
    """Estimate, quantile interval and deviation of a metric when whole groups are resampled."""
    # One row per resample, stored: interval and deviation must not run the resamples again.
    values = stored(resampled_metric(df, y, score, group, metric, resamples, weight, seed), "resamples")
    ends = _interval(values, "value", level)
    spread = values.agg(F.stddev_samp("value")).scalar()
    estimate = point_metric(df.dropna(subset=[group]), y, score, metric, weight).select("value").scalar()
    return ends.select(
        estimate.alias("estimate"), "low", "high", spread.alias("deviation"), F.lit(resamples).alias("resamples")
    )


def paired_bootstrap(
    df: DataFrame, y: str, score_a: str, score_b: str, group: str, metric: str = "auc", resamples: int = 200,
    weight: str | None = None, seed: int = 42, level: float = 0.95,
) -> DataFrame:
    """Interval of metric(a) - metric(b) with the same draws for both scores."""
    cells = F.array(
        F.struct(F.lit("a").alias("which"), F.col(score_a).cast("double").alias("s")),
        F.struct(F.lit("b").alias("which"), F.col(score_b).cast("double").alias("s")),
    )
    both = df.select(y, group, *([weight] if weight else []), F.explode(cells).alias("c")).select(
        y, group, *([weight] if weight else []), "c.*"
    )
    values = stored(resampled_metric(both, y, "s", group, metric, resamples, weight, seed, extra=["which"]), "resamples")
    signed = F.when(F.col("which") == "a", F.col("value")).otherwise(-F.col("value"))
    ends = _interval(values.groupBy("rep").agg(F.sum(signed).alias("d")), "d", level)
    points = point_metric(both.dropna(subset=[group]), y, "s", metric, weight, ["which"])
    pair = points.agg(
        F.max(F.when(F.col("which") == "a", F.col("value"))).alias("metric_a"),
        F.max(F.when(F.col("which") == "b", F.col("value"))).alias("metric_b"),
    )
    a, b = pair.select("metric_a").scalar(), pair.select("metric_b").scalar()
    return ends.select(
        a.alias("metric_a"), b.alias("metric_b"), (a - b).alias("difference"), "low", "high", F.lit(resamples).alias("resamples")
    )


def residual_thresholds(residuals: DataFrame, residual: str, keys: Sequence[str], resamples: int, seed: int = 42) -> DataFrame:
    """Per resample of the residuals its ceil(n/2)-th smallest value.

    A unit's risk reaches one half in a resample exactly when that value is at or below the unit's slack. Values are cut
    into ranges; the draws of each range are counted per resample, which tells in which range a resample's middle lies,
    and only draws of that range are looked at one by one. What is shuffled is a packed list of slots per range of slots
    and task, then counts per range and resample.
    """
    placed = hash_positions(residuals.select(*keys, F.col(residual).cast("double").alias("v")), keys, seed, name="slot", size="n")
    placed = stored(placed, "placed")
    edges = np.array(range_edges(placed, "v"))
    n_ranges = len(edges) + 1
    # Draws are many times the rows: rows are dealt so that a task makes a bounded number of draws.
    tasks = max(range_count(residuals.sparkSession), math.ceil(placed.count() * resamples / TASK_DRAWS))
    named = _named_slots(_picked_slots(placed.select("slot", "n").repartition(tasks), resamples, seed), resamples)
    # Spark takes the size of `named` for that of its input and would send it whole to every task: both sides are shuffled.
    drawn = stored(named.hint("merge").join(placed.filter("v is not null").select("slot", "v"), "slot").select("v", "reps"), "drawn")

    def spots(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Range, resample and value of every draw of a batch."""
        reps = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").astype(np.int64)
        times = np.asarray(pc.binary_length(batch.column(1))) // 4
        v = np.asarray(batch.column(0))
        return np.repeat(np.searchsorted(edges, v, side="right"), times), reps, np.repeat(v, times)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_ranges, resamples), np.int64)
        for batch in batches:
            if batch.num_rows:
                r, rep, _ = spots(batch)
                total += np.bincount(r * resamples + rep, minlength=total.size).reshape(total.shape)
        r, rep = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(rep, pa.int32()), pa.array(total[r, rep])], names=["range", "rep", "n"])

    # Stored, as the middles are read twice.
    counts = stored(drawn.mapInArrow(count, "range int, rep int, n bigint").groupBy("range", "rep").agg(F.sum("n").alias("n")), "draw-counts")
    of = Window.partitionBy("rep")  # one row per range
    cum = counts.withColumn("upto", F.sum("n").over(of.orderBy("range"))).withColumn("middle", F.ceil(F.sum("n").over(of) / 2.0))
    middles = cum.filter("upto - n < middle and middle <= upto").select("rep", "range", (F.col("middle") - F.col("upto") + F.col("n")).alias("at"))
    opened = np.full(resamples, -1)
    for row in middles.select("rep", "range").collect():  # one row per resample
        opened[row["rep"]] = row["range"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                r, rep, v = spots(batch)
                here = np.flatnonzero(opened[rep] == r)
                rep, v = rep[here], v[here]
                order = np.lexsort((v, rep))
                rep, v = rep[order], v[order]
                first = np.flatnonzero(np.r_[True, (np.diff(rep) != 0) | (np.diff(v) != 0)][: len(rep)])
                n = np.diff(np.r_[first, len(rep)])
                yield pa.RecordBatch.from_arrays([pa.array(rep[first].astype(np.int32)), pa.array(v[first]), pa.array(n.astype(np.int64))], names=["rep", "v", "m"])

    inside = drawn.mapInArrow(pick, "rep int, v double, m bigint").groupBy("rep", "v").agg(F.sum("m").alias("m"))
    ordered = Window.partitionBy("rep").orderBy("v")  # the draws of one range
    placed_in = inside.withColumn("upto", F.sum("m").over(ordered)).join(middles.select("rep", "at"), "rep")
    return placed_in.filter("upto - m < at and at <= upto").select("rep", F.col("v").alias("threshold"))


def list_stability(
    units: DataFrame, prediction: str, target: str, residuals: DataFrame, residual: str,
    residual_keys: Sequence[str], keys: Sequence[str], resamples: int = 500, seed: int = 42,
) -> DataFrame:
    """Share of residual resamples in which each unit's risk is at least one half, and its class.

    core: at least 0.95; out: at most 0.05; fringe between.
    """
    from .metrics import risk_of_missing

    thresholds = stored(residual_thresholds(residuals, residual, residual_keys, resamples, seed), "thresholds")
    shares = risk_of_missing(units, prediction, target, thresholds, "threshold", keys, name="share")
    label = F.when(F.col("share") >= 0.95, "core").when(F.col("share") <= 0.05, "out").when(F.col("share").isNotNull(), "fringe")
    return shares.withColumn("class", label)


def residual_smear(residuals: DataFrame, residual: str, half_width: float, steps: int = 21) -> DataFrame:
    """Every residual plus each of `steps` equally spaced shifts in [-half_width, half_width]."""
    shifts = [-half_width + 2.0 * half_width * i / (steps - 1) for i in range(steps)]
    return residuals.withColumn("shift", F.explode(F.array(*[F.lit(s) for s in shifts]))).withColumn(
        residual, F.col(residual) + F.col("shift")
    )
