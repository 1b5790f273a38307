"""Ordered sums, ranks and quantiles that never sort a whole table, or a whole group, in one task.

A window with an order but no partition moves all rows to one task, and a window per group does the
same for a group that holds a third of the rows. Every operator here cuts the order into ranges (by
value, or by the leading bits of a hash), orders inside each range, and adds the totals of the ranges
before it. The table of range totals has at most `ranges` rows per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import key_hash

RANGE = "__range"
# Below this many rows an exact percentile fits one aggregation buffer.
SMALL_ROWS = 1_000_000
HASH = "__hash"
HASH_BITS = 60


def range_count(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_edges(df: DataFrame, value: str) -> list[float]:
    """About as many cut points as shuffle partitions: one pass, one bounded list to the driver."""
    n = range_count(df.sparkSession)
    probs = [i / n for i in range(1, n)]
    numbers = df.select(F.col(value).cast("double").alias(value))
    found = numbers.approxQuantile(value, probs, max(1e-4, 0.25 / n))
    return sorted(set(found))


def _with_range(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    if not edges:
        return df.withColumn(RANGE, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    cast = df.withColumn("__as_double", F.col(value).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="__as_double", outputCol=RANGE).transform(cast)
    return bucketed.drop("__as_double")


def _range_offsets(tagged: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    totals = tagged.groupBy(*by, RANGE).agg(*[F.sum(m).alias(m) for m in sums])
    whole = Window.partitionBy(*by)
    before = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        RANGE,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}__offset") for m in sums],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in sums],
    )


def prefix_sums(
    df: DataFrame,
    value: str,
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (by, distinct value) with, for each measure m: m, m_before (sum over smaller values), m_total.

    Rows with a null value or a null group key take no part.
    """
    by, sums = list(by), list(measures)
    known = df
    for c in [value, *by]:
        # Plain null filters, as the join below infers them: both branches then share one shuffle.
        known = known.filter(F.col(c).isNotNull())
    if edges is None:
        edges = range_edges(known, value)
    distinct = known.groupBy(*by, value).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    tagged = _with_range(distinct, value, edges)
    offsets = _range_offsets(tagged, by, sums)
    inside = Window.partitionBy(*by, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"{m}__in") for m in sums])
    return local.join(offsets, [*by, RANGE]).select(
        *by,
        value,
        *[F.col(m) for m in sums],
        *[(F.col(f"{m}__in") + F.col(f"{m}__offset")).alias(f"{m}_before") for m in sums],
        *[F.col(f"{m}_total") for m in sums],
    )


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, ties, rank): 1-based rank of each distinct value, ties sharing their mean rank."""
    n = prefix_sums(df, value, {"ties": F.lit(1)}, by)
    return n.select(*by, value, "ties", (F.col("ties_before") + (F.col("ties") + 1) / 2.0).alias("rank"))


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles, one column per entry of `probs`, exact at any group size."""
    n = prefix_sums(df, value, {"n": F.lit(1)}, by)
    v, start, stop = F.col(value).cast("double"), F.col("n_before"), F.col("n_before") + F.col("n")
    aggs, picked = [], F.lit(False)
    for name, p in probs.items():
        spot = (F.col("n_total") - 1) * F.lit(float(p))
        low, high = F.floor(spot), F.ceil(spot)
        at_low, at_high = (start <= low) & (low < stop), (start <= high) & (high < stop)
        picked = picked | at_low | at_high
        aggs += [
            F.max(F.when(at_low, v)).alias(f"{name}__low"),
            F.max(F.when(at_high, v)).alias(f"{name}__high"),
            F.max(spot - low).alias(f"{name}__share"),
        ]
    found = n.filter(picked).groupBy(*by).agg(*aggs)
    return found.select(
        *by,
        *[
            (F.col(f"{q}__low") + (F.col(f"{q}__high") - F.col(f"{q}__low")) * F.col(f"{q}__share")).alias(q)
            for q in probs
        ],
    )


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact median of several columns, one row per group.

    A table of proven small size takes one aggregate; beyond that the columns go long and through
    `exact_quantiles`, whose groups stay distributed.
    """
    if df.count() <= SMALL_ROWS:
        known = df.dropna(subset=list(by)) if by else df
        return known.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in columns])
    return long_medians(df, columns, by)


def long_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    long = unpivoted(df, columns, by)
    found = exact_quantiles(long, "value", {"median": 0.5}, [*by, "variable"])
    wide = found.groupBy(*by).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(c) for c in columns]
    )
    # A group without any value keeps its row.
    return df.dropna(subset=list(by)).select(*by).distinct().join(wide, list(by), "left") if by else wide


def unpivoted(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, variable, value double) with the null cells left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(*keep, F.explode(cells).alias("cell")).select(*keep, "cell.variable", "cell.value")
    return long.filter(F.col("value").isNotNull())


def rank_positions(
    df: DataFrame, value: str, tie_break: str, descending: bool = True, name: str = "position"
) -> DataFrame:
    """Global 1-based position by value, ties in ascending order of a unique numeric column."""
    values = prefix_sums(df, value, {"n": F.lit(1)})
    ties = prefix_sums(df, tie_break, {"k": F.lit(1)}, by=[value]).select(value, tie_break, "k_before")
    ahead = F.col("n_total") - F.col("n_before") - F.col("n") if descending else F.col("n_before")
    spot = ties.join(values, value).select(tie_break, (ahead + F.col("k_before") + 1).alias(name))
    return df.join(spot, tie_break)


def _with_hash_range(df: DataFrame, keys: Sequence[str], seed: int | str) -> DataFrame:
    bits = (range_count(df.sparkSession) - 1).bit_length()
    hashed = df.withColumn(HASH, key_hash(keys, seed))
    return hashed.withColumn(RANGE, F.shiftright(HASH, HASH_BITS - bits))


def hash_positions(
    df: DataFrame,
    keys: Sequence[str],
    seed: int | str,
    by: Sequence[str] = (),
    name: str = "position",
    size: str | None = None,
) -> DataFrame:
    """0-based place of each row in the hash order of its keys, inside each group; `size` adds the group size."""
    tagged = _with_hash_range(df.dropna(subset=list(by)) if by else df, keys, seed)
    counted = tagged.select(*by, RANGE, F.lit(1).alias("n"))
    offsets = _range_offsets(counted, list(by), ["n"])
    inside = Window.partitionBy(*by, RANGE).orderBy(HASH, *keys)
    local = tagged.withColumn("__in", F.row_number().over(inside) - 1)
    out = local.join(offsets, [*by, RANGE]).withColumn(name, F.col("__in") + F.col("n__offset"))
    if size:
        out = out.withColumn(size, F.col("n_total"))
    return out.drop(RANGE, HASH, "__in", "n__offset", "n_total")


def hash_sample(
    df: DataFrame, keys: Sequence[str], seed: int | str, quota: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Exactly `quota` rows per group, the lowest in hash order. `quota` may use the group size `n_total`.

    Ranges wholly below the cut stay and ranges wholly above it go without any sort; only the one range
    per group that holds the cut is ordered.
    """
    tagged = _with_hash_range(df.dropna(subset=list(by)) if by else df, keys, seed)
    counted = tagged.select(*by, RANGE, F.lit(1).alias("n"))
    plan = _range_offsets(counted, list(by), ["n"]).withColumn("__quota", quota.cast("bigint"))
    sizes = counted.groupBy(*by, RANGE).agg(F.count("*").alias("__size"))
    plan = plan.join(sizes, [*by, RANGE])
    joined = tagged.join(plan, [*by, RANGE])
    stop = F.col("n__offset") + F.col("__size")
    extra = [RANGE, HASH, "n__offset", "n_total", "__quota", "__size"]
    whole = joined.filter(stop <= F.col("__quota")).drop(*extra)
    edge = joined.filter((F.col("n__offset") < F.col("__quota")) & (stop > F.col("__quota")))
    inside = Window.partitionBy(*by, RANGE).orderBy(HASH, *keys)
    cut = edge.withColumn("__in", F.row_number().over(inside))
    cut = cut.filter(F.col("n__offset") + F.col("__in") <= F.col("__quota")).drop(*extra, "__in")
    return whole.unionByName(cut)
