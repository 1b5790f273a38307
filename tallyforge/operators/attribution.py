"""How much each feature moves a prediction."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import key_hash, ratio, round_even
from ..session import stored
from .ordered import HASH_BITS, hash_positions, hash_sample, range_count
from .resampling import point_metric

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sums that one task keeps at once.
PART_SUMS = 1_000_000
# Rows that a task packs at once, and rows of a range of hashes and of a block of positions.
PACKED_ROWS, BLOCK_ROWS = 500_000, 1_000_000


def attribution_linear(df: DataFrame, coefficients: Mapping[str, float], keys: Sequence[str]) -> DataFrame:
    """Exact additive attribution of a linear model, wide: coefficient times distance from the column's mean."""
    names = list(coefficients)
    means = df.agg(*[F.avg(n).alias(n) for n in names]).first()
    return df.select(*keys, *[(F.lit(float(coefficients[n])) * (F.col(n) - F.lit(means[n]))).alias(n) for n in names])


def long_attributions(wide: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).alias("phi")) for n in names])
    return wide.select(*keys, F.explode(cells).alias("e")).select(*keys, "e.*")


def attribution_sampled(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], score: Callable[[DataFrame], DataFrame],
    permutations: int = 20, max_rows: int = 5000, seed: int = 42,
) -> DataFrame:
    """Monte-Carlo Shapley values for any model on a sample of at most `max_rows` rows: (keys, variable, phi).

    Each sampled row meets, per permutation, one background row of the sample and one order of the features.
    Features switch from the background's value to the row's own in that order; each switch is one hybrid, all
    hybrids are scored in one pass, and a feature's value is the mean change at its switch. The values of a row
    add up to its score minus the mean score of its background rows. `score` adds a column `prediction`.
    """
    features, keys = list(features), list(keys)
    sampled = hash_sample(df.select(*keys, *features), keys, seed, F.least(F.col("n_total"), F.lit(max_rows)))
    placed = hash_positions(sampled, keys, seed, name="spot", size="n")
    background = placed.select(F.col("spot").alias("donor"), F.struct(*features).alias("other"))
    tries = placed.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    tries = tries.withColumn("donor", key_hash([*keys, "draw"], f"{seed}d") % F.col("n"))
    order = F.array_sort(F.array(*[F.struct(key_hash([*keys, "draw"], f"{seed}{f}").alias("h"), F.lit(f).alias("f")) for f in features]))
    turns = tries.join(background, "donor").withColumn("order", F.transform(order, lambda e: e.f))
    steps = turns.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))

    def hybrid(f: str):
        own = F.array_position("order", f) <= F.col("step")
        return F.when(own, F.col(f)).otherwise(F.col(f"other.{f}")).alias(f)

    switched = F.when(F.col("step") > 0, F.get("order", F.col("step") - 1))
    hybrids = steps.select(*keys, "draw", "step", switched.alias("variable"), *[hybrid(f) for f in features])
    scored = score(hybrids)
    within = Window.partitionBy(*keys, "draw").orderBy("step")
    moved = scored.withColumn("gain", F.col("prediction") - F.lag("prediction").over(within)).filter(F.col("step") > 0)
    return moved.groupBy(*keys, "variable").agg(F.avg("gain").alias("phi"))


def shapley_weights(n: int) -> list[list[float]]:
    """Per feature, the weight of the value of every coalition (a bit mask) in its Shapley value."""
    size = [m.bit_count() for m in range(1 << n)]
    share = [1.0 / (n * math.comb(n - 1, k)) for k in range(n)]
    return [[share[size[m] - 1] if m >> j & 1 else -share[size[m]] for m in range(1 << n)] for j in range(n)]


def attribution_shapley(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], score: Callable[[DataFrame], DataFrame], background: Sequence[Mapping[str, float]],
    draws: int = 8, exact_up_to: int = 10, seed: int = 42,
) -> DataFrame:
    """Shapley values of any model against stated background rows: (keys, variable, phi, standard_error).

    The value of a coalition is the mean score of the row with all other features taken from the background. With up to
    `exact_up_to` features all coalitions are scored and the values are exact. Beyond, `draws` coalitions of every size
    are drawn per row and feature by a hash, the sizes weigh the same, and the standard error follows from the spread
    inside each size. All hybrids are scored in one pass and summed where they are; `score` adds a column `prediction` and
    keeps the others.
    """
    features, keys, n = list(features), list(keys), len(features)
    others = F.array(*[F.struct(*[F.lit(float(b[f])).alias(f) for f in features]) for b in background])
    rows = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features])

    def hybrids(table: DataFrame, inside: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
        each = table.withColumn("__other", F.explode(others))
        return score(each.select(*by, *[F.when(inside[f], F.col(f)).otherwise(F.col(f"__other.{f}")).alias(f) for f in features]))

    if n <= exact_up_to:
        all_ = rows.withColumn("__mask", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
        inside = {f: F.col("__mask").bitwiseAND(1 << j) != 0 for j, f in enumerate(features)}
        weights = [F.element_at(F.array(*[F.lit(w) for w in ws]), F.col("__mask") + 1) for ws in shapley_weights(n)]
        scored = hybrids(all_, inside, [*keys, "__mask"])
        wide = scored.groupBy(*keys).agg(*[(F.sum(w * F.col("prediction")) / len(background)).alias(f) for w, f in zip(weights, features)])
        return long_attributions(wide, features, keys).withColumn("standard_error", F.lit(0.0))
    # The empty and the full coalition are drawn once: all draws of them are the same.
    pairs = [(k, d) for k in range(n) for d in range(draws if 0 < k < n - 1 else 1)]
    cells = F.array(*[F.struct(F.lit(f).alias("variable"), F.lit(i).alias("at"), F.lit(k).alias("size")) for f in features for i, (k, _) in enumerate(pairs)])
    # Rows go by key to parts of a bounded number of sums before they multiply: all that follows stays in its task.
    parts = max(range_count(df.sparkSession), math.ceil(rows.count() * n * n / PART_SUMS))
    # A row's keys are hashed once; its draws are numbers made from that. A feature is in a coalition when fewer features
    # than the coalition's size have a lower number.
    tries = rows.repartition(parts, *keys).withColumn("__h", key_hash(keys, seed)).withColumn("__c", F.explode(cells)).select("*", "__c.*").drop("__c")
    tries = tries.select("*", *[F.when(F.col("variable") != f, F.xxhash64("__h", "variable", "at", F.lit(f))).alias(f"__r{j}") for j, f in enumerate(features)])

    def below(j: int) -> Column:
        """How many features come before feature j in the drawn order; its own variable has no number."""
        mine = F.col(f"__r{j}")
        ahead = [F.when((F.col(f"__r{i}") < mine) | ((F.col(f"__r{i}") == mine) & F.lit(i < j)), 1).otherwise(0) for i in range(n) if i != j]
        return sum(ahead, F.lit(0))

    inside = [F.coalesce((F.col(f"__r{j}").isNotNull()) & (below(j) < F.col("size")), F.lit(False)).alias(f"__in{j}") for j in range(n)]
    tries = tries.select(*keys, "variable", "at", *features, *inside).withColumn("__other", F.explode(others))
    by = [*keys, "variable", "at"]
    without = score(tries.select(*by, F.struct(*features).alias("__own"), *[F.when(F.col(f"__in{j}"), F.col(f)).otherwise(F.col(f"__other.{f}")).alias(f) for j, f in enumerate(features)]))
    joined = without.select(*by, F.col("prediction").alias("__without"), *[F.when(F.col("variable") == f, F.col(f"__own.{f}")).otherwise(F.col(f)).alias(f) for f in features])
    gain = (F.col("prediction") - F.col("__without")) / len(background)
    sums = score(joined).groupBy(*keys, "variable").agg(*[F.sum(F.when(F.col("at") == i, gain)).alias(f"__g{i}") for i in range(len(pairs))])
    means, spreads = [], []
    for k in range(n):
        drawn = [F.col(f"__g{i}") for i, (size, _) in enumerate(pairs) if size == k]
        mean = sum(drawn, F.lit(0.0)) / len(drawn)
        means.append(mean)
        if len(drawn) > 1:
            spreads.append(sum(((g - mean) * (g - mean) for g in drawn), F.lit(0.0)) / ((len(drawn) - 1) * len(drawn)))
    return sums.select(*keys, "variable", (sum(means, F.lit(0.0)) / n).alias("phi"), (F.sqrt(sum(spreads, F.lit(0.0))) / n).alias("standard_error"))


def column_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """The background row of an average unit."""
    row = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    return {f: float(row[f] or 0.0) for f in features}


def global_importance(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("variable").agg(F.avg(F.abs("phi")).alias("importance"))


def block_importance(
    importance: DataFrame, blocks: Mapping[str, Sequence[str]], missing_prefix: str, rest: str,
    place_prefixes: Sequence[str] = (), place_block: str = "place",
) -> DataFrame:
    """Share of each block of variables in the total importance, in percent.

    Variables that begin with one of the place prefixes form one block; a missing indicator belongs to the block of its
    variable; all others are `rest`.
    """
    owner = {v: b for b, names in blocks.items() for v in names}
    v = F.col("variable")
    core = F.when(v.startswith(missing_prefix), F.substring(v, len(missing_prefix) + 1, 10_000)).otherwise(v)
    block = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in owner.items() for x in kv]), core), F.lit(rest))
    for prefix in place_prefixes:
        block = F.when(v.startswith(prefix), place_block).otherwise(block)
    sums = importance.groupBy(block.alias("block")).agg(F.sum("importance").alias("s"))
    total = importance.agg(F.sum("importance")).scalar()
    return sums.withColumn("total", total).select("block", round_even(ratio(F.lit(100.0) * F.col("s"), "total"), 1).alias("share_pct"))


def _pack(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpack(parts: Sequence[bytes]) -> pa.Table:
    """Packed rows one after the other, with plain columns."""
    tables = []
    for part in parts:
        rows = pa.ipc.open_stream(part).read_all()
        tables.append(pa.table({n: c.cast(c.type.value_type) if pa.types.is_dictionary(c.type) else c for n, c in zip(rows.column_names, rows.columns)}))
    return pa.concat_tables(tables).combine_chunks()


def _short(rows: pa.Table) -> pa.Table:
    """Columns of few values as small codes."""
    made = {}
    for name, column in zip(rows.column_names, rows.columns):
        plain = column.combine_chunks()
        coded = (pa.concat_arrays(plain.chunks) if isinstance(plain, pa.ChunkedArray) else plain).dictionary_encode()
        k = len(coded.dictionary)
        code = pa.int8() if k <= 127 else pa.int16()
        made[name] = pa.DictionaryArray.from_arrays(coded.indices.cast(code), coded.dictionary) if k <= min(32_000, rows.num_rows // 4) else column
    return pa.table(made)


def permuted_pairs(kept: DataFrame, own: Sequence[str], features: Sequence[str], keys: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """(rep, own, other): per repeat each row beside the features of the row at the same place of another hash order.

    The orders are those of `hash_positions` by (rep, keys); rows of equal 60-bit hashes come in any order. A task packs its
    rows per repeat, order and range of hashes, without keys; ranges are sorted and their packed rows cut into blocks of
    positions, where both orders meet.
    """
    spark, own, features = kept.sparkSession, list(own), list(features)
    text = F.concat_ws("|", F.lit(""), *[F.col(k).cast("string") for k in keys])
    rows = kept.select(text.alias("__text"), *own)
    n = kept.count()
    bits = max((range_count(spark) - 1).bit_length(), math.ceil(math.log2(max(1.0, n / BLOCK_ROWS))))
    sides = [(rep, side) for rep in range(repeats) for side in ("r", "g")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def sent() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            texts, short = [t.encode() for t in table["__text"].to_pylist()], _short(table.select(own))
            for rep, side in sides:
                head = f"{seed}{side}|{rep}".encode()
                digests = b"".join([md5(head + t, usedforsecurity=False).digest() for t in texts])
                hashes = np.frombuffer(digests, ">u8")[::2].astype(np.uint64) >> np.uint64(64 - HASH_BITS)
                order = np.argsort(hashes)
                hashes = hashes[order]
                mine = (short if side == "r" else short.select(features)).take(pa.array(order))
                cut = np.searchsorted(hashes, np.arange((1 << bits) + 1).astype(np.uint64) << np.uint64(HASH_BITS - bits))
                for r in np.flatnonzero(np.diff(cut)):
                    a, b = cut[r], cut[r + 1]
                    yield pa.RecordBatch.from_arrays([pa.array([rep]), pa.array([side]), pa.array([int(r)]), pa.array([hashes[a:b].tobytes()]), pa.array([_pack(mine.slice(a, b - a))])],
                                                     names=["rep", "side", "range", "hashes", "rows"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= PACKED_ROWS:
                    yield from sent()
                    held = []
        if held:
            yield from sent()

    def order_range(key, part):
        hashes = np.concatenate([np.frombuffer(h, "<u8") for h in part["hashes"].to_pylist()])
        table = _unpack(part["rows"].to_pylist()).take(pa.array(np.argsort(hashes, kind="stable")))
        return pa.table({"rep": [key[0].as_py()], "side": [key[1].as_py()], "range": [key[2].as_py()], "n": [len(hashes)], "rows": [_pack(_short(table))]})

    packed = rows.mapInArrow(pack, "rep bigint, side string, range bigint, hashes binary, rows binary")
    ordered = stored(packed.groupBy("rep", "side", "range").applyInArrow(order_range, "rep bigint, side string, range bigint, n bigint, rows binary"), "ordered")
    before: dict[tuple, int] = {}  # rows of a repeat's order before each range
    total: dict[tuple, int] = {}
    for r in ordered.select("rep", "side", "range", "n").orderBy("rep", "side", "range").collect():
        of = (r["rep"], r["side"])
        before[(*of, r["range"])] = total.get(of, 0)
        total[of] = total.get(of, 0) + r["n"]
    size = max(1, min(BLOCK_ROWS, -(-n // range_count(spark))))

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, table = before[row["rep"], row["side"], row["range"]], _short(_unpack([row["rows"]]))
                start = at
                while start < at + row["n"]:
                    stop = min(at + row["n"], (start // size + 1) * size)
                    yield pa.RecordBatch.from_arrays([pa.array([row["rep"]]), pa.array([start // size]), pa.array([row["side"]]), pa.array([start]), pa.array([_pack(table.slice(start - at, stop - start))])],
                                                     names=["rep", "block", "side", "position", "rows"])
                    start = stop

    def meet(key, part):
        part = part.sort_by("position")
        side = np.array(part["side"].to_pylist())
        blobs = part["rows"].to_pylist()
        taker, giver = (_unpack([blobs[i] for i in np.flatnonzero(side == s)]) for s in ("r", "g"))
        return pa.table([pa.array([key[0].as_py()] * taker.num_rows, pa.int32()), *taker.columns, *giver.columns], names=["rep", *own, *[f"__o_{f}" for f in features]])

    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = ", ".join(["rep int", *[f"`{c}` {types[c]}" for c in own], *[f"`__o_{f}` {types[f]}" for f in features]])
    blocks = ordered.mapInArrow(cut_blocks, "rep bigint, block bigint, side string, position bigint, rows binary")
    met = blocks.groupBy("rep", "block").applyInArrow(meet, schema)
    return met.select("rep", *own, F.struct(*[F.col(f"__o_{f}").alias(f) for f in features]).alias("other"))


def permutation_importance(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], score: Callable[[DataFrame], DataFrame], y: str,
    metric: str = "auc", repeats: int = 5, weight: str | None = None, seed: int = 42,
) -> DataFrame:
    """Mean and population deviation of the metric's drop when one original column is permuted.

    One permutation of the rows per repeat serves every column, so the rows are matched once per repeat and
    all (column, repeat) tables are scored together; permuted rows have no keys.
    """
    features, keys = list(features), list(keys)
    kept = df.select(*keys, y, *([weight] if weight else []), *features)
    own = [y, *([weight] if weight else []), *features]
    # Stored, as the metric reads the pairs twice.
    pairs = stored(permuted_pairs(kept, own, features, keys, repeats, seed), "pairs")
    each = pairs.withColumn("variable", F.explode(F.array(*[F.lit(f) for f in features])))
    mixed = each.select(
        y, *([weight] if weight else []), "rep", "variable",
        *[F.when(F.col("variable") == f, F.col(f"other.{f}")).otherwise(F.col(f)).alias(f) for f in features],
    )
    base = point_metric(score(kept), y, "prediction", metric, weight).select("value").scalar()
    after = point_metric(score(mixed), y, "prediction", metric, weight, ["variable", "rep"])
    drops = after.withColumn("drop", base - F.col("value"))
    return drops.groupBy("variable").agg(F.avg("drop").alias("drop_mean"), F.stddev_pop("drop").alias("drop_std"))


def dependence_table(df: DataFrame, attributions: DataFrame, variable: str, keys: Sequence[str]) -> DataFrame:
    """Value of one variable beside its attribution, per row."""
    own = attributions.filter(F.col("variable") == variable).select(*keys, "phi")
    return df.select(*keys, F.col(variable).alias("value")).join(own, list(keys))


def local_explanation(attributions: DataFrame, unit: Mapping[str, object], k: int = 12) -> DataFrame:
    """The k attributions of one unit with the largest absolute value."""
    rows = reduce(lambda d, kv: d.filter(F.col(kv[0]) == kv[1]), unit.items(), attributions)
    return rows.orderBy(F.abs("phi").desc(), "variable").limit(k)


def influence_table(tables: Mapping[str, DataFrame], k: int = 12) -> DataFrame:
    """Importance tables side by side by variable, the k strongest of the first table."""
    renamed = [t.select("variable", F.col("importance").alias(name)) for name, t in tables.items()]
    out = reduce(lambda a, b: a.join(b, "variable", "full"), renamed)
    first = next(iter(tables))
    return out.orderBy(F.col(first).desc_nulls_last(), "variable").limit(k)
