from pyspark.sql import functions as F

from tallyforge.functions import scalars as S


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_rounding_is_half_even_on_the_scaled_double(spark):
    v = [2.345, 1.005, 0.285, -0.001]
    assert one(spark, *[S.round_even(F.lit(x), 2).alias(str(i)) for i, x in enumerate(v)]) == (2.35, 1.0, 0.28, 0.0)


def test_number_parsing(spark):
    texts = ["-", "--", "...", " 12.5 ", "1e3", "1d", "NaN", "", "-4"]
    got = one(spark, *[S.to_number(F.lit(x)).alias(str(i)) for i, x in enumerate(texts)])
    assert got == (None, None, None, 12.5, 1000.0, None, None, None, -4.0)


def test_nan_becomes_null(spark):
    assert one(spark, S.nan_to_null(F.lit(float("nan"))).alias("a"), S.nan_to_null(F.lit(1.0)).alias("b")) == (None, 1.0)


def test_codes_and_regions(spark):
    assert one(spark, S.state_code(F.lit(3550308)).alias("s"), S.region_name(F.lit(35)).alias("r"), S.region_name(F.lit(99)).alias("x")) == (35, "Sudeste", None)


def test_targets_without_value(spark):
    none, some = F.lit(None).cast("double"), F.lit(60.0)
    assert one(spark, S.met_target(none, some, False).alias("a"), S.met_target(none, some, True).alias("b"), S.met_target(some, none, True).alias("c")) == (None, False, None)


def test_clip_keeps_null_and_per_capita_needs_people(spark):
    none = F.lit(None).cast("double")
    assert one(spark, S.clip(none, 0.0, 1.0).alias("a"), S.per_capita(F.lit(5.0), F.lit(0)).alias("b"), S.per_capita(F.lit(5.0), F.lit(10)).alias("c")) == (None, None, 500.0)


def test_year_in_header(spark):
    assert one(spark, S.year_in_header(F.lit("META_FINAL_2030"), "META_FINAL").alias("a"), S.year_in_header(F.lit("META_FINAL_X"), "META_FINAL").alias("b")) == (2030, None)
