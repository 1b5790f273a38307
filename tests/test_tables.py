"""Weighted indicator, editions and point-in-time features on small known tables."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import editions as E
from tallyforge.operators import indicator as I
from tallyforge.operators import pit

PERSONS = [
    (2024, 1, 10, "municipal", 1100015, 1, 1, 1.0, 760.0, 1), (2024, 2, 10, "municipal", 1100015, 1, 1, 1.0, 700.0, 0),
    (2024, 3, 20, "municipal", 1100023, 1, 1, 3.0, 750.0, 1), (2024, 4, 20, "municipal", 1100023, 1, 1, 1.0, 730.0, 0),
    (2024, 5, 20, "municipal", 1100023, 0, 0, None, None, 0),
]
P = "year int, person_id long, school_id long, network string, area_id long, present int, filled int, weight double, score double, passed int"


@pytest.fixture
def persons(spark):
    return spark.createDataFrame(PERSONS, P)


def test_weighted_indicator(persons):
    got = {r.area_id: r for r in I.weighted_indicator(persons, ["area_id"]).collect()}
    assert (got[1100015].n_evaluated, got[1100015].indicator_pct) == (2, 50.0)
    x = got[1100023]
    assert (x.n_evaluated, x.indicator_pct, x.indicator_raw_pct, x.mean_score) == (2, 75.0, 50.0, 745.0)


def test_null_weight_counts_and_null_score_leaves_the_numerator(spark):
    rows = [(2024, 1, 1, "m", 7, 1, 1, None, 100.0, 1), (2024, 2, 1, "m", 7, 1, 1, 2.0, None, 1), (2024, 3, 1, "m", None, 1, 1, 1.0, 1.0, 1), (2024, 4, 1, "m", 8, 1, 1, None, 5.0, 1)]
    got = {r.area_id: r for r in I.weighted_indicator(spark.createDataFrame(rows, P), ["area_id"]).collect()}
    assert set(got) == {7, 8} and got[7].n_evaluated == 2 and got[7].indicator_pct == 100.0 and got[7].mean_score is None
    assert got[8].indicator_pct is None


def test_fact_against_targets(spark, persons):
    areas = spark.createDataFrame([(1100015, "A", "RO", 11, "Norte"), (1100023, "B", "RO", 11, "Norte")], "area_id long, area_name string, state string, state_id long, region string")
    targets = spark.createDataFrame([(1100015, 2024, 60.0), (1100023, 2025, 70.0)], "area_id long, year int, target_pct double")
    got = {r.area_id: r for r in I.fact_table(persons, areas, targets).collect()}
    assert got[1100015].hit is False and got[1100015].gap == -10.0
    assert got[1100023].target_pct is None and got[1100023].hit is None


def test_lag_change(spark):
    df = spark.createDataFrame([(1, 2023, 60.0), (1, 2024, 65.0), (1, 2025, 62.0), (2, 2024, 50.0)], "area int, year int, v double")
    got = [r.change for r in I.lag_change(df, "area", "year", "v").orderBy("area", "year").collect()]
    assert got == [None, 5.0, -3.0, None]


def test_area_dimension_takes_the_first_source(spark):
    s = spark.createDataFrame([(3550308, "Sao Paulo", "SP", 1), (3550308, "São Paulo", "SP", 0), (1100015, "A", "RO", 1)], "area_id long, area_name string, state string, source_rank int")
    names = spark.createDataFrame([("SP", "S. Paulo")], "state string, state_name string")
    got = {r.area_id: r for r in I.area_dimension(s, names).collect()}
    assert got[3550308].area_name == "São Paulo" and got[3550308].region == "Sudeste" and got[1100015].state_name is None


@pytest.mark.parametrize("editions,at,want", [((2023, 2024), 2024, 2024), ((2023, 2024), 2023, 2023), ((2024, 2025), 2026, 2025), ((2024, 2025), 2020, 2024)])
def test_asof_edition(spark, editions, at, want):
    ask = spark.createDataFrame([(at,)], "year int")
    given = spark.createDataFrame([(e,) for e in editions], "edition int")
    assert E.asof_edition(ask, given, "year").first().ref_edition == want
    strict = E.asof_edition(ask, given, "year", strict=True).first().ref_edition
    assert strict == (want if want <= at else None)


def test_own_edition_wins_even_when_empty_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1, 2024, 2024, None), (1, 2024, 2025, 70.0), (1, 2023, 2022, 1.0), (1, 2023, 2024, 2.0)], "id int, year int, edition int, v double")
    assert {r.year: r.v for r in E.closest_edition(df, ["id", "year"]).collect()} == {2024: None, 2023: 1.0}
    assert {r.year: r.v for r in E.closest_edition(df, ["id", "year"], value="v", drop_null_first=True).collect()} == {2024: 70.0, 2023: 1.0}


def consolidated_by_hand(rows):
    known = [r for r in rows if r[2] is not None]
    every = {r[1] for r in known}
    out = {}
    for unit in {r[0] for r in known}:
        table = {}
        for _, y, v, e in (r for r in known if r[0] == unit):
            table.setdefault(e, {})[y] = v
        full = [e for e in table if set(table[e]) == every]
        if not full:
            for y in {y for t in table.values() for y in t}:
                e = max(e for e in table if y in table[e])
                out[unit, y] = (table[e][y], e)
            continue
        base = max(full)
        finer = [e for e in full if e < base and all(round(table[e][y]) == round(table[base][y]) for y in every)]
        use = min(finer) if finer else base
        out.update({(unit, y): (table[use][y], use) for y in every})
    return out


def test_consolidated_targets_match_a_plain_reading_of_the_rule(spark):
    rnd = random.Random(3)
    rows = []
    for unit in range(60):
        for year in range(2024, 2028):
            v = rnd.uniform(40, 80)
            for e in (2023, 2024, 2025):
                shown = v if e == 2023 else float(round(v)) + (3 if e == 2025 and unit % 3 == 0 else 0)
                rows.append((unit, year, None if rnd.random() < 0.08 else shown, e))
    df = spark.createDataFrame(rows, "unit_id int, year int, target_pct double, edition int")
    got = {(r.unit_id, r.year): (r.target_pct, r.edition) for r in E.consolidate_targets(df).collect()}
    assert got == consolidated_by_hand(rows)


def test_panel_block(spark):
    panel = spark.createDataFrame([(1, y, v) for y, v in zip(range(2015, 2026, 2), (4.0, 4.4, 4.8, 4.6, 5.2, 5.8))], "area_id int, year int, ideb double")
    got = {r.target_year: r for r in pit.panel_block(panel, [2024, 2026], ["ideb"], "ideb").collect()}
    assert (got[2024].ref_panel, got[2024].ideb_last, got[2024].ideb_previous) == (2023, 5.2, 4.6)
    assert got[2024].ideb_change == pytest.approx(0.6) and got[2026].ideb_last == 5.8
    line = spark.createDataFrame([(1, y, 4.0 + 0.3 * i) for i, y in enumerate(range(2015, 2024, 2))], "area_id int, year int, ideb double")
    assert pit.panel_block(line, [2024], ["ideb"], "ideb").first().ideb_trend == pytest.approx(0.3)


def test_trend_drops_nulls_after_the_last_five(spark):
    panel = spark.createDataFrame([(1, 2011, 1.0), (1, 2013, 2.0), (1, 2015, None), (1, 2017, None), (1, 2019, None), (1, 2021, 3.0), (1, 2023, None)], "area_id int, year int, ideb double")
    r = pit.panel_block(panel, [2024], ["ideb"], "ideb").first()
    assert r.ideb_trend is None and r.ideb_last is None and r.ideb_previous == 3.0


@pytest.fixture
def history(spark):
    mart = spark.createDataFrame(
        [(1, 2023, 60.0, 2, 88.0, None, None), (1, 2024, 65.0, 3, 90.0, True, 2.0), (1, 2025, 70.0, 4, 92.0, True, 1.0)],
        "area_id int, year int, indicator_pct double, level int, participation_pct double, hit boolean, gap double")
    targets = spark.createDataFrame([(1, 2024, 63.0), (1, 2025, 69.0), (1, 2026, 72.0)], "area_id int, year int, target_pct double")
    return pit.history_block(mart, targets, [2024, 2025, 2026])


def test_history_sees_the_past_only(history):
    got = {r.target_year: r for r in history.collect()}
    x = got[2025]
    assert (x.indicator_t1, x.indicator_t2, x.change_t1, x.target_t, x.required_jump, x.gap_t1, x.indicator_t, x.hit_t) == (65, 60, 5, 69, 4, 2, 70, True)
    y = got[2026]
    assert (y.indicator_t1, y.required_jump, y.indicator_t, y.hit_t) == (70, 2, None, None)


def test_earlier_results_and_targets_add_no_area(spark):
    mart = spark.createDataFrame([(5, 2022, 60.0, 2, 88.0, None, None)], "area_id int, year int, indicator_pct double, level int, participation_pct double, hit boolean, gap double")
    targets = spark.createDataFrame([(6, 2023, 63.0)], "area_id int, year int, target_pct double")
    assert pit.history_block(mart, targets, [2024]).count() == 0


def test_no_outcome_reaches_a_person(spark, history):
    people = spark.createDataFrame([(2024, 1, 10), (2025, 1, 11)], "year int, area_id int, person_id int")
    area = history.withColumn("area_name", F.lit("x")).withColumn("state", F.lit("x")).withColumn("state_name", F.lit("x")).withColumn("region", F.lit("x"))
    out = I.person_full(people, area)
    assert not set(I.OUTCOMES) & set(out.columns) and out.count() == 2
    assert out.filter("year = 2025").first().indicator_t1 == 65


def test_attendance_counts_persons_without_an_area_and_size_does_not(spark):
    rows = [(2024, 1, 9, "m", 1, 1, 1, 1.0, 1.0, 1), (2024, 2, 9, "m", None, 1, 1, 1.0, 1.0, 1), (2024, 3, 9, "m", 1, 0, 0, 1.0, 1.0, 0), (2024, 4, 8, "m", 1, 0, 0, 1.0, 1.0, 0)]
    got = I.school_context(spark.createDataFrame(rows, P)).collect()
    assert len(got) == 1 and got[0].school_evaluated == 1 and got[0].school_attendance_pct == pytest.approx(200 / 3)
