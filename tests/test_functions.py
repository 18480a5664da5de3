import datetime as dt

from pyspark.sql import functions as F

from stocktide.functions import dates, measures, numeric
from stocktide.operators.calendar import calendar_features, holidays_of
from stocktide.sources.demand import spine


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_numbers(spark):
    lit = F.lit
    row = one(
        spark,
        half=numeric.round_half_up(lit(0.125), 2),
        negative=numeric.round_half_up(lit(-0.125), 2),
        even=numeric.round_half_even(lit(2.5), 0),
        by_zero=numeric.ratio(lit(1.0), lit(0.0)),
        nan=numeric.finite_or_zero(lit(float("nan"))),
        inf=numeric.finite_or_zero(lit(float("-inf"))),
        missing=numeric.finite_or_zero(lit(None).cast("double")),
        kept=numeric.finite_or_zero(lit(-3.5)),
        floor=numeric.floor_at_zero(lit(-1.0)),
        floor_null=numeric.floor_at_zero(lit(None).cast("double")),
        one=numeric.positive_or_one(lit(0)),
        flag_null=numeric.flag(lit(None).cast("boolean")),
    ).asDict()
    assert row == {
        "half": 0.13,
        "negative": -0.13,
        "even": 2.0,
        "by_zero": None,
        "nan": 0.0,
        "inf": 0.0,
        "missing": 0.0,
        "kept": -3.5,
        "floor": 0.0,
        "floor_null": None,
        "one": 1,
        "flag_null": 0,
    }


def test_tiers_strategies_and_margins(spark):
    tier = [one(spark, t=measures.abc_tier(F.lit(x))).t for x in (200.0, 199.9, 50.0, 49.9)]
    assert tier == ["A", "B", "B", "C"]
    cases = [(200.0, 160.0), (200.0, 160.1), (50.0, 40.0), (49.0, 1.0), (0.0, 0.0)]
    strategies = [one(spark, s=measures.stocking_strategy(F.lit(d), F.lit(x))).s for d, x in cases]
    assert strategies == ["FORWARD-STOCK", "MAKE-TO-ORDER", "REGIONAL-HUB", "CENTRAL-CONSOLIDATE", "CENTRAL-CONSOLIDATE"]
    margins = [one(spark, m=measures.margin_impact(F.lit(s), F.lit(100.0))).m for s in (*measures.MARGIN_LIFT, "MAKE-TO-ORDER")]
    assert [round(x, 6) for x in margins] == [675.0, 540.0, 360.0, 0.0]


def test_dates(spark):
    row = one(
        spark,
        monday=dates.week_start(dates.day("2023-01-01")),
        iso=dates.iso_week(dates.day("2021-01-01")),
        clamp=dates.plus_months("2024-02-29", -12),
        weeks=dates.plus_weeks("2023-01-15", -2),
        sunday=dates.weekday_from_monday(dates.day("2023-01-01")),
    )
    assert row.monday == dt.date(2022, 12, 26)
    assert row.iso == 53
    assert row.clamp == dt.date(2023, 2, 28)
    assert row.weeks == dt.date(2023, 1, 1)
    assert row.sunday == 6


def test_holidays_follow_the_known_list(spark):
    span = spark.sql("select date'2021-01-01' first_day, date'2023-12-31' last_day")
    found = {str(r.holiday) for r in holidays_of(spine(span)).collect()}
    # The eight holidays of each year.
    assert found == set(
        """2021-01-01 2021-01-18 2021-02-15 2021-05-31 2021-07-04 2021-09-06 2021-11-25 2021-12-25
        2022-01-01 2022-01-17 2022-02-21 2022-05-30 2022-07-04 2022-09-05 2022-11-24 2022-12-25
        2023-01-01 2023-01-16 2023-02-20 2023-05-29 2023-07-04 2023-09-04 2023-11-23 2023-12-25""".split()
    )
    features = calendar_features(spine(span))
    by_day = {str(r.date): r for r in features.collect()}
    assert len(by_day) == 1095
    assert by_day["2023-12-31"].days_to_holiday == 6
    assert by_day["2021-11-28"].is_holiday_week == 1
    assert by_day["2021-02-28"].is_month_end == 1


def test_order_quantity_is_null_without_demand(spark):
    row = one(
        spark,
        some=measures.economic_order_quantity(F.lit(10.0)),
        none=measures.economic_order_quantity(F.lit(0.0)),
    )
    assert round(row.some) == 142
    assert row.none is None
