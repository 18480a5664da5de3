"""Training data preparation: encoding, trimming, splitting, ranking, assembling."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import finite_or_zero, flag, ratio
from ..session import materialize
from ..settings import NON_FEATURE_COLUMNS
from .numbering import add_place
from .quantile import date_quantile

#: Values that may become columns of their own; a wider table is no longer one that Spark plans.
MAX_LEVELS = 2_000

ONE_HOT_PREFIXES = {"category": "cat", "warehouse": "wh", "region": "reg"}


def one_hot_name(prefix: str, level: str) -> str:
    return f"{prefix}_{re.sub(r'[^0-9A-Za-z]+', '_', level)}"


def _named_levels(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct (``source``, ``level``) of the columns, in one pass; nulls are no level."""
    named = F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(F.inline(named)).where(F.col("level").isNotNull()).distinct()


def levels_of(df: DataFrame, columns: Iterable[str], most: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct values per column, for columns of their own.

    A wide table has a column per value, so more than ``most`` values are an
    error; nothing beyond them comes to the driver. ``add_level_codes`` has no
    such limit.
    """
    columns = list(columns)
    rows = _named_levels(df, columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{', '.join(columns)} have more than {most} values; use add_level_codes")
    return {c: sorted(row.level for row in rows if row.source == c) for c in columns}


def level_index(df: DataFrame, columns: Iterable[str] = ONE_HOT_PREFIXES) -> DataFrame:
    """``code`` of each (``source``, ``level``): its place from 0 among its column's values in order.

    The values are sorted, numbered and written by tasks; none of them comes to
    the driver, however many there are.
    """
    placed = add_place(_named_levels(df, columns).orderBy("source", "level"))
    firsts = placed.groupBy("source").agg(F.min("place").alias("first"))
    return materialize(placed.join(firsts, "source").select("source", "level", (F.col("place") - F.col("first")).alias("code")), "levels")


def add_level_codes(df: DataFrame, index: DataFrame | None = None, prefixes: Mapping[str, str] = ONE_HOT_PREFIXES) -> DataFrame:
    """One number ``<prefix>_code`` per column in place of a column per value; the source columns are dropped.

    A null, or a value that the index lacks, has the code -1. Trees cut the codes
    in order, so they stand for the values as one input each.
    """
    if index is None:
        index = level_index(df, prefixes)
    for source, prefix in prefixes.items():
        codes = index.where(F.col("source") == source).select(F.col("level").alias("__level"), F.col("code").alias("__code"))
        df = df.join(codes, F.col(source).cast("string") == F.col("__level"), "left")
        df = df.withColumn(f"{prefix}_code", F.coalesce("__code", F.lit(-1))).drop("__level", "__code", source)
    return df


def add_level_vectors(df: DataFrame, prefixes: Mapping[str, str] = ONE_HOT_PREFIXES) -> DataFrame:
    """One sparse 0/1 vector ``<prefix>_levels`` per column, however many values it has; the source columns are dropped.

    A null value has a vector of zeros. Positions follow the values in order.
    """
    for source, prefix in prefixes.items():
        index, vector = f"_{prefix}_index", f"{prefix}_levels"
        indexed = StringIndexer(inputCol=source, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep")
        df = indexed.fit(df).transform(df)
        df = OneHotEncoder(inputCols=[index], outputCols=[vector], dropLast=True).fit(df).transform(df).drop(index, source)
    return df


def add_one_hot(
    df: DataFrame,
    levels: Mapping[str, Sequence[str]] | None = None,
    prefixes: Mapping[str, str] = ONE_HOT_PREFIXES,
) -> DataFrame:
    """A 0/1 column per value; the source columns are dropped, no value is left out."""
    if levels is None:
        levels = levels_of(df, prefixes)
    columns: dict[str, Column] = {}
    for source, prefix in prefixes.items():
        for level in levels[source]:
            name = one_hot_name(prefix, level)
            if name in columns:
                raise ValueError(f"two values of {source} give the column {name}")
            columns[name] = flag(F.col(source) == level)
    return df.withColumns(columns).drop(*prefixes)


def add_target(df: DataFrame, source: str = "units_sold") -> DataFrame:
    return df.withColumn("target", F.col(source))


def drop_short_history(df: DataFrame, longest_lag: str = "demand_lag_90d") -> DataFrame:
    return df.na.drop(subset=[longest_lag])


def add_split_side(df: DataFrame, share: float = 0.8, gap_days: int = 0) -> DataFrame:
    """``side`` is train up to the date quantile and test after it plus the gap.

    Rows inside the gap get a null side.
    """
    split = date_quantile(df, share).scalar()
    day = F.unix_date("date")
    return df.withColumn("side", F.when(day <= split, "train").when(day > split + gap_days, "test"))


def time_split(df: DataFrame, share: float = 0.8, gap_days: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by date, so that no training row is later than a test row."""
    sided = add_split_side(df, share, gap_days)
    return tuple(sided.where(F.col("side") == side).drop("side") for side in ("train", "test"))


def split_summary(sided: DataFrame) -> DataFrame:
    return (
        sided.where(F.col("side").isNotNull())
        .groupBy("side")
        .agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    )


def feature_columns(df: DataFrame, excluded: Iterable[str] = NON_FEATURE_COLUMNS) -> list[str]:
    """All numeric columns that are not excluded by name."""
    excluded = set(excluded)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in excluded
    ]


# The calendar columns that are counted as a group.
CALENDAR_GROUP = (
    "day_of_week",
    "month",
    "quarter",
    "week_of_year",
    "is_weekend",
    "is_month_start",
    "is_month_end",
)


def feature_groups(columns: Sequence[str]) -> dict[str, int]:
    """Number of columns per feature group, by name pattern."""
    one_hot = tuple(f"{p}_" for p in ONE_HOT_PREFIXES.values())
    tests = {
        "lag": lambda c: "lag" in c,
        "rolling": lambda c: "rolling" in c,
        "calendar": lambda c: c in CALENDAR_GROUP,
        "price": lambda c: "price" in c or "promo" in c,
        "trend": lambda c: "trend" in c or "yoy" in c,
        "one_hot": lambda c: c.startswith(one_hot),
    }
    return {group: sum(map(test, columns)) for group, test in tests.items()}


def guarded_corr(x: Column, y: Column) -> Column:
    """Sample correlation over rows where both are present; null if one is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return ratio(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Absolute correlation of each column with the target, in one pass over the rows.

    The columns of a row become (position, value) pairs that are aggregated in
    the same task, so only one row per column and task is shuffled. One wide
    aggregate with a correlation per column would exceed what Spark compiles.
    """
    columns = list(columns)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    pairs = df.select(F.col(target).cast("double").alias("y"), F.posexplode(values).alias("at", "x"))
    names = F.array(*[F.lit(c) for c in columns])
    return (
        pairs.groupBy("at")
        .agg(F.abs(guarded_corr(F.col("x"), F.col("y"))).alias("correlation"))
        .select(names[F.col("at")].alias("feature"), "correlation")
    )


def rank_correlations(correlations: DataFrame, n: int | None = None) -> DataFrame:
    ranked = correlations.orderBy(F.desc_nulls_last("correlation"), "feature")
    return ranked if n is None else ranked.limit(n)


def feature_matrix(df: DataFrame, columns: Sequence[str] | None = None, vectors: Sequence[str] = ()) -> DataFrame:
    """Key, ``label`` and one ``features`` vector; missing and infinite values become 0.

    ``vectors`` names vector columns, such as those of ``add_level_vectors``, that follow the numbers.
    """
    columns = list(columns) if columns is not None else feature_columns(df)
    types = dict(df.dtypes)

    def clean_value(name: str) -> Column:
        """Whole numbers have no NaN and no infinity, so they skip that test."""
        if types[name] in ("double", "float"):
            return finite_or_zero(F.col(name))
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    label = "target" if "target" in df.columns else "units_sold"
    keep = [c for c in ("product_id", "date", "side") if c in df.columns]
    clean = df.select(
        *keep, F.col(label).cast("double").alias("label"), *[clean_value(c).alias(c) for c in columns], *vectors
    )
    return VectorAssembler(inputCols=[*columns, *vectors], outputCol="features").transform(clean).select(*keep, "label", "features")


def fold_labels(calendar: DataFrame, folds: int = 5) -> DataFrame:
    """Expanding time folds over consecutive days: (fold, date, role).

    The days are cut into ``folds + 1`` stretches; fold k tests the stretch
    after the first k (the oldest one takes the remainder) and trains on all
    days before it.
    """
    span = calendar.agg(F.struct(F.min("date").alias("lo"), F.datediff(F.max("date"), F.min("date")).alias("hi"))).scalar()
    n = F.col("_span.hi") + 1
    size = F.floor(n / (folds + 1)).cast("int")
    with_fold = (
        calendar.select("date")
        .withColumn("_span", span)
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("_at", F.datediff("date", F.col("_span.lo")))
        .withColumn("_start", n - (F.lit(folds + 1) - F.col("fold")) * size)
    )
    role = F.when(F.col("_at") < F.col("_start"), "train").when(F.col("_at") < F.col("_start") + size, "test")
    return with_fold.withColumn("role", role).where(F.col("role").isNotNull()).select("fold", "date", "role")
