"""Table cleaning: column handling, coercion, imputation, de-duplication, scaling, binning.

Statistics needed by a transform (means, min/max) enter as scalar subqueries;
Catalyst merges scalar subqueries over the same plan into one job, so no
driver round trip and no join is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns(df: DataFrame) -> list[str]:
    return list(df.columns)


def drop_if_present(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name) if name in df.columns else df


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def head(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows in a stated order (TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.orderBy(*order_by).limit(n)


def strip_column_names(df: DataFrame) -> DataFrame:
    """Remove all whitespace from column names."""
    return df.toDF(*[re.sub(r"\s+", "", c) for c in df.columns])


def has_nulls(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0)).cast("boolean").alias("has_nulls"))


def duration_seconds(text: Column) -> Column:
    """``'14 mins 16 secs'`` → 856. Missing part counts 0; only plural units match."""
    mins = F.regexp_extract(text, r"(\d+)\smins", 1)
    secs = F.regexp_extract(text, r"(\d+)\ssecs", 1)

    def as_int(part: Column) -> Column:
        return F.coalesce(F.nullif(part, F.lit("")).try_cast("int"), F.lit(0))

    return F.when(text.isNull(), F.lit(0)).otherwise(as_int(mins) * 60 + as_int(secs))


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast listed columns to double; unparseable values (e.g. ``'-'``) become null."""
    return df.select(
        *[F.col(f"`{c}`").try_cast("double").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns]
    )


def fill_null(df: DataFrame, cols: list[str], value) -> DataFrame:
    return df.fillna(value, subset=cols)


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace nulls by the column mean over non-null values."""
    means = {c: df.agg(F.avg(F.col(f"`{c}`"))).scalar() for c in cols}
    return df.select(
        *[F.coalesce(F.col(f"`{c}`"), means[c]).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns]
    )


def append_mean_row(df: DataFrame, cols: list[str], id_col: str = "id", label: str = "Mean") -> DataFrame:
    """Append one row holding the mean of each listed column and ``id = label``."""
    base = df.withColumn(id_col, F.col(id_col).cast("string"))
    mean_row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in cols]).withColumn(id_col, F.lit(label))
    return base.unionByName(mean_row, allowMissingColumns=True)


def drop_duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(subset) if subset else df.distinct()


def min_max_scale(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """Scale ``test`` columns to [0,1] with min/max fitted on ``train``."""
    out = test
    for c in cols:
        lo = train.agg(F.min(c)).scalar()
        hi = train.agg(F.max(c)).scalar()
        out = out.withColumn(c, (F.col(c) - lo) / (hi - lo))
    return out


def with_intercept(df: DataFrame, name: str = "intercept") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def equal_width_bin(df: DataFrame, col: str, k: int, name: str = "bin") -> DataFrame:
    """Equal-width binning into ``k`` right-closed bins over [min, max].

    Edges are min + i·(max−min)/k, the lowest edge widened by 0.1 % of the
    range so the minimum falls in bin 1. Adds ``name`` (1..k).
    """
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    width = (hi - lo) / F.lit(k)
    x = F.col(col)
    expr = None
    for i in range(1, k):
        edge = lo + width * F.lit(i)
        expr = F.when(x <= edge, F.lit(i)) if expr is None else expr.when(x <= edge, F.lit(i))
    expr = F.lit(k) if expr is None else expr.otherwise(F.lit(k))
    return df.withColumn(name, F.when(x.isNull(), F.lit(None)).otherwise(expr).cast("int"))


def bin_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """``(bin, lower, upper, count)`` for all ``k`` bins, empty bins kept."""
    spark = df.sparkSession
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    width = (hi - lo) / F.lit(k)
    counts = equal_width_bin(df, col, k).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    grid = spark.range(1, k + 1).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        F.when(F.col("bin") == 1, lo - (hi - lo) * 0.001).otherwise(lo + width * (F.col("bin") - 1)).alias("lower"),
        F.when(F.col("bin") == k, hi).otherwise(lo + width * F.col("bin")).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def one_hot(df: DataFrame, col: str, levels: list[str], keep_original: bool = True, drop_first: bool = False) -> DataFrame:
    """Dummy columns ``<col>_<level>`` (0/1) for the given levels (sorted)."""
    lv = sorted(levels)
    if drop_first:
        lv = lv[1:]
    dummies = [F.when(F.col(col) == F.lit(v), 1).otherwise(0).alias(f"{col}_{v}") for v in lv]
    base = [F.col(f"`{c}`") for c in df.columns if keep_original or c != col]
    return df.select(*base, *dummies)


def distinct_levels(df: DataFrame, col: str, max_levels: int = 10_000) -> list[str]:
    """Distinct category values of a column (driver-side list, bounded by ``max_levels``)."""
    rows = df.select(col).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; one-hot it with an indexer instead")
    return sorted(r[0] for r in rows if r[0] is not None)
