"""Sentinels, types, missing values and labels of an input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.expressions import binary_label, to_int
from sieveline.operators.ranks import exact_medians

MISSING = "?"


def columns_of_type(df: DataFrame, type_name: str) -> list[str]:
    """Names of the columns whose short type name matches, for instance ``string``."""
    return [name for name, kind in df.dtypes if kind == type_name]


def _rewrite(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns in one projection; ``CollapseProject`` then has nothing to collapse."""
    missing = sorted(changes.keys() - set(df.columns))
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    return df.withColumns(changes) if changes else df


def sentinel_to_null(df: DataFrame, token: str = MISSING, columns: list[str] | None = None) -> DataFrame:
    """Null wherever a string column holds the token, blanks around it aside."""
    columns = columns_of_type(df, "string") if columns is None else columns
    return _rewrite(df, {c: F.when(F.trim(F.col(c)) != token, F.col(c)) for c in columns})


def cast_to_int(df: DataFrame, columns: list[str]) -> DataFrame:
    """INT columns; text that is no number becomes null instead of failing the job."""
    return _rewrite(df, {c: to_int(F.col(c)) for c in columns})


def cast_to_double(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rewrite(df, {c: F.col(c).try_cast("double") for c in columns})


def null_profile(df: DataFrame, columns: list[str] | None = None, nan_as_null: bool = False) -> DataFrame:
    """(column_name, nulls, total) for all columns from one aggregate over one scan."""
    columns = df.columns if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, nulls long, total long")
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        absent = F.col(c).isNull()
        return absent | F.isnan(c) if nan_as_null and kinds[c] in ("double", "float") else absent

    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(missing(c)).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col("total"))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _sparse(profile: DataFrame, threshold: float) -> list[str]:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("the null threshold must lie between 0 and 1")
    over = profile.where(F.col("nulls") > F.lit(float(threshold)) * F.col("total"))
    return [r["column_name"] for r in over.collect()]


def drop_sparse_columns(
    df: DataFrame, columns: list[str], threshold: float = 0.5, nan_as_null: bool = False
) -> DataFrame:
    """Drop the listed columns whose null share is strictly above the threshold."""
    return df.drop(*_sparse(null_profile(df, columns, nan_as_null), threshold))


def median_values(
    df: DataFrame, columns: list[str], method: str = "approx", error: float = 0.01
) -> dict[str, float | None]:
    """Median per column.

    ``approx``: an observed value within the relative rank error, one sketch job for all columns;
    ``lower``: the exact lower middle value, what ``approx`` gives for an error of 0;
    ``exact``: the exact median, halfway between the two middle values of an even count.
    """
    if method not in ("approx", "lower", "exact"):
        raise ValueError("method must be approx, lower or exact")
    if not columns:
        return {}
    if method == "approx" and error > 0:
        found = df.approxQuantile(columns, [0.5], error)
        return {c: values[0] if values else None for c, values in zip(columns, found)}
    return exact_medians(df, columns, interpolated=method == "exact")


def fill_missing(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Fill nulls (and NaN) per column. A fractional value is cut off in an integer column."""
    known = {c: v for c, v in values.items() if v is not None and c in df.columns}
    return df.fillna(known) if known else df


def impute_median(
    df: DataFrame, columns: list[str], method: str = "approx", error: float = 0.01, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill nulls with medians of ``fit_on``, by default of the table itself."""
    return fill_missing(df, median_values(df if fit_on is None else fit_on, columns, method, error))


def handle_missing(
    df: DataFrame,
    columns: list[str],
    threshold: float = 0.5,
    method: str = "approx",
    error: float = 0.01,
    fit_on: DataFrame | None = None,
    nan_as_null: bool = False,
) -> DataFrame:
    """Drop the sparse ones of the listed columns and fill the others: two jobs for any number.

    Filling always reaches NaN too; with ``nan_as_null`` it also counts as missing when a column is judged.
    """
    base = df if fit_on is None else fit_on
    sparse = set(_sparse(null_profile(base, columns, nan_as_null), threshold))
    kept = [c for c in columns if c not in sparse]
    return impute_median(df.drop(*sparse), kept, method, error, base)


def binarize_label(df: DataFrame, column: str, negative_value=1, output: str | None = None) -> DataFrame:
    """0 where the column equals ``negative_value``, else 1."""
    return df.withColumn(output or column, binary_label(F.col(column), negative_value))


def project_features(df: DataFrame, features: list[str], label: str | None = None) -> DataFrame:
    """The listed features and the label, nothing else, so that pruning reaches the scan."""
    return df.select(*features, *([label] if label else []))
