"""Headerless delimited input with positional names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TARGET = "target"


def positional_names(n: int) -> list[str]:
    """``feature_1 .. feature_{n-1}`` and, for the last column, ``target``."""
    if n < 1:
        raise ValueError("a table needs at least one column")
    return [f"feature_{i}" for i in range(1, n)] + [TARGET]


def rename_by_position(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Give every column a new name in one projection."""
    names = positional_names(len(df.columns)) if names is None else names
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def read_headerless_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """Scan a CSV file set without header and name its columns by position.

    Give a ``schema`` for big inputs. ``infer=True`` reads the text once more to guess types;
    with neither, every column is a string.
    """
    reader = spark.read.option("header", False)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return rename_by_position(reader.csv(path))


#: Forms of whole numbers and of numbers; other texts make a column text.
WHOLE, NUMBER = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def inferred_types(table: DataFrame, columns: list[str], sentinel: str | None = "?") -> dict[str, str]:
    """``int``, ``bigint``, ``double`` or ``string`` for each text column: the narrowest that holds all its values.

    Nulls, blank texts and the sentinel say nothing about the type; a column of nothing else is text. One aggregate over one scan,
    whatever the number of columns. Blanks around a value do not count.
    """
    if not columns:
        return {}
    checks = []
    for i, c in enumerate(columns):
        value = F.trim(F.col(f"`{c}`"))
        seen = value.isNotNull() & (value != "") & ((value != sentinel) if sentinel is not None else F.lit(True))
        whole, number = value.rlike(WHOLE), value.rlike(NUMBER)
        # the least type of a value by its place in the lattice; the column takes the largest
        place = (
            F.when(whole & value.try_cast("int").isNotNull(), 0)
            .when(whole & value.try_cast("bigint").isNotNull(), 1)
            .when(number, 2)
            .otherwise(3)
        )
        checks.append(F.max(F.when(seen, place)).alias(f"t{i}"))
    row = table.agg(*checks).first()
    names = ("int", "bigint", "double", "string")
    return {c: names[3 if row[f"t{i}"] is None else row[f"t{i}"]] for i, c in enumerate(columns)}


def read_inferred_csv(spark: SparkSession, path: str, sentinel: str | None = "?") -> DataFrame:
    """A headerless CSV with positional names, sentinels as nulls and the narrowest types that hold the rest.

    A reader that infers types takes a column with a sentinel for text; here it comes out numeric at once.
    """
    text = read_headerless_csv(spark, path)
    found = inferred_types(text, text.columns, sentinel)
    cells = []
    for c in text.columns:
        value = F.trim(F.col(f"`{c}`")) if found[c] != "string" else F.col(f"`{c}`")
        missing = F.trim(F.col(f"`{c}`")) == (sentinel if sentinel is not None else "")
        cells.append(F.when(~missing, value).try_cast(found[c]).alias(c))
    return text.select(*cells)
