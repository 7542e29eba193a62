"""Readers for raw extracts: CSV, JSON lines, Parquet and JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header; a byte-order mark is dropped.

    Without a schema every column is text, which keeps the leading zeros of codes. ``multiline`` reads
    quoted newlines; such a file cannot be split, so it is one task however long it is.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("encoding", "UTF-8")
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.csv(path)


# Types that texts are tried for, narrowest first.
TRIED = ("bigint", "double", "boolean", "timestamp_ntz")


def text_types(df: DataFrame) -> dict[str, str]:
    """Per column the narrowest type that every value of an all-text frame reads as, in one scan."""
    readable = df.agg(*[
        F.bool_and(F.col(f"`{c}`").try_cast(t).isNotNull() | F.col(f"`{c}`").isNull()).alias(f"{i}_{t}")
        for i, c in enumerate(df.columns) for t in TRIED
    ]).first()
    return {c: next((t for t in TRIED if readable[f"{i}_{t}"]), "string") for i, c in enumerate(df.columns)}


def is_all_text(df: DataFrame) -> bool:
    """True when no column of an all-string frame reads as numbers: load it as strings."""
    return not {"bigint", "double"} & set(text_types(df).values())


def load_csv_auto(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Types are inferred unless the file holds nothing but text; one scan finds them, the next one reads."""
    text = load_csv(spark, path, multiline=multiline)
    types = text_types(text)
    if not {"bigint", "double"} & set(types.values()):
        return text
    return text.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) for c in text.columns])


def csv_records(spark: SparkSession, path: str | list[str], multiline: bool = True) -> int:
    """Records, not lines: quoted newlines do not count."""
    return load_csv(spark, path, multiline=multiline).count()


def load_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """Table extract over JDBC, split into range reads on a key when bounds are known."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="100000", **options)
    if partition_column:
        lo, hi = bounds
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(partitions)
        )
    return reader.load()


def flatten_once(df: DataFrame, separator: str = "__") -> DataFrame:
    """Struct fields become ``parent__field`` columns, one level deep."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            out += [
                F.col(f"`{field.name}`.`{inner}`").alias(f"{field.name}{separator}{inner}")
                for inner in field.dataType.names
            ]
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def children_of(parents: DataFrame, children: DataFrame, parent_key: str, foreign_key: str) -> DataFrame:
    """Child rows of the extracted parents only."""
    keys = parents.select(F.col(parent_key).alias(foreign_key)).distinct()
    return children.join(keys, foreign_key, "left_semi")


def table_name(c: Column) -> Column:
    """File path as a table name: letters, digits and single underscores, no leading digit."""
    file = F.lower(F.regexp_extract(F.trim(c), r"([^/\\]*)$", 1))
    base = F.regexp_replace(file, r"(?<=.)\.[^.]*$", "")
    name = F.regexp_replace(F.regexp_replace(base, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return (
        F.when(name == "", "uploaded_table")
        .when(name.rlike("^[0-9]"), F.concat(F.lit("t_"), name))
        .otherwise(name)
    )
