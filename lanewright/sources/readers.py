"""Model tables, shipment history and side inputs as DataFrames."""

from __future__ import annotations

import csv
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewright.functions.nulls import blank_to_null, to_double
from lanewright.specs import MODEL_TABLES, UNREADABLE, SideInputSpec, TableSpec


def read_model(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(MODEL_TABLES),
    *,
    fmt: str = "parquet",
    column_names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """One lazy DataFrame per table under ``root``, typed, without ``id``.

    ``column_names`` maps names used by an existing model to those used here.
    """
    return {
        name: typed_model_table(
            spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}"),
            MODEL_TABLES[name],
            column_names,
        )
        for name in names
    }


def read_model_jdbc(
    spark: SparkSession,
    url: str,
    names: Iterable[str] = tuple(MODEL_TABLES),
    *,
    partitioning: Mapping[str, Mapping[str, str]],
    small: Collection[str] = ("periods",),
    properties: Mapping[str, str] | None = None,
    column_names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The same from a database.

    ``partitioning`` gives per table the ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` of a parallel read. Only tables named
    ``small`` may go without, since one task then reads all of them.
    """
    names = list(names)
    unplanned = [n for n in names if n not in partitioning and n not in small]
    if unplanned:
        raise ValueError(f"no partitioned read given for {unplanned}")
    tables = {}
    for name in names:
        options = {**(properties or {}), **partitioning.get(name, {})}
        raw = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        tables[name] = typed_model_table(
            raw.options(**options).load(), MODEL_TABLES[name], column_names
        )
    return tables


def typed_model_table(
    df: DataFrame, spec: TableSpec, column_names: Mapping[str, str] | None = None
) -> DataFrame:
    """Drop the surrogate id, rename, and turn numeric text into doubles."""
    df = df.drop("id")
    if column_names:
        present = {old: new for old, new in column_names.items() if old in df.columns}
        df = df.withColumnsRenamed(present)
    numbers = {c: to_double(F.col(c)) for c in spec.numeric if c in df.columns}
    return df.withColumns(numbers) if numbers else df


def read_side_input(
    spark: SparkSession,
    path: str,
    spec: SideInputSpec,
    *,
    fmt: str = "csv",
    headers: Mapping[str, str] | None = None,
    list_unreadable: bool = False,
    more: str | None = None,
) -> DataFrame:
    """A hand-kept table, as CSV (``fmt="csv"``) or as a typed file format.

    CSV is read as text with a declared schema. Lines above the header and the
    header itself are skipped by position. ``headers`` adds or overrides header
    texts of ``spec.columns``. ``more`` is a folder of further CSV files of the same
    columns without a header, for sheets too large for one file: a task reads a
    file, since quoted cells may hold line breaks. Numbers that cannot be read become null; with
    ``list_unreadable`` they are listed in the column ``UNREADABLE``, which the
    gate reports.
    """
    columns = {**spec.columns, **(headers or {})}
    if fmt == "csv":
        raw = _read_csv_with_offset(spark, path, spec.header_row, more).dropna("all")
    else:
        raw = spark.read.format(fmt).load(path)
    return typed_side_input(raw, spec, columns, list_unreadable)


def typed_side_input(
    raw: DataFrame, spec: SideInputSpec, columns: Mapping[str, str] | None = None, list_unreadable: bool = False
) -> DataFrame:
    """Plan names, text keys with nulls kept as nulls, numbers as doubles."""
    columns = columns or {c: c for c in spec.columns.values()}
    present = [(old, new) for old, new in columns.items() if old in raw.columns]

    def cell(old: str, new: str):
        value = F.col(f"`{old}`")
        if new in spec.numeric:
            return to_double(value).alias(new)
        return blank_to_null(value).alias(new)

    cells = [cell(old, new) for old, new in present]
    if list_unreadable:
        bad = [
            F.when(
                blank_to_null(F.col(f"`{old}`")).isNotNull() & to_double(F.col(f"`{old}`")).isNull(),
                F.struct(
                    F.lit(new).alias("column_name"), F.col(f"`{old}`").cast("string").alias("value")
                ),
            )
            for old, new in present
            if new in spec.numeric
        ]
        none = F.array().cast("array<struct<column_name:string,value:string>>")
        cells.append((F.array_compact(F.array(*bad)) if bad else none).alias(UNREADABLE))
    return raw.select(*cells)


HEADER_LINES = 200  # lines looked at for the header


def _read_csv_with_offset(
    spark: SparkSession, path: str, header_row: int, more: str | None = None
) -> DataFrame:
    """One file, read as text by position, and the rows of the files in ``more``.

    Rows up to the header are left out by their place in the file, so a row that
    repeats one of them stays. Blank header cells become placeholder columns, so
    the cells to the right keep theirs. Quoted cells may hold line breaks.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) > 1:
        raise ValueError(f"{path} is more than one file; give one file per input")
    head = [row["value"] for row in lines.take(HEADER_LINES + header_row)]
    rows = list(csv.reader(line + "\n" for line in head))
    if len(rows) <= header_row:
        raise ValueError(f"{path} has no header in line {header_row + 1}")
    # The CSV source leaves out empty lines, so they have no place among its rows.
    place = sum(1 for row in rows[:header_row] if row)
    cells = [c.strip().lstrip("\ufeff") for c in rows[header_row]]
    names = [c or f"__blank_{i}" for i, c in enumerate(cells)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    form = {"header": False, "multiLine": True, "quote": '"', "escape": '"'}
    body = spark.read.schema(schema).csv(path, **form)
    body = body.withColumn("__place", F.monotonically_increasing_id())
    body = body.filter(F.col("__place") > place).drop("__place")
    if more is not None:
        body = body.unionByName(spark.read.schema(schema).csv(more, **form))
    return body.select(*[blank_to_null(F.col(f"`{n}`")).alias(n) for n, c in zip(names, cells) if c])
