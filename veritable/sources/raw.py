"""CSV scans with every column as text, and the source registry."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.text import null_if_token
from veritable.sources.schemas import ENTITIES
from veritable.sources.scratch import written


def normalize_nulls(df: DataFrame) -> DataFrame:
    """NA-like tokens become NULL in every column, in one projection."""
    return df.selectExpr(*[null_if_token(c) for c in df.columns])


#: Local paths come with one slash or three.
_LOCAL = re.compile("^file:/+")
_WHOLE_LINE, _FILE, _BLOCK = "_whole_line", "_file", "_block"
#: What ``governance.raw_rejects`` says of a line that would lose cells.
LINE_REJECTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("source_file", "line", "reason")])


def _lossy(schema: T.StructType) -> dict[str, Column]:
    """Faults of a line that would lose cells. Spark keeps the text of lines of another length."""
    line = F.col(_WHOLE_LINE)
    extra = ", ".join(f"`{name}` string" for name in [*schema.names, "_extra"])
    return {
        "too many cells": F.from_csv(line, extra, {"escape": '"'})["_extra"].isNotNull(),
        "unclosed quote": F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1,
    }


def _accepted(schema: T.StructType) -> Column:
    """True, or an error that quotes the line."""
    line, first = F.col(_WHOLE_LINE), F.col(f"`{schema.names[0]}`")
    told = F.raise_error(F.concat_ws(" ", F.lit("malformed line of"), first, F.lit(":"), line))
    lossy = reduce(lambda a, b: a | b, _lossy(schema).values())
    return F.when(line.isNotNull() & lossy, told.cast("boolean")).otherwise(
        F.coalesce(first, F.lit("")).isNotNull())


def line_faults(schema: T.StructType) -> Column:
    """All reasons why a line of ``read_lines`` cannot be taken; an empty array if it can."""
    faults = [
        F.when(F.col(_WHOLE_LINE).isNotNull() & lossy, F.struct(
            F.col(_FILE).alias("source_file"), F.col(_WHOLE_LINE).alias("line"),
            F.lit(reason).alias("reason")))
        for reason, lossy in _lossy(schema).items()
    ]
    return F.filter(F.array(*faults), lambda f: f.isNotNull())


def read_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False,
) -> DataFrame:
    """Every line as cells, with its text if it has another length and the file that it is from.

    For ``Store.write_split`` with ``line_faults``: good rows and refused lines in one scan.
    """
    lines = _scan(spark, path, schema, multi_line)
    return lines.selectExpr(
        *[null_if_token(c) for c in schema.names], _WHOLE_LINE, f"_metadata.file_path AS {_FILE}",
        f"_metadata.file_block_start AS {_BLOCK}")


def _scan(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(_WHOLE_LINE, T.StringType())])
    return (
        spark.read.schema(whole if mode == "PERMISSIVE" else schema)
        .option("columnNameOfCorruptRecord", _WHOLE_LINE)
        .option("columnPruning", False)  # else a line is as long as the columns that are asked for
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
        .csv(path)
    )


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType,
    multi_line: bool = False, mode: str = "PERMISSIVE",
) -> DataFrame:
    """Scan CSV files that have a header line; quotes inside a value are doubled.

    The header must name the schema's columns, else the scan fails. Files stay splittable
    unless ``multi_line`` says that quoted values hold line breaks. A short line is filled with
    NULLs; ``mode="FAILFAST"`` refuses lines with another number of cells. A line with too many
    cells, or with a quote that the line does not close, is refused in any mode, since parts of it
    would be lost (a quote left open in the last cell loses none: it is part of that cell); ``read_lines`` lets such a line be put aside instead.
    """
    raw = _scan(spark, path, schema, multi_line, mode)
    if mode == "PERMISSIVE":
        raw = raw.where(_accepted(schema)).select(schema.names)
    return normalize_nulls(raw)


def number_rows(lines: DataFrame, paths: Sequence[str] | None = None) -> DataFrame:
    """``read_lines`` with ``row_number``: the line's place among all data lines, from 0.

    Files come in the order of ``paths``, or else by name, and lines as they stand in them, however
    Spark cut the files. Every split of a file numbers its own lines; the splits' counts, one row per
    split, are summed up to the split before. The lines are written once, with the number that they
    have in their task, so that a repeated task cannot number them anew.
    """
    at = written(lines.select(
        "*", F.monotonically_increasing_id().alias("_at")), "lines")
    split = [_FILE, _BLOCK]
    counts = at.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    place = F.col(_FILE)
    if paths is not None:
        given = F.array(*[F.lit(_LOCAL.sub("file:/", file))
                          for file in qualified(lines.sparkSession, paths)])
        file = F.regexp_replace(_FILE, _LOCAL.pattern, "file:/")
        place = F.struct(F.array_position(given, file).alias("given"), F.col(_FILE))
    in_file = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(_FILE).agg(F.sum("n").alias("total"))
    in_order = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = totals.select(_FILE, F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("ahead"))
    starts = written(
        counts.withColumn("before", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
        .join(files, _FILE).select(*split, "first", (F.col("ahead") + F.col("before")).alias("start")),
        "starts")
    number = F.col("start") + F.col("_at") - F.col("first")
    return at.join(starts, split).withColumn("row_number", number).drop("_at", "first", "start", _BLOCK)


def qualified(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths of single files with the scheme and host that a scan reports."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    settings = spark._jsc.hadoopConfiguration()
    return [p.getFileSystem(settings).makeQualified(p).toUri().toString() for p in found]


def default_paths(data_dir: str) -> dict[str, str]:
    return {name: f"{data_dir}/erp_{name}.csv" for name in ENTITIES}


def read_all(
    spark: SparkSession, paths: Mapping[str, str | list[str]],
    multi_line: bool = False, mode: str = "PERMISSIVE",
) -> dict[str, DataFrame]:
    """Every registered entity found in ``paths`` as a frame of text columns."""
    return {
        name: read_csv(spark, path, ENTITIES[name].raw_schema, multi_line, mode)
        for name, path in paths.items()
    }
