"""CSV scan of many files, unioned by their headers, and their column types."""

from __future__ import annotations

import csv as _csv
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import INFER_ROWS, NULL_TOKENS
from ..functions.text import null_tokens
from ..operators.reshape import union_by_name


def csv_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files that ``path`` (a file, folder or glob) names, by folder; only names are listed, no file is opened.

    Spark's driver lists the files of any scan, so their names are what it holds anyway.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    folders = files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.sort_array(F.collect_list("path")).alias("files"))
    return {r["folder"]: list(r["files"]) for r in folders.orderBy("folder").collect()}


def csv_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of the files that ``path`` names."""
    return list(csv_files(spark, path))


def _exactly(path: str) -> str:
    """A path that Spark reads as it is, whatever glob characters are in it."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def scan_csv(spark: SparkSession, path: str, groups: dict[str, Iterable[str]] | None = None,
             sep: str = ",", tokens: Iterable[str] = NULL_TOKENS, multi_line: bool = True) -> DataFrame:
    """S1+S2+P1: every CSV file that ``path`` names and no other, unioned by column name.

    Quoting is RFC 4180: a quote inside a quoted value is doubled, and a value
    may hold newlines unless ``multi_line`` is off. (A file with newlines in
    values cannot be split, so large inputs should be many files; without them
    switch ``multi_line`` off and files are split.) Columns are text; typed use
    goes through ``try_cast`` or ``typed``. The files of one folder have one
    header, read from one of them and checked against each, so a differing file
    fails loudly. Folders of one header are one scan; unlike ones are unioned by
    name with missing columns as null, and the null tokens become null.
    ``groups`` (header line -> files) is for files of unlike headers in one folder
    and for names with glob characters, whose headers Spark does not find (it fails).
    """
    def reader():
        return (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
                .option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False))

    alike: dict[tuple[str, ...], list[str]] = {}
    if groups is None:
        for files in csv_files(spark, path).values():
            exact = [_exactly(f) for f in files]
            alike.setdefault(tuple(reader().csv(exact[0]).columns), []).extend(exact)
    else:
        for header, files in sorted(groups.items()):
            alike.setdefault(tuple(next(_csv.reader([header], delimiter=sep))), []).extend(map(_exactly, files))
    if not alike:
        raise FileNotFoundError(f"no CSV files under {path}")
    frames = [reader().schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(files)
              for names, files in alike.items()]
    return null_tokens(union_by_name(frames), tokens)


def _fits(value: Column, kind: str) -> Column:
    """Whether a text is a value of the type; null for a null."""
    if kind == "boolean":
        return value.isin("true", "false")
    number = r"^[+-]?[0-9]+$" if kind == "bigint" else r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return value.rlike(number) & value.try_cast(kind).isNotNull()


#: Types in the order in which they are tried.
TYPES = ("boolean", "bigint", "double")


def infer_types(scanned: DataFrame, rows: int = INFER_ROWS) -> dict[str, str]:
    """A type for each column of a text scan, from its first ``rows`` rows: the first of boolean, bigint and double
    that all their values fit, else (and without a value) string."""
    texts = [f.name for f in scanned.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    column = lambda c: F.col(f"`{c}`")
    row = scanned.limit(rows).agg(*[F.bool_and(_fits(column(c), kind)).alias(f"{i}_{kind}")
                                    for i, c in enumerate(texts) for kind in TYPES]).first()
    return {c: next((kind for kind in TYPES if row[f"{i}_{kind}"]), "string") for i, c in enumerate(texts)}


def typed(scanned: DataFrame, types: dict[str, str]) -> DataFrame:
    """The scan with its columns cast; a value that does not fit its column's type is null (see ``misfits``)."""
    return scanned.select(*[
        F.when(_fits(F.col(f"`{c}`"), types[c]), F.col(f"`{c}`").try_cast(types[c])).alias(c)
        if types.get(c, "string") != "string" else F.col(f"`{c}`") for c in scanned.columns])


def misfits(scanned: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column, type, misfits, example): values that ``typed`` leaves out, for each column that has a type.

    The sample may not have shown them; all rows are counted, in one pass.
    """
    named = [c for c in scanned.columns if types.get(c, "string") != "string"]
    if not named:
        return scanned.sparkSession.createDataFrame([], "column string, type string, misfits bigint, example string")
    wrong = {c: ~_fits(F.col(f"`{c}`"), types[c]) for c in named}
    counted = scanned.agg(*[F.count_if(wrong[c]).alias(f"n{i}") for i, c in enumerate(named)],
                          *[F.min(F.when(wrong[c], F.col(f"`{c}`"))).alias(f"e{i}") for i, c in enumerate(named)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"n{i}").alias("misfits"),
                 F.col(f"e{i}").alias("example")) for i, c in enumerate(named)])))
