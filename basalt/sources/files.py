"""Delimited text sources: headered CSV, numeric matrices, label files, vectors, edge lists,
and a line index that restores file order without ``zipWithIndex``.

Every reader declares its schema (no inference pass) and parses with built-in expressions. Bad
rows fail the job (``mode="FAILFAST"``, ``strict``), or the ``quarantine_*`` readers keep them aside with
file, line and reason.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.plans.joins import bounded_broadcast
from basalt.session import scratch_path

MAX_SPLITS = 200_000  # file splits whose offsets are broadcast; beyond it they are joined by shuffle


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header and a declared schema (``read_csv`` without the inference scan).

    A cell that does not fit its type fails the job; ``mode="PERMISSIVE"`` turns it into NULL.
    """
    return spark.read.csv(path, header=header, schema=schema, mode=mode)


def _tokens(value: F.Column, sep_regex: str) -> F.Column:
    return F.split(F.trim(value), sep_regex)


def _numbers(tokens: F.Column, strict: bool) -> F.Column:
    if strict:
        return F.transform(tokens, lambda x: x.cast("double"))
    return F.transform(tokens, lambda x: x.try_cast("double"))


def read_vectors(
    spark: SparkSession, path: str, d: int | None = None, sep_regex: str = r"[\s,]+", strict: bool = True, name: str = "features"
) -> DataFrame:
    """One vector per text line, numbers split by commas and/or whitespace.

    ``d`` given: rows of another width fail the job (``strict``) or are left out;
    :func:`quarantine_vectors` keeps and counts them instead.
    Adds ``line`` = 0-based number among the lines that are not blank, in file order (see
    :func:`with_line_index`).
    """
    lines = with_line_index(spark, path, skip_blank=True)
    vec = lines.select("line", _numbers(_tokens(F.col("value"), sep_regex), strict).alias(name))
    if d is not None:
        ok = F.size(name) == d
        if strict:
            vec = vec.withColumn(name, F.when(ok, F.col(name)).otherwise(F.raise_error(F.lit(f"vector width is not {d}"))))
        else:
            vec = vec.where(ok)
    return vec


def read_matrix(spark: SparkSession, path: str, d: int | None = None, sep: str = " ", strict: bool = True) -> DataFrame:
    """Headerless numeric matrix (one row per line, ``sep``-separated) as one array column."""
    return read_vectors(spark, path, d=d, sep_regex=re.escape(sep) + "+", strict=strict)


def read_labels(spark: SparkSession, path: str, name: str = "y") -> DataFrame:
    """Headerless one-integer-per-line file, with its 0-based ``line`` number."""
    lines = with_line_index(spark, path, skip_blank=True)
    return lines.select("line", F.trim("value").cast("int").alias(name))


def read_edges(spark: SparkSession, path: str, sep: str = "\t", weighted: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Tab-delimited ``src dst [weight]`` integer edge list (no header)."""
    schema = "src LONG, dst LONG, weight LONG" if weighted else "src LONG, dst LONG"
    return spark.read.csv(path, sep=sep, schema=schema, mode=mode, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def read_edges_whitespace(spark: SparkSession, path: str) -> DataFrame:
    """Edge list split on any whitespace; fields after the second are ignored."""
    toks = _tokens(F.col("value"), r"\s+")
    return (
        spark.read.text(path)
        .where(F.length(F.trim("value")) > 0)
        .select(toks.getItem(0).cast("long").alias("src"), toks.getItem(1).cast("long").alias("dst"))
    )


def _numbered(spark: SparkSession, path: str, skip_blank: bool) -> DataFrame:
    """Text lines with ``_path``, ``_in_file`` (number within the file) and ``_line`` (over all files).

    Files are ordered by path, lines by position. Spark reorders file splits by size, and
    ``monotonically_increasing_id`` is not contiguous over partitions, but within one split it is,
    as blank lines are left out before it is given. So a line's number is its id less the least id
    of its split, plus the lines of all earlier splits. The tagged rows are written once, without a
    sort or a shuffle: the counts per split, their prefix sums in (path, start) order and the
    result all come from those same rows, however a later read splits the files.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    if skip_blank:
        raw = raw.where(F.length(F.trim("value")) > 0)
    raw = raw.withColumn("_m", F.monotonically_increasing_id())
    staged = scratch_path(spark, "lines")
    raw.write.parquet(staged)
    raw = spark.read.schema(raw.schema).parquet(staged)
    blocks = raw.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_least"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = blocks.groupBy("_path").agg(F.sum("_n").alias("_fn"))
    first = F.coalesce(F.sum("_fn").over(Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.select("_path", "_start", "_least", before.alias("_before")).join(files.select("_path", first.alias("_first")), "_path")
    at = f"{staged}-splits"
    offsets.write.parquet(at)
    offsets = spark.read.schema(offsets.schema).parquet(at)
    if offsets.count() <= MAX_SPLITS:  # one row per split, about 200 bytes each
        offsets = bounded_broadcast(offsets)
    in_file = F.col("_m") - F.col("_least") + F.col("_before")
    return raw.join(offsets, ["_path", "_start"]).select("value", "_path", in_file.alias("_in_file"), (F.col("_first") + in_file).alias("_line"))


def with_line_index(spark: SparkSession, path: str, name: str = "line", skip_blank: bool = False) -> DataFrame:
    """Read text lines with their 0-based line number across the files of ``path``: files ordered by
    path, lines by position; ``skip_blank`` leaves blank lines out before numbering."""
    return _numbered(spark, path, skip_blank).select(F.col("_line").cast("long").alias(name), "value")


@dataclass
class Quarantine:
    """``good``: rows that fit; ``bad``: ``file``, ``line`` (0-based, in its file), ``reason``, ``value`` of the others."""

    good: DataFrame
    bad: DataFrame

    def counts(self) -> DataFrame:
        """(reason, rows): how many rows are bad and why, and how many are ``good``; one pass over each."""
        good = self.good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("reason"), "rows")
        return self.bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).unionByName(good)


def _set_apart(lines: DataFrame, reason: F.Column, fields: list[F.Column], spark: SparkSession) -> Quarantine:
    """Write judged lines once, good and bad rows to a folder each, and read them back."""
    path = scratch_path(spark, "quarantine")
    judged = lines.withColumn("_reason", reason)
    judged.select(*fields, "_reason", F.col("_path").alias("_file"), F.col("_in_file").alias("_number"), F.col("value").alias("_value"), F.col("_reason").isNotNull().alias("_bad")).write.partitionBy("_bad").parquet(path)
    schema = T.StructType([*judged.select(*fields, "_reason", F.col("_path").alias("_file"), F.col("_in_file").alias("_number"), F.col("value").alias("_value")).schema, T.StructField("_bad", T.BooleanType())])
    rows = spark.read.schema(schema).parquet(path)
    names = [f.name for f in schema[: len(fields)]]
    bad = rows.where("_bad").select(F.col("_file").alias("file"), F.col("_number").alias("line"), F.col("_reason").alias("reason"), F.col("_value").alias("value"))
    return Quarantine(rows.where("not _bad").select(*names), bad)


def _fields_reason(tokens: F.Column, want: int) -> F.Column:
    return F.when(F.size(tokens) != want, F.format_string(f"%d fields, not {want}", F.size(tokens)))


def quarantine_vectors(spark: SparkSession, path: str, d: int, sep_regex: str = r"[\s,]+", name: str = "features") -> Quarantine:
    """Text vectors with their ``line`` (as :func:`read_vectors` numbers them, over good and bad lines),
    lines of another width or with a field that is no number kept aside."""
    tokens = _tokens(F.col("value"), sep_regex)
    numbers = _numbers(tokens, strict=False)
    reason = F.coalesce(_fields_reason(tokens, d), F.when(F.exists(numbers, lambda v: v.isNull()), F.lit("not a number")))
    return _set_apart(_numbered(spark, path, True), reason, [F.col("_line").alias("line"), numbers.alias(name)], spark)


def quarantine_edges(spark: SparkSession, path: str, sep: str = "\t", weighted: bool = True) -> Quarantine:
    """Edge lines ``src dst [weight]``, those with other fields than three (two) whole numbers kept aside."""
    names = ["src", "dst", "weight"][: 3 if weighted else 2]
    tokens = F.split(F.col("value"), re.escape(sep))
    cells = [F.trim(F.get(tokens, F.lit(i))).try_cast("long") for i in range(len(names))]
    reason = F.coalesce(_fields_reason(tokens, len(names)), *[F.when(c.isNull(), F.lit(f"{n} is no whole number")) for n, c in zip(names, cells)])
    return _set_apart(_numbered(spark, path, True), reason, [c.alias(n) for n, c in zip(names, cells)], spark)


def quarantine_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, sep: str = ",") -> Quarantine:
    """CSV rows of one line each, those that do not fit the schema kept aside with the first column
    at fault (or the number of fields). The first line of each file is its header."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField("_more", T.StringType())])
    cells = F.from_csv("value", text.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": sep, "mode": "PERMISSIVE"})
    lines = _numbered(spark, path, True)
    if header:
        lines = lines.where("_in_file > 0")
    lines = lines.withColumn("_cells", cells)
    values = [F.col("_cells")[f.name].try_cast(f.dataType) for f in schema]
    few = F.when(F.col("_cells")["_more"].isNotNull(), F.lit(f"more than {len(schema)} fields"))
    faults = [F.when(F.col("_cells")[f.name].isNotNull() & v.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for f, v in zip(schema, values)]
    return _set_apart(lines, F.coalesce(few, *faults), [v.alias(f.name) for f, v in zip(schema, values)], spark)


def align_rows(left: DataFrame, right: DataFrame, key: str = "line") -> DataFrame:
    """Pair rows of two files by line number (positional join); a row without a partner fails
    the job, so files of different length are never paired in part."""
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), key, "full_outer")
    whole = F.col("_l") & F.col("_r")
    checked = F.when(whole, F.col(key)).otherwise(F.raise_error(F.lit("row counts differ")).cast("long"))
    return both.withColumn(key, checked).drop("_l", "_r")
