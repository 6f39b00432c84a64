"""Bronze scan of landed CSV snapshots.

Spark aligns CSV columns by position, so files with different headers must not
share a read. One distributed pass takes the first line of every file; files
are grouped by it, each group is read all-STRING under its own header (no
inference pass, no wrong type for an all-NULL column; line breaks, commas and
doubled quotes inside quoted text), and the groups are aligned by name with
``unionByName(allowMissingColumns=True)``. Each row is tagged with its file
name; pandas' default missing-value tokens become NULL. A file without a
readable first line is skipped; ``skipped_files`` names it.

``scan_split`` gives the same rows for files of any size: a file is read by as many
tasks as it has splits, and its bytes once. A line break lies inside quotes if an odd
number of quotes stands before it in the file. A task does not know how many stand
before its split, so it numbers its lines for both cases; one row per split then says
which case holds, and only lines that are not a record by themselves are shuffled and
joined. This asks for quotes as RFC 4180 has them (quoted fields, doubled inside).
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse import constants as K
from quotefuse.schemas import RAW_QUOTE
from quotefuse.session import scratch_path

FILE_COL, PATH_COL, POS_COL = "fichier_source", "_qf_path", "_qf_pos"
_LINE = ("path string, file string, at long, n long, inside boolean, even long, odd long, quotes long, value string")


def _present(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist."""
    out = []
    for p in paths:
        fp = spark._jvm.org.apache.hadoop.fs.Path(p)  # noqa: SLF001
        if fp.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fp):  # noqa: SLF001
            out.append(p)
    return out


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and first line of every file with a readable one."""
    lines = (spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
             .where(F.col("at") == 0))
    # a file's first split is read in order by one task, so its first row has the least id
    first = lines.withColumn("id", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "id").alias("line"))
    return first.select("path", F.regexp_replace("line", "^\ufeff|\r$", "").alias("line")).where(F.col("line") != "")


def column_names(line: str) -> list[str]:
    """Names in a header line; a repeated name gets a number (as pandas does)."""
    out: list[str] = []
    for i, name in enumerate(next(csv.reader([line]))):
        name, n = name.strip() or f"Unnamed: {i}", 0
        while (tag := f"{name}.{n}" if n else name) in out:
            n += 1
        out.append(tag)
    return out


def scan_group(spark: SparkSession, paths: list[str] | str, columns: list[str],
               na_tokens: Iterable[str] = K.PANDAS_NA_TOKENS) -> DataFrame:
    """Files that share one header."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = (spark.read.schema(schema).option("header", "true").option("encoding", "UTF-8")
          .option("multiLine", "true").option("quote", '"').option("escape", '"').option("enforceSchema", "true")
          .option("ignoreCorruptFiles", "true").option("mode", "PERMISSIVE").csv(paths))
    tokens = list(na_tokens)
    clean = [F.when(F.col(f"`{c}`").isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
             for c in columns if c != FILE_COL]
    return df.select(*clean, F.col("_metadata.file_name").alias(FILE_COL), F.col("_metadata.file_path").alias(PATH_COL))


def scan_bronze(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Every CSV file below ``paths``, columns aligned by name; without any
    readable file an empty frame with the quote columns as text."""
    there = _present(spark, paths)
    groups = headers(spark, there).groupBy("line").agg(
        F.sort_array(F.collect_list("path")).alias("paths")).orderBy("line").collect() if there else []
    out = None
    for g in groups:
        part = scan_group(spark, [unquote(p) for p in g["paths"]], column_names(g["line"]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        names = [f.name for f in RAW_QUOTE.fields if f.name != FILE_COL] + [FILE_COL, PATH_COL]
        out = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return out


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line below ``paths``, in one pass over the bytes: its file and split (``at``),
    its number there, whether an odd number of quotes stands before it in the split
    (``inside``), the lines so far in both cases (``even``, ``odd``), and its own quotes.
    A split's lines come in order to one task."""

    def number(batches):
        key, before, n, even, odd = None, 0, 0, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column("at").to_numpy()
            paths = b.column("path")
            code = paths.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            quotes = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.flatnonzero((at[1:] != at[:-1]) | (code[1:] != code[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                if key != (here := (paths[s].as_py(), int(at[s]))):
                    key, before, n, even, odd = here, 0, 0, 0, 0
                own = quotes[s:e]
                total = before + np.cumsum(own)
                inside = (total - own) % 2 == 1
                evens, odds, numbers = even + np.cumsum(~inside), odd + np.cumsum(inside), n + 1 + np.arange(e - s)
                part = b.slice(s, e - s)
                yield pa.RecordBatch.from_arrays(
                    [part.column("path"), part.column("file"), part.column("at"), pa.array(numbers), pa.array(inside),
                     pa.array(evens), pa.array(odds), pa.array(own), part.column("value")],
                    ["path", "file", "at", "n", "inside", "even", "odd", "quotes", "value"])
                before, n, even, odd = int(total[-1]), int(numbers[-1]), int(evens[-1]), int(odds[-1])

    raw = (spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("lineSep", "\n").text(paths)
           .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
                   F.col("_metadata.file_block_start").alias("at"), "value"))
    path = scratch_path(spark, "csv_lines")
    raw.mapInArrow(number, _LINE).write.parquet(path)
    return spark.read.schema(_LINE).parquet(path)


def records(spark: SparkSession, paths: list[str], record_lines: int = 100_000, broadcast_rows: int = 200_000) -> DataFrame:
    """path, file, pos (grows with the place in the file, 1 for its first record) and text of
    every CSV record. Lines of a record are joined by a line feed; empty lines are none. A quote that is
    never closed would make the rest of its file one record: over ``record_lines`` lines are an error."""
    rows = lines(spark, paths)
    splits = rows.groupBy("path", "at").agg(F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = splits.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    opens = F.when(F.col("open"), F.col("odd")).otherwise(F.col("even"))
    last = F.last(F.when(opens > 0, F.col("at") + opens), ignorenulls=True).over(before)
    path = scratch_path(spark, "csv_splits")
    splits.select("path", "at", "open", last.alias("owner")).write.parquet(path)
    known = spark.read.parquet(path)
    known = F.broadcast(known) if known.count() <= broadcast_rows else known
    # a split has fewer lines than bytes, so its offset and a number in it make one position
    mine = F.when(F.col("open"), F.col("odd")).otherwise(F.col("even"))
    tagged = (rows.join(known, ["path", "at"]).withColumn("pos", F.when(mine > 0, F.col("at") + mine).otherwise(F.col("owner")))
              .withColumn("value", F.regexp_replace("value", "\r$", "")))
    alone = (F.col("inside") == F.col("open")) & (F.col("quotes") % 2 == 0)
    ones = tagged.where(alone).select("path", "file", "pos", F.col("value").alias("text"))
    parts = tagged.where(~alone)
    long = (parts.groupBy("path", "pos").count().where(F.col("count") > record_lines)).select("path").distinct().take(5)
    if long:
        raise ValueError(f"records of more than {record_lines} lines (a quote that is not closed?): {[r['path'] for r in long]}")
    whole = parts.groupBy("path", "file", "pos").agg(F.array_sort(F.collect_list(F.struct("at", "n", "value"))).alias("v"))
    joined = whole.select("path", "file", "pos", F.array_join(F.transform("v", lambda x: x["value"]), "\n").alias("text"))
    return ones.unionByName(joined)


def scan_split(spark: SparkSession, paths: Iterable[str], na_tokens: Iterable[str] = K.PANDAS_NA_TOKENS, **limits) -> DataFrame:
    """``scan_bronze`` for files of any size, with ``POS_COL``: a number that grows with the
    place of the row in its file."""
    there = _present(spark, paths)
    rows = records(spark, there, **limits) if there else None
    heads = (rows.where(F.col("pos") == 1).select("path", F.regexp_replace("text", "^\ufeff", "").alias("head"))
             .where(F.col("head") != "") if there else None)
    groups = [r["head"] for r in heads.select("head").distinct().orderBy("head").collect()] if there else []
    out, tokens = None, list(na_tokens)
    for head in groups:
        names = column_names(head)
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
        body = (rows.where((F.col("pos") > 1) & (F.col("text") != ""))
                .join(heads.where(F.col("head") == F.lit(head)).select("path"), "path", "left_semi"))
        body = body.select("path", "file", "pos", F.from_csv("text", ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema),
                                                            {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("_qf_row"))
        clean = [F.when(F.col(f"_qf_row.`{c}`").isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(f"_qf_row.`{c}`")).alias(c)
                 for c in names if c != FILE_COL]
        part = body.select(*clean, F.col("file").alias(FILE_COL), F.col("path").alias(PATH_COL), F.col("pos").alias(POS_COL))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        out = scan_bronze(spark, []).withColumn(POS_COL, F.lit(None).cast("long"))
    return out


def skipped_files(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Files that the scan leaves out: empty, or without a readable first line."""
    there = _present(spark, paths)
    if not there:
        return []

    def plain(p: str) -> str:
        return unquote(p).replace("file:///", "file:/")

    seen = {plain(r["path"]) for r in headers(spark, there).select("path").toLocalIterator()}
    listed = spark.read.option("recursiveFileLookup", "true").text(there).inputFiles()
    return sorted(p for p in map(plain, listed) if p not in seen)
