"""CSV exports: write, read by header name, and check readiness."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.text import NULL_TOKENS, null_tokens_to_null
from tally.schema import SourceSpec


# One dialect for writing and reading: a quote inside a quoted cell is doubled
# and a backslash is an ordinary character.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
MALFORMED = "_malformed"
_RECORD = "_record"
#: Different headers of one folder, each a branch of the plan; more are taken for a folder that holds something else.
MOST_HEADERS = 50


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write an export as header CSV, keeping leading/trailing spaces."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def read_csv_text(spark: SparkSession, path: str | list[str],
                  null_tokens: tuple[str, ...] = NULL_TOKENS, multi_line: bool = False,
                  one_header: bool = False) -> DataFrame:
    """Read header CSVs with every column as text, named by the header.

    Of a folder, each file is read by its own header: columns that stand in
    another order are united by name, and a column that a file lacks is NULL
    in its rows. For this the headers are looked up in one pass over the files
    first; ``one_header`` says that all files share a header and saves
    the pass (a file that differs then stops the read). No types are inferred:
    ids keep leading zeros and a bad cell cannot fail the read. Cells
    holding a null token become NULL. ``_malformed`` marks rows with more fields
    than the header; missing fields at a row's end are NULL. ``multi_line``
    allows line breaks inside quoted cells (files are then not split, and
    must share a header).
    """
    if not one_header and not multi_line:
        lines = csv_lines(spark, path)
        if len(lines.inputFiles()) > 1:
            heads = file_headers(lines)
            found = [r["head"] for r in heads.select("head").distinct().limit(MOST_HEADERS + 1).collect()]
            if len(found) > MOST_HEADERS:
                raise ValueError(f"more than {MOST_HEADERS} different headers in {path}")
            if len(found) > 1:
                return parse_lines(lines, heads, sorted(found), null_tokens).drop("_file")
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    names = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RECORD]])
    df = (spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema)
          .option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", _RECORD).csv(path))
    return df.select(*[null_tokens_to_null(F.col(f"`{c}`"), null_tokens).alias(c) for c in names],
                     _too_long(F.col(_RECORD), len(names)).alias(MALFORMED))


def _too_long(record: Column, fields: int | Column) -> Column:
    """Whether a line has more fields than the header."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.coalesce(commas >= fields, F.lit(False))


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of files that are not blank: value, _file, _start (of its block), _at (order within the block)."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"))


def file_headers(lines: DataFrame) -> DataFrame:
    """_file, head, head_at: the first line of every file, found where the file is read."""
    first = F.min(F.struct("_at", "value")).alias("first")
    return lines.filter("_start = 0").groupBy("_file").agg(first).select(
        "_file", F.col("first.value").alias("head"), F.col("first._at").alias("head_at"))


def parse_lines(lines: DataFrame, heads: DataFrame, headers: list[str],
                null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Lines as rows by their own file's header, united by name, with ``_malformed`` and ``_file``.

    ``headers`` are the header lines that occur (lines of files with another one are left out).
    """
    columns = {h: header_columns(h) for h in headers}
    names = list(dict.fromkeys(c for h in headers for c in columns[h]))
    # One row a file, of files that the driver lists anyway: the lines stay where they are read.
    rows = lines.join(F.broadcast(heads), "_file").filter((F.col("_at") != F.col("head_at")) & F.col("head").isin(headers))
    parsed = []
    for k, h in enumerate(headers):
        cells = ", ".join(f"c{j} string" for j in range(len(columns[h])))
        own = F.col("head") == F.lit(h)
        parsed.append(F.when(own, F.from_csv("value", F.lit(cells), CSV_OPTIONS)).alias(f"p{k}"))
    fields = F.coalesce(*[F.when(F.col("head") == F.lit(h), F.lit(len(columns[h]))) for h in headers])
    rows = rows.select("_file", _too_long(F.col("value"), fields).alias(MALFORMED), *parsed)

    def named(c: str) -> Column:
        return F.coalesce(*[F.col(f"p{k}.c{columns[h].index(c)}") for k, h in enumerate(headers) if c in columns[h]])
    return rows.select(*[null_tokens_to_null(named(c), null_tokens).alias(c) for c in names], MALFORMED, "_file")


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a file's URI names, as readers take it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def header_columns(line: str) -> list[str]:
    """Column names of a header line."""
    return next(csv.reader([line.removeprefix("\ufeff")]), [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of our own."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def map_to_common(df: DataFrame, spec: SourceSpec,
                  carry: dict[str, str] | None = None) -> DataFrame:
    """Rename the export's columns to the common names, keep only those,
    and add the source constant (the reader's projection).

    ``carry`` keeps further file columns under a new name, e.g. the card
    provider's ``merchant_category`` as ``provider_category``. The mark of
    malformed rows stays where the reader made one.
    """
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in spec.column_map.items()]
    extra = [F.col(f"`{src}`").alias(dst) for src, dst in (carry or {}).items()]
    mark = [F.col(MALFORMED)] if MALFORMED in df.columns else []
    return df.select(*cols, F.lit(spec.name).alias("source"), *extra, *mark)


def read_source(spark: SparkSession, path: str | list[str], spec: SourceSpec, multi_line: bool = False,
                carry: dict[str, str] | None = None) -> DataFrame:
    """Bank or card CSV scan: read by header, rename, project, tag."""
    return map_to_common(read_csv_text(spark, path, multi_line=multi_line), spec, carry)


def file_readiness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per source: does the path exist and hold at least one non-empty file.

    A metadata call on the cluster file system (file count and total length
    of the path, a folder or a single file); no file content is read. A
    missing path gives ``missing``; zero total bytes give ``empty``.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for source, path in paths.items():
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(conf)
        if not fs.exists(jpath):
            rows.append((source, path, "missing", 0, 0))
            continue
        summary = fs.getContentSummary(jpath)
        n_files, n_bytes = int(summary.getFileCount()), int(summary.getLength())
        status = "missing" if n_files == 0 else ("empty" if n_bytes == 0 else "ready")
        rows.append((source, path, status, n_files, n_bytes))
    return spark.createDataFrame(
        rows, "source string, path string, status string, n_files long, n_bytes long")
