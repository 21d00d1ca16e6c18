"""Data-quality checks as distributed passes over a source.

A source is checked in one grouped pass (every per-row check is a
conditional count per id, which also gives the duplicates) and, for the
samples, one top-5 window per check (each task keeps five candidates, so
no check ever gathers its offending rows in one place). Results are a
DataFrame with one row per check:

    source, check, severity, column, n_bad, sample array<string>, message

``n_bad`` is the number of offending rows (or columns, for the column
checks); a check with ``n_bad = 0`` passed. Samples hold the smallest
offending ids (row positions mean nothing in a distributed scan), or the
offending values for the transaction-type check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tally.functions.text import strip_ws
from tally.schema import (
    AMOUNT_MAX,
    AMOUNT_MIN,
    ROW_COUNT_MAX,
    ROW_COUNT_MIN,
    VALID_TRANSACTION_TYPES,
    SourceSpec,
)
from tally.sources.files import MALFORMED
from tally.sources.raw import parse_number, parse_timestamp

RESULT_SCHEMA = ("source string, check string, severity string, column string, "
                 "n_bad long, sample array<string>, message string")
ERROR, WARNING, INFO = "error", "warning", "info"
SAMPLE_SIZE = 5
MISSING_TYPE = "nan"  # a missing type is reported under this text


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RESULT_SCHEMA)


# --------------------------------------------------------------------------
# column checks (schema only: no data is read)
# --------------------------------------------------------------------------

def check_columns(spark: SparkSession, columns: list[str], spec: SourceSpec) -> tuple[DataFrame, bool]:
    """Required columns present (error, stops the profile) and extra columns (warning)."""
    have = set(columns) - {MALFORMED}
    missing = sorted(set(spec.required) - have)
    extra = sorted(have - set(spec.required))
    rows = [(spec.name, "required_columns", ERROR, ",".join(missing) or None, len(missing), [],
             f"header lacks {', '.join(missing)}" if missing else "header has every column that is needed")]
    if not missing:
        rows.append((spec.name, "extra_columns", WARNING, ",".join(extra) or None, len(extra), [],
                     f"columns not used: {', '.join(extra)}" if extra else "header has no other column"))
    return _rows(spark, rows), not missing


# --------------------------------------------------------------------------
# row checks
# --------------------------------------------------------------------------

def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def normalised_type(spec: SourceSpec) -> Column:
    return F.coalesce(F.lower(strip_ws(_col(spec.type_column))), F.lit(MISSING_TYPE))


def _parsed(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The source plus its parsed date, amount and normalised type, computed
    once per row (every check below reads these columns)."""
    return df.select("*",
                     parse_timestamp(_col(spec.date_column)).alias("_d"),
                     parse_number(_col(spec.amount_column)).alias("_a"),
                     normalised_type(spec).alias("_t"))


def _predicates(spec: SourceSpec, as_of: Column) -> list[tuple[str, str, str | None, Column, str]]:
    """(check, severity, column, bad-row predicate, message template) over ``_parsed``."""
    d, a, t = F.col("_d"), F.col("_a"), F.col("_t")
    out = []
    for c in spec.non_nullable:
        out.append(("nulls", ERROR, c, _col(c).isNull(), f"{c}: %d empty cell(s)"))
    out += [
        ("unparseable_dates", ERROR, spec.date_column, d.isNull(), f"{spec.date_column}: %d cell(s) hold no date"),
        ("future_dates", WARNING, spec.date_column, d > as_of, f"{spec.date_column}: %d date(s) lie ahead"),
        ("non_numeric_amounts", ERROR, spec.amount_column, a.isNull(),
         f"{spec.amount_column}: %d cell(s) hold no finite number"),
        ("amount_out_of_bounds", WARNING, spec.amount_column,
         (a < F.lit(AMOUNT_MIN)) | (a > F.lit(AMOUNT_MAX)),
         f"{spec.amount_column}: %d value(s) below {AMOUNT_MIN:.2f} or above {AMOUNT_MAX:.2f}"),
        ("zero_amounts", WARNING, spec.amount_column, a == F.lit(0.0), f"{spec.amount_column}: %d zero value(s)"),
        ("invalid_transaction_types", ERROR, spec.type_column,
         ~t.isin(list(VALID_TRANSACTION_TYPES)),
         f"{spec.type_column}: %d row(s) neither " + " nor ".join(VALID_TRANSACTION_TYPES)),
    ]
    return out


def _with_malformed(preds: list, df: DataFrame) -> list:
    """A reader that marks malformed rows adds a check of them."""
    if MALFORMED not in df.columns:
        return preds
    return [*preds, ("malformed_rows", ERROR, None, _col(MALFORMED), "%d row(s) have more fields than the header")]


def _entries(preds: list, row_max: int) -> list[Column]:
    """One struct per check over the columns ``_rows`` and ``_c<i>``."""
    n = F.col("_rows")

    def entry(check: str, severity: str, column: str | None, bad: Column, message: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"),
                        F.lit(column).cast("string").alias("column"), bad.cast("long").alias("n_bad"),
                        message.alias("message"))
    rows = F.format_string("%d row(s) read", n)
    out = [entry("rows_read", INFO, None, n, rows),
           entry("row_count_min", ERROR, None, (n < ROW_COUNT_MIN).cast("int"),
                 F.concat(rows, F.lit(f", at least {ROW_COUNT_MIN} needed"))),
           entry("row_count_max", WARNING, None, F.greatest(n - F.lit(row_max), F.lit(0)),
                 F.concat(rows, F.lit(f", up to {row_max} usual")))]
    return out + [entry(check, severity, column, F.col(f"_c{i}"), F.format_string(message, F.col(f"_c{i}")))
                  for i, (check, severity, column, _, message) in enumerate(preds)]


def _exploded(counts: DataFrame, entries: list[Column], source: str) -> DataFrame:
    out = counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return out.select(F.lit(source).alias("source"), "check", "severity", "column", "n_bad",
                      F.lit(None).cast("array<string>").alias("sample"), "message")


def _now(as_of: Column | None) -> Column:
    return as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")


def row_checks(df: DataFrame, spec: SourceSpec, as_of: Column | None = None,
               row_max: int = ROW_COUNT_MAX) -> DataFrame:
    """All per-row checks and the row-count checks in one aggregation pass."""
    preds = _with_malformed(_predicates(spec, _now(as_of)), df)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(p).alias(f"_c{i}") for i, (_, _, _, p, _) in enumerate(preds)]
    return _exploded(_parsed(df, spec).agg(*aggs), _entries(preds, row_max), spec.name)


def _duplicates_entry(spec: SourceSpec) -> Column:
    n = F.col("_repeats")
    return F.struct(F.lit("duplicate_ids").alias("check"), F.lit(ERROR).alias("severity"),
                    F.lit(spec.id_column).alias("column"), n.cast("long").alias("n_bad"),
                    F.format_string(f"{spec.id_column}: %d repeat(s) of an earlier row's value", n).alias("message"))


def duplicate_ids(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Occurrences after the first of every id (missing ids count as equal).

    One grouped count: partial aggregation combines each hot id on the map
    side, so a single id holding a third of the rows costs no more than any
    other id.
    """
    g = df.groupBy(_col(spec.id_column).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    return _exploded(g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_repeats")),
                     [_duplicates_entry(spec)], spec.name)


def all_checks(df: DataFrame, spec: SourceSpec, as_of: Column | None = None,
               row_max: int = ROW_COUNT_MAX) -> DataFrame:
    """Row checks, row counts and duplicate ids from one scan of the source.

    One grouped pass by id counts rows and offenders of each id (hot ids
    combine on the map side), one aggregate adds them up.
    """
    preds = _with_malformed(_predicates(spec, _now(as_of)), df)
    names = [f"_c{i}" for i in range(len(preds))]
    per_id = _parsed(df, spec).groupBy(_col(spec.id_column).alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(p).alias(c) for c, (_, _, _, p, _) in zip(names, preds)])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = per_id.agg(total(F.col("_n")).alias("_rows"), *[total(F.col(c)).alias(c) for c in names],
                        total(F.col("_n") - 1).alias("_repeats"))
    return _exploded(counts, [*_entries(preds, row_max), _duplicates_entry(spec)], spec.name)


def samples(df: DataFrame, spec: SourceSpec, as_of: Column | None = None,
            size: int = SAMPLE_SIZE) -> DataFrame:
    """First offenders per check: ``(source, check, column, sample)``.

    Each row names the checks it fails; a window numbers the ids within each
    check and keeps ``size`` of them (every task prunes to that many before
    the shuffle). Duplicate ids give their smallest repeated ids (one grouped
    count), the type check its smallest distinct offending values. Lazy: no
    job runs here. Checks without offenders have no row.
    """
    ident = _col(spec.id_column).cast("string")
    preds = _with_malformed(_predicates(spec, _now(as_of)), df)
    failed = F.filter(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                 F.coalesce(p, F.lit(False)).alias("bad"))
        for check, _, column, p, _ in preds if check != "invalid_transaction_types"]), lambda s: s["bad"])
    by_row = (_parsed(df, spec).select(ident.alias("v"), F.explode(failed).alias("f"))
              .filter(F.col("v").isNotNull()).select("f.check", "f.column", "v"))
    types = (_parsed(df, spec).filter(~F.col("_t").isin(list(VALID_TRANSACTION_TYPES))).select("_t").distinct()
             .select(F.lit("invalid_transaction_types").alias("check"), F.lit(spec.type_column).alias("column"),
                     F.col("_t").alias("v")))
    repeated = (df.groupBy(ident.alias("v")).agg(F.count(F.lit(1)).alias("_n"))
                .filter((F.col("_n") > 1) & F.col("v").isNotNull())
                .select(F.lit("duplicate_ids").alias("check"), F.lit(spec.id_column).alias("column"), "v"))
    first = Window.partitionBy("check", "column").orderBy("v")
    return (by_row.unionByName(types).unionByName(repeated)
            .withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= size)
            .groupBy("check", "column").agg(F.array_sort(F.collect_list("v")).alias("sample"))
            .select(F.lit(spec.name).alias("source"), "check", "column", "sample"))


def profile(spark: SparkSession, df: DataFrame, spec: SourceSpec, as_of: Column | None = None,
            row_max: int = ROW_COUNT_MAX, with_samples: bool = True) -> DataFrame:
    """Full profile of one source in the fixed order; stops after a failed
    column check (the remaining checks need those columns)."""
    cols, ok = check_columns(spark, df.columns, spec)
    if not ok:
        return cols
    checks = all_checks(df, spec, as_of, row_max)
    if with_samples:
        s = samples(df, spec, as_of).select(F.col("check").alias("_k"), F.col("column").alias("_of"),
                                            F.col("sample").alias("_s"))
        checks = (checks.join(s, (F.col("check") == F.col("_k")) & F.col("column").eqNullSafe(F.col("_of")), "left")
                  .withColumn("sample", F.when(F.col("n_bad") > 0, F.coalesce(F.col("_s"), F.array().cast("array<string>"))))
                  .drop("_s", "_k", "_of"))
    return cols.unionByName(checks.select(*cols.columns))


def unknown_source(spark: SparkSession, name: str) -> DataFrame:
    return _rows(spark, [(name, "known_source", ERROR, None, 1, [],
                          f"no source is called '{name}'; there are bank and card")])


def not_ready(spark: SparkSession, name: str, status: str, path: str) -> DataFrame:
    msg = f"nothing at {path}" if status == "missing" else f"no bytes at {path}"
    return _rows(spark, [(name, "file_ready", ERROR, None, 1, [], msg)])


# --------------------------------------------------------------------------
# report, gate, rejects, mart column tests
# --------------------------------------------------------------------------

def summarise(results: DataFrame) -> DataFrame:
    """Per source status, rows, error and warning counts, plus an ALL row.

    One aggregation with a roll-up gives both levels, so the checks behind
    ``results`` are computed once.
    """
    failed = F.col("n_bad") > 0
    g = (results.rollup("source")
         .agg(F.count(F.when(failed & (F.col("severity") == ERROR), F.lit(1))).cast("long").alias("errors"),
              F.count(F.when(failed & (F.col("severity") == WARNING), F.lit(1))).cast("long").alias("warnings"),
              F.coalesce(F.sum(F.when(F.col("check") == "rows_read", F.col("n_bad"))), F.lit(0))
              .cast("long").alias("rows"),
              F.grouping("source").alias("_total")))
    return g.select(F.when(F.col("_total") == 1, F.lit("ALL")).otherwise(F.col("source")).alias("source"),
                    (F.col("errors") == 0).alias("passed"), "rows", "errors", "warnings")


def load_gate(batch: DataFrame, source: str, by: str | None = None) -> DataFrame:
    """Gate applied before a load, on the standardised batch.

    Fails on: no rows, a missing date or amount (an amount that did not parse
    is missing), any repeated id (two missing ids are a repeat) or, where the
    reader marks them, any malformed row. One grouped pass by id yields all
    counts. With ``by``, one row per value of that column (for example a file).
    """
    marked = MALFORMED in batch.columns
    keys = [by] if by else []
    per_id = (batch.groupBy(*keys, "transaction_id")
              .agg(F.count(F.lit(1)).alias("_n"),
                   F.count_if(F.col("date").isNull()).alias("_nd"),
                   F.count_if(F.col("amount").isNull()).alias("_na"),
                   (F.count_if(F.col(MALFORMED)) if marked else F.max(F.lit(0))).alias("_nm")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    g = per_id.groupBy(*keys).agg(
        total("_n").alias("rows"), total("_nd").alias("null_dates"), total("_na").alias("null_amounts"),
        total(F.col("_n") - 1).alias("duplicate_ids"), total("_nm").alias("malformed_rows"))
    out = [*keys, F.lit(source).alias("source"), "rows", "null_dates", "null_amounts", "duplicate_ids"]
    if marked:
        out.append("malformed_rows")
    return g.select(*out, ((F.col("rows") > 0) & (F.col("null_dates") == 0) & (F.col("null_amounts") == 0)
                           & (F.col("duplicate_ids") == 0) & (F.col("malformed_rows") == 0)).alias("passed"))


def gate_reason(gate) -> str:
    """A failed gate's counts as text."""
    shown = ("rows", "null_dates", "null_amounts", "duplicate_ids", "malformed_rows")
    return " ".join(f"{k}={gate[k]}" for k in shown if k in gate)


def rejects(raw: DataFrame, source: str) -> DataFrame:
    """Rows that staging drops because id, date or amount is missing."""
    bad = F.col("transaction_id").isNull() | F.col("date").isNull() | F.col("amount").isNull()
    return raw.agg(F.lit(source).alias("source"),
                   F.count(F.lit(1)).cast("long").alias("rows"),
                   F.count(F.when(bad, F.lit(1))).cast("long").alias("rejected"))


def test_not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Column test: number of NULLs per column (0 passes)."""
    aggs = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) as (column, failures)").select(
        F.lit(model).alias("model"), F.lit("not_null").alias("test"), "column",
        F.col("failures").cast("long"), (F.col("failures") == 0).alias("passed"))


def test_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Column test: number of values that occur more than once (0 passes)."""
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique").alias("test"), F.lit(column).alias("column"),
        "failures", (F.col("failures") == 0).alias("passed"))


# --------------------------------------------------------------------------
# file-level entry points
# --------------------------------------------------------------------------

def validate_file(spark: SparkSession, path: str, source: str, as_of: Column | None = None,
                  row_max: int = ROW_COUNT_MAX, with_samples: bool = True) -> DataFrame:
    """Full validation of one export: dispatch by source name, readiness,
    then the profile. An unknown source or a missing/empty path is reported
    as an error row and stops there."""
    from tally.schema import SOURCES
    from tally.sources.files import file_readiness, read_csv_text

    spec = SOURCES.get(source)
    if spec is None:
        return unknown_source(spark, source)
    status = file_readiness(spark, {source: path}).first()["status"]
    if status != "ready":
        return not_ready(spark, source, status, path)
    return profile(spark, read_csv_text(spark, path), spec, as_of, row_max, with_samples)


def validation_report(spark: SparkSession, paths: dict[str, str], as_of: Column | None = None,
                      row_max: int = ROW_COUNT_MAX) -> tuple[DataFrame, DataFrame]:
    """Validate every export; returns (check rows, summary with an ALL row)."""
    parts = [validate_file(spark, p, s, as_of, row_max) for s, p in paths.items()]
    results = reduce(DataFrame.unionByName, parts)
    return results, summarise(results)
