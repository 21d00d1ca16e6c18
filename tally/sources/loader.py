"""Multi-source extract and load with a per-source gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tally.operators.quality import gate_reason, load_gate
from tally.schema import SOURCES, SourceSpec
from tally.session import scratch_path
from tally.sources.files import file_readiness, read_source, remove
from tally.sources.raw import RawStore, standardise

OUTCOME_SCHEMA = "source string, status string, rows_loaded long, reason string"


@dataclass(frozen=True)
class SourceFile:
    name: str          # 'bank' or 'card'
    path: str
    table: str = ""    # defaults to the spec's raw table


def load_batch(spark: SparkSession, store: RawStore, spec: SourceSpec, batch: DataFrame,
               table: str | None = None, full_refresh: bool = False) -> tuple[str, int, str | None]:
    """Gate and load one standardised batch; returns (status, rows, reason).

    The batch is written once to a scratch table, so the export is parsed once
    and a lost executor costs a re-read of a shared file; gate and load read
    the columns they need from it, and it is removed afterwards.
    """
    staged_path = scratch_path(spark, f"staged-{spec.name}")
    try:
        batch.write.parquet(staged_path)
        staged = spark.read.schema(batch.schema).parquet(staged_path)
        gate = load_gate(staged, spec.name).first()
        if not gate["passed"]:
            return "failed", 0, gate_reason(gate)
        res = store.load(staged, table or spec.raw_table, full_refresh, size=gate["rows"])
        return "loaded", res.rows_loaded, None
    finally:
        remove(spark, staged_path)


def load_source(spark: SparkSession, store: RawStore, spec: SourceSpec, path: str,
                table: str | None = None, full_refresh: bool = False, multi_line: bool = False,
                carry: dict[str, str] | None = None) -> tuple[str, int, str | None]:
    """Read, standardise, gate and load one source; returns (status, rows, reason)."""
    batch = standardise(read_source(spark, path, spec, multi_line, carry))
    return load_batch(spark, store, spec, batch, table, full_refresh)


def load_sources(spark: SparkSession, store: RawStore, files: list[SourceFile],
                 full_refresh: bool = False, carry: dict[str, dict[str, str]] | None = None
                 ) -> tuple[DataFrame, bool]:
    """Load every source that is present and passes its gate.

    A missing file, a failed gate or an error skips that source only. Returns
    the outcome table ``(source, status, rows_loaded, reason)`` and whether
    every source loaded (the reference's exit status). ``carry`` names file
    columns that a source stores besides the contract's, by source.
    """
    ready = {r["source"]: r["status"] for r in
             file_readiness(spark, {f.name: f.path for f in files}).collect()}
    rows = []
    for f in files:
        spec = SOURCES.get(f.name)
        if spec is None:
            rows.append((f.name, "failed", 0, f"unknown source '{f.name}'"))
            continue
        if ready.get(f.name) != "ready":
            rows.append((f.name, "missing", 0, f"source file {ready.get(f.name)}: {f.path}"))
            continue
        try:
            status, n, reason = load_source(spark, store, spec, f.path, f.table or None, full_refresh,
                                            carry=(carry or {}).get(f.name))
        except Exception as e:  # noqa: BLE001 - one source's failure must not stop the others
            status, n, reason = "error", 0, f"{type(e).__name__}: {e}"
        rows.append((f.name, status, n, reason))
    outcome = spark.createDataFrame(rows, OUTCOME_SCHEMA)
    return outcome, all(r[1] == "loaded" for r in rows)
