"""Incremental load as a bounded Structured Streaming job, gated file by file.

New CSV exports land in a folder; a file-source stream names the files it has
not seen (the checkpoint remembers them). A micro-batch's files are read once,
line by line, into a scratch table; there each file's header is found, and its
rows are parsed by it, standardised and gated on their own: files that pass are
loaded together through the stored-id anti-join, files that fail are recorded
in a quarantine table with their path and reason, and no good file waits for a
bad one. Files without any bytes never come through a stream, as Spark's file
sources drop them; they are listed beside it and noted in quarantine. Every
run first tries the quarantined files again, so a file that was empty or wrong
and is corrected in place is loaded then. The ``availableNow`` trigger processes
what is there and stops, so the job can be scheduled like a batch job and
resumes where it left off after a failure (the checkpoint lives in the shared
checkpoint folder).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.quality import gate_reason, load_gate
from tally.schema import SourceSpec
from tally.session import scratch_path
from tally.sources.files import csv_lines, file_headers, header_columns, map_to_common, parse_lines, plain_path, remove
from tally.sources.raw import RawStore, standardise
from tally.sources.snapshots import file_system

#: Files of one micro-batch; their names, headers and gates pass through the driver.
MAX_FILES = 200

QUARANTINE_SCHEMA = "file string, status string, reason string, at timestamp"
REJECTED, LOADED, GONE = "rejected", "loaded", "gone"
EMPTY = "the file is empty"


def _quarantine_path(store: RawStore, table: str) -> str:
    return store.path(f"{table}_quarantine")


def _note(spark: SparkSession, store: RawStore, table: str, rows: list[tuple[str, str, str | None]]) -> None:
    if rows:
        (spark.createDataFrame(rows, "file string, status string, reason string")
         .withColumn("at", F.current_timestamp()).coalesce(1)
         .write.mode("append").parquet(_quarantine_path(store, table)))


def quarantined(spark: SparkSession, store: RawStore, table: str) -> DataFrame:
    """Files whose last attempt failed: file, reason, at."""
    fs, path = file_system(spark, _quarantine_path(store, table))
    if not fs.exists(path):
        return spark.createDataFrame([], "file string, reason string, at timestamp")
    notes = spark.read.schema(QUARANTINE_SCHEMA).parquet(_quarantine_path(store, table))
    last = notes.groupBy("file").agg(F.max_by(F.struct("status", "reason", "at"), "at").alias("last"))
    return last.filter(F.col("last.status") == REJECTED).select("file", "last.reason", "last.at")


def empty_files(spark: SparkSession, landing: str) -> list[str]:
    """Files without bytes in the landing folder (or folders, where it is a pattern), by a listing alone."""
    fs, pattern = file_system(spark, landing)
    found = []
    for place in fs.globStatus(pattern) or []:
        inside = fs.listStatus(place.getPath()) if place.isDirectory() else [place]
        for status in inside:
            if not status.getLen() and not status.isDirectory() and status.getPath().getName()[0] not in "._":
                found.append(status.getPath().toString())
    return sorted(found)


def _header_problem(head: str, spec: SourceSpec) -> str | None:
    columns = header_columns(head)
    missing = sorted(set(spec.column_map) - set(columns))
    if missing:
        return f"header lacks {missing}"
    return "header repeats a column" if len(set(columns)) < len(columns) else None


def load_files(spark: SparkSession, store: RawStore, spec: SourceSpec, files: list[str], table: str) -> list[dict]:
    """Gate each file (plain paths, a micro-batch's at most) on its own and load those that pass; one outcome per file."""
    outcomes: dict[str, dict] = {}

    def end(file: str, status: str, rows: int = 0, reason: str | None = None) -> None:
        outcomes[file] = {"file": file, "status": status, "rows_loaded": rows, "reason": reason}

    readable = []
    for f in sorted(files):
        fs, path = file_system(spark, f)
        if not fs.exists(path):
            end(f, GONE, reason="the file is gone")
        elif not fs.getFileStatus(path).getLen():
            end(f, REJECTED, reason=EMPTY)
        else:
            readable.append(f)
    if readable:
        staged = [scratch_path(spark, f"stream-{what}-{spec.name}") for what in ("lines", "rows")]
        try:
            _load_readable(spark, store, spec, readable, table, staged, end)
        finally:
            for path in staged:
                remove(spark, path)
    return [outcomes[f] for f in sorted(outcomes)]


def _load_readable(spark, store, spec, files, table, staged, end) -> None:
    # Each file is read once, here: a lost executor costs a re-read of the staged lines.
    read = csv_lines(spark, files)
    read.write.parquet(staged[0])
    lines = spark.read.schema(read.schema).parquet(staged[0])
    heads = file_headers(lines)
    names = {r["_file"]: (plain_path(spark, r["_file"]), r["head"]) for r in heads.collect()}
    for f in set(files) - {name for name, _ in names.values()}:
        end(f, REJECTED, reason=EMPTY)  # blank lines only
    headers = set()
    for f, head in names.values():
        problem = _header_problem(head, spec)
        if problem:
            end(f, REJECTED, reason=problem)
        else:
            headers.add(head)
    if not headers:
        return
    batch = standardise(map_to_common(parse_lines(lines, heads, sorted(headers)), spec, {"_file": "_file"}))
    batch.write.parquet(staged[1])
    rows = spark.read.schema(batch.schema).parquet(staged[1])
    gates = {r["_file"]: r for r in load_gate(rows, spec.name, by="_file").collect()}
    good = []
    for uri, (f, head) in names.items():
        if head in headers:
            gate = gates.get(uri)
            if gate is not None and gate["passed"]:
                good.append(uri)
            else:
                end(f, REJECTED, reason=gate_reason(gate) if gate is not None else "rows=0")
    if not good:
        return
    # An id in several files of one batch is loaded from the first of them by name.
    passed = rows.filter(F.col("_file").isin(good))
    first = passed.groupBy("transaction_id").agg(F.min("_file").alias("_first"))
    new = passed.join(first, passed["transaction_id"].eqNullSafe(first["transaction_id"])
                      & (passed["_file"] == first["_first"]), "left_semi")
    n = store.load(new, table, size=sum(gates[uri]["rows"] for uri in good)).rows_loaded
    for uri in sorted(good):
        end(names[uri][0], LOADED, n)
        n = 0  # the rows of a batch are counted once


def stream_load(spark: SparkSession, store: RawStore, spec: SourceSpec, landing: str,
                checkpoint: str, table: str | None = None, max_files_per_trigger: int = MAX_FILES) -> list[dict]:
    """Load every not-yet-seen export in ``landing``, and quarantined files that now pass.

    Returns one outcome per file tried. A micro-batch is committed when its
    files are loaded or noted in quarantine; loading one again adds nothing.
    """
    table = table or spec.raw_table
    outcomes: list[dict] = []

    def attempt(files: list[str]) -> None:
        done = load_files(spark, store, spec, files, table)
        _note(spark, store, table, [(o["file"], o["status"], o["reason"]) for o in done])
        outcomes.extend(done)

    # Quarantined files in pages by name: a page at a time is in the driver.
    last = ""
    while True:
        page = quarantined(spark, store, table).filter(F.col("file") > last).orderBy("file").limit(max_files_per_trigger)
        page = [r["file"] for r in page.select("file").collect()]
        if not page:
            break
        attempt(page)
        last = page[-1]

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        attempt([plain_path(spark, r["file"]) for r in batch_df.select("file").distinct().collect()])

    # The stream only names new files; binary files' content is never read unless it is selected.
    stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select(F.col("_metadata.file_path").alias("file")))
    query = (stream.writeStream.foreachBatch(handle)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()

    # Only those not tried above: the others' last attempt is in quarantine.
    tried = {o["file"] for o in outcomes}
    empty = [f for f in empty_files(spark, landing) if f not in tried]
    for k in range(0, len(empty), max_files_per_trigger):
        attempt(empty[k:k + max_files_per_trigger])
    return outcomes
