"""Standardisation and the raw tables: full and incremental loads."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.text import strip_ws
from tally.schema import COMMON_COLUMNS, RAW_SCHEMA
from tally.session import note_table
from tally.sources.blooms import block_count, bloom_filter, possible, united
from tally.sources.snapshots import Versions, file_system

# Accepted date layouts besides ISO (which a plain cast already parses).
DATE_FORMATS = ("MM/dd/yyyy", "yyyy/MM/dd", "dd-MMM-yyyy")

# Least buckets of a new raw table: a large first load gets a multiple of them,
# so that a bucket is a task's work (``spread``); a table then keeps its number.
BUCKETS = 16
#: Rows that a task of a load writes, at most on average. A task's work does not
#: grow with the load: larger loads have more tasks, and more files of a month.
TASK_ROWS = 1_000_000
#: Stored and new rows of a bucket that one task still compares.
BUCKET_ROWS = 4 * TASK_ROWS


def parse_timestamp(col: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Coercing date parse: ISO by cast, then each declared format; NULL if none fits."""
    text = col.cast("string")
    parsed = [text.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(*parsed)


def parse_number(col: Column) -> Column:
    """Coercing number parse: text that is no finite number ('1,200.00', 'n/a',
    'NaN', 'Infinity') becomes NULL."""
    return finite(col.try_cast("double"))


def finite(number: Column) -> Column:
    """NULL instead of NaN and the infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def standardise(df: DataFrame) -> DataFrame:
    """Type a mapped export to the raw contract.

    Dates and amounts are parsed with try-semantics, so a bad cell is NULL
    (the load gate then rejects the source) instead of failing the job.
    Text is stripped of surrounding whitespace of any kind, descriptions are
    upper-cased, types and source lower-cased. Missing text stays NULL.
    """
    extra = [c for c in df.columns if c not in COMMON_COLUMNS]
    types = {f.name: f.dataType for f in df.schema.fields}
    # Typed inputs (a parquet export, say) are cast directly; text is parsed.
    if isinstance(types["date"], (T.DateType, T.TimestampType, T.TimestampNTZType)):
        date = F.col("date").cast("timestamp_ntz")
    else:
        date = parse_timestamp(F.col("date"))
    if isinstance(types["amount"], T.NumericType):
        amount = finite(F.col("amount").cast("double"))
    else:
        amount = parse_number(F.col("amount"))
    return df.select(
        strip_ws(F.col("transaction_id").cast("string")).alias("transaction_id"),
        date.alias("date"),
        F.upper(strip_ws(F.col("description"))).alias("description"),
        amount.alias("amount"),
        F.lower(strip_ws(F.col("transaction_type"))).alias("transaction_type"),
        F.lower(strip_ws(F.col("source"))).alias("source"),
        *extra,
    )


def to_raw_contract(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """The raw columns, typed; a carried column that the batch lacks is NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have or f.name in COMMON_COLUMNS else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass
class LoadResult:
    table: str
    rows_loaded: int


#: Ids that a load looks up one by one in their buckets; more go through the join.
FEW_IDS = 500
#: The period of rows without a date. It sorts behind all periods, so that no start date drops it.
NO_MONTH = "none"
#: Partitions of a raw table: by month, or by year where loads bring a long history in small files.
PERIODS = {"month": "yyyy-MM", "year": "yyyy"}


def month_of(date: Column, period: str = "month") -> Column:
    """The partition of a row: its month or year."""
    return F.coalesce(F.date_format(date, PERIODS[period]), F.lit(NO_MONTH))


def unseen(batch: DataFrame, stored: DataFrame, null_stored: bool) -> DataFrame:
    """The batch's rows whose id is not among the stored rows' ids.

    A missing id counts as an id of its own: it is new only while no row
    without an id is stored (``null_stored``).
    """
    stored = stored.select(F.col("transaction_id").alias("_stored")).filter(F.col("_stored").isNotNull())
    asked = batch.filter(F.col("transaction_id").isNotNull()) if null_stored else batch
    # A missing id equals nothing, so the anti-join keeps its rows; the batch is read once.
    return asked.join(stored, F.col("transaction_id") == F.col("_stored"), "left_anti")


def spread(rows: int, buckets: int) -> int:
    """Tasks for so many rows: a multiple of the buckets, so that a task's rows are of one bucket."""
    return buckets * max(1, -(-rows // (buckets * TASK_ROWS)))


def _nulls(loads: list[dict]) -> bool:
    return any(load["without_id"] for load in loads)


class RawStore:
    """Raw tables stored as parquet under one shared root, in versions.

    Every load writes a folder of its own, partitioned by month and bucketed by
    id, and a new version of the table then names it beside the folders of the
    version before (``snapshots.Versions``). A full refresh's version names its
    own folder alone. So a load that is killed, or one that is still
    writing, is never seen, readers keep the version that they began with, and
    two loads at once cannot both follow the same version: the second one
    looks again at what the first one added and leaves out the ids it has.

    Months let a start date skip files (``read(since=...)``). Buckets keep each
    id's rows in a known place: a load shuffles its own batch to the buckets
    and reads the stored ids where they lie. Rows are ordered by date within a
    file. ``carry`` names further text columns of a table that are stored
    besides the contract's (by table).

    With ``bloom_ids``, the number of ids that a table is planned for, every
    load also writes a Bloom filter of its ids (``blooms``), and a batch meets
    these first: a batch of new ids reads no stored id at all, a few ids that
    may be stored are looked up in their own buckets, and more of them send the
    load the plain way. That pays where batches bring new ids to a large table,
    and costs where they repeat what is stored; the default is without. A
    table keeps to the layout (buckets, filters, ``period``) that its first load
    or full refresh chose.
    """

    def __init__(self, spark: SparkSession, root: str, carry: dict[str, tuple[str, ...]] | None = None,
                 buckets: int = BUCKETS, bloom_ids: int | None = None, period: str = "month"):
        self.spark = spark
        self.root = root
        self.carry = carry or {}
        self.buckets = buckets
        self.bloom_ids = bloom_ids
        self.period = period
        self._added: set[tuple[str, str]] = set()

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def schema(self, table: str) -> T.StructType:
        extra = [T.StructField(c, T.StringType()) for c in self.carry.get(table, ())]
        return T.StructType([*RAW_SCHEMA.fields, *extra])

    def versions(self, table: str) -> Versions:
        return Versions(self.spark, self.path(table))

    def exists(self, table: str) -> bool:
        return self.versions(table).latest()[1] is not None

    def _table(self, table: str, manifest: dict) -> str:
        """The session's name of a stored table, with the folders of a version among its partitions."""
        schema = self.schema(table)
        key = f"{self.path(table)}|{manifest['buckets']}|{schema.simpleString()}"
        name = f"tally_raw_{hashlib.md5(key.encode()).hexdigest()[:16]}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `_load` string, `_month` string) USING parquet "
                       f"PARTITIONED BY (`_load`, `_month`) CLUSTERED BY (transaction_id) SORTED BY (date) "
                       f"INTO {manifest['buckets']} BUCKETS LOCATION '{_quoted(self.path(table))}'")
        note_table(self.spark, name, self.root)
        new = [(load["id"], m) for load in manifest["loads"] if (name, load["id"]) not in self._added
               for m in load["months"]]
        for k in range(0, len(new), 500):
            parts = " ".join(f"PARTITION (`_load`='{i}', `_month`='{m}')" for i, m in new[k:k + 500])
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        self._added |= {(name, load["id"]) for load in manifest["loads"]}
        return name

    def _rows(self, table: str, manifest: dict, loads: list[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its loads, with their month."""
        ids = [load["id"] for load in manifest["loads"] if loads is None or load["id"] in loads]
        return self.spark.table(self._table(table, manifest)).filter(F.col("_load").isin(ids)).drop("_load")

    def read(self, table: str, version: int | None = None, since: str | None = None) -> DataFrame:
        """A version of a table (default: the newest). ``since`` (a date, 'yyyy-MM-dd')
        leaves out the files of earlier months (or years), and nothing else: rows of
        its own month and rows without a date are returned."""
        versions = self.versions(table)
        manifest = versions.read(version) if version else versions.latest()[1]
        if manifest is None:
            return self.spark.createDataFrame([], self.schema(table))
        rows = self._rows(table, manifest)
        if since is not None:
            rows = rows.filter(F.col("_month") >= since[:len(PERIODS[manifest["period"]])])
        return rows.drop("_month")

    def _bloom_path(self, table: str, load: str) -> str:
        return os.path.join(self.path(table), "_blooms", load)

    def _write(self, rows: DataFrame, table: str, layout: dict, size: int) -> dict:
        """Write a load's folder and count its rows as they are written. ``size``, about
        the number of rows, says by how many tasks; each has rows of one bucket."""
        load = uuid.uuid4().hex
        written = Observation(f"load_{load}")
        name, buckets = f"tally_load_{load}", layout["buckets"]
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("transaction_id").isNull()).alias("without_id")]
        (rows.withColumn("_month", month_of(F.col("date"), layout["period"])).repartition(spread(size, buckets), "transaction_id")
         .observe(written, *counts).write.format("parquet").partitionBy("_month")
         .bucketBy(buckets, "transaction_id").sortBy("date")
         .option("path", os.path.join(self.path(table), f"_load={load}")).saveAsTable(name))
        months = [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        if layout["blocks"]:
            bloom_filter(self.spark.table(name), "transaction_id", layout["blocks"]).write.parquet(self._bloom_path(table, load))
        self.spark.sql(f"DROP TABLE {name}")  # the name alone; the folder stays
        return {"id": load, "rows": int(written.get["rows"]), "without_id": int(written.get["without_id"]),
                "months": sorted(months)}

    def _discard(self, table: str, load: dict) -> None:
        for folder in (os.path.join(self.path(table), f"_load={load['id']}"), self._bloom_path(table, load["id"])):
            fs, path = file_system(self.spark, folder)
            fs.delete(path, True)

    def _candidates(self, batch: DataFrame, table: str, manifest: dict) -> list[str] | None:
        """The batch's ids that may be stored, by the Bloom filters; None if they are more than ``FEW_IDS``."""
        paths = [self._bloom_path(table, load["id"]) for load in manifest["loads"] if load["rows"]]
        if not paths:
            return []
        stored = united(self.spark.read.schema("block long, bits binary").parquet(*paths))
        ids = possible(batch, "transaction_id", stored, manifest["blocks"]).limit(FEW_IDS + 1).collect()
        return [r[0] for r in ids] if len(ids) <= FEW_IDS else None

    def new_rows(self, batch: DataFrame, table: str, version: int | None = None, size: int = 0) -> DataFrame:
        """The batch's rows whose id a version does not store. The stored side is
        read bucket by bucket and is not shuffled, unless its buckets with a batch of
        ``size`` rows are too large for a task; which side is broadcast, if any, is
        left to the planner, by bytes."""
        versions = self.versions(table)
        manifest = versions.read(version) if version else versions.latest()[1]
        if manifest is None:
            return batch
        null_stored = _nulls(manifest["loads"])
        few = self._candidates(batch, table, manifest) if manifest["blocks"] else None
        if few is None:
            return self._unseen(batch, self._rows(table, manifest), null_stored, manifest,
                                sum(load["rows"] for load in manifest["loads"]), size)
        if not few:
            return batch.filter(F.col("transaction_id").isNotNull()) if null_stored else batch
        # These ids alone are looked up, in the buckets that they belong to.
        return unseen(batch, self._rows(table, manifest).filter(F.col("transaction_id").isin(few)), null_stored)

    def _unseen(self, batch: DataFrame, stored: DataFrame, null_stored: bool, layout: dict,
                stored_size: int, size: int) -> DataFrame:
        """``unseen`` along the buckets, or, where these have become too large, with ids dealt to more tasks."""
        if stored_size + size > layout["buckets"] * BUCKET_ROWS:
            tasks = spread(max(stored_size, size), layout["buckets"])
            batch = batch.repartition(tasks, "transaction_id")
            stored = stored.select("transaction_id").repartition(tasks, "transaction_id")
        return unseen(batch, stored, null_stored)

    def load(self, batch: DataFrame, table: str, full_refresh: bool = False,
             before_commit: Callable[[], object] | None = None, size: int | None = None) -> LoadResult:
        """Insert rows whose id is not stored yet; never update stored rows.

        ``full_refresh`` replaces the table with the batch. Loading the same
        batch again adds nothing, rows without an id included, also while
        another load of the same ids is running. ``before_commit`` is called
        when the rows are written and their version is not. ``size`` is about the
        number of the batch's rows; without it they are counted first.
        """
        if size is None:
            size = batch.count()
        batch = to_raw_contract(batch, self.schema(table))
        versions = self.versions(table)
        while True:
            number, base = versions.latest()
            if full_refresh or base is None:
                layout = {"buckets": spread(size, self.buckets), "blocks": block_count(self.bloom_ids) if self.bloom_ids else 0,
                          "period": self.period}
                mine, kept = self._write(batch, table, layout, size), []
            else:
                layout, kept = {k: base[k] for k in ("buckets", "blocks", "period")}, base["loads"]
                mine = self._write(self.new_rows(batch, table, number, size), table, layout, size)
            while True:
                if not mine["rows"] and base is not None and not full_refresh:
                    self._discard(table, mine)
                    return LoadResult(table, 0)
                if before_commit is not None:
                    before_commit, call = None, before_commit
                    call()
                if versions.commit(number + 1, {**layout, "loads": [*kept, mine]}):
                    return LoadResult(table, mine["rows"])
                # Another load came first.
                number, newer = versions.latest()
                if full_refresh:
                    continue
                before = {load["id"] for load in kept}
                added = [load for load in newer["loads"] if load["id"] not in before]
                if any(newer[k] != layout[k] for k in layout) or len(added) + len(before) != len(newer["loads"]):
                    self._discard(table, mine)  # the table was replaced: begin anew
                    break
                base, kept = newer, newer["loads"]
                own = self._rows(table, {**layout, "loads": [mine]}).drop("_month")
                fresh = self._unseen(own, self._rows(table, newer, [load["id"] for load in added]), _nulls(added),
                                     layout, sum(load["rows"] for load in added), mine["rows"])
                left = fresh.count()
                if left < mine["rows"]:
                    mine, old = self._write(fresh, table, layout, left), mine
                    self._discard(table, old)

    def vacuum(self, table: str, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions, and the folders that only
        they name; their readers must be done. Folders of running loads stay."""
        versions = self.versions(table)
        numbers = versions.numbers()
        kept = {load["id"] for n in numbers[-keep:] for load in versions.read(n)["loads"]}
        for n in numbers[:-keep]:
            manifest = versions.read(n)
            versions.remove(n)
            for load in manifest["loads"]:
                if load["id"] not in kept:
                    self._discard(table, load)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
