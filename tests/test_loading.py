"""Files as exports hold them, loads that repeat, streams with bad files."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tally.operators import quality
from tally.schema import BANK, CARD
from tally.sources.files import read_csv_text, read_source
from tally.sources.loader import SourceFile, load_sources
from tally.sources.raw import RawStore, standardise
from tally.sources.snapshots import SnapshotStore
from tally.streaming.incremental import quarantined, stream_load

HEADER = "transaction_id,date,description,amount,transaction_type\n"


def test_quotes_commas_and_backslashes(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text(HEADER + '1,2024-01-01,"JOE ""THE"" DINER, NYC",-5.00,debit\n2,2024-01-02,"ACME \\",-6.00,debit\n'
                 '3,2024-01-03,C:\\dir\\,-7.00,debit\n')
    rows = {r["transaction_id"]: r for r in read_source(spark, str(p), BANK).collect()}
    assert rows["1"]["description"] == 'JOE "THE" DINER, NYC' and rows["1"]["amount"] == "-5.00"
    assert rows["2"]["description"] == "ACME \\" and rows["2"]["transaction_type"] == "debit"
    assert rows["3"]["description"] == "C:\\dir\\" and not any(r["_malformed"] for r in rows.values())


def test_line_breaks_in_cells_are_an_option(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text(HEADER + '1,2024-01-01,"TWO\nLINES",-5.00,debit\n')
    assert [r["description"] for r in read_source(spark, str(p), BANK, multi_line=True).collect()] == ["TWO\nLINES"]


def test_rows_with_too_many_fields_are_reported_and_stop_a_load(spark, tmp_path, scratch):
    p = tmp_path / "wide.csv"
    p.write_text(HEADER + "1,2024-01-01,A, B,-5.00,debit\n2,2024-01-02,SHORT,-6.00\n3,2024-01-03,\"A, B\",-7.00,debit\n")
    assert [r["_malformed"] for r in read_csv_text(spark, str(p)).orderBy("transaction_id").collect()] == [True, False, False]
    checks = {r["check"]: r for r in quality.validate_file(spark, str(p), "bank").collect()}
    assert checks["malformed_rows"]["n_bad"] == 1 and checks["malformed_rows"]["sample"] == ["1"]
    out, ok = load_sources(spark, RawStore(spark, scratch("raw")), [SourceFile("bank", str(p))])
    assert not ok and "malformed_rows=1" in out.first()["reason"]


SWAPPED = "transaction_id,date,amount,description,transaction_type,more\n"


def test_folder_with_differing_headers_is_read_by_name(spark, tmp_path, scratch):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + '1,2024-01-01,"KROGER, ""X""",-5.00,debit\n\n4,2024-01-01,SHORT,-1\n')
    (folder / "b.csv").write_text(SWAPPED + "2,2024-01-02,-6.00,SHELL,debit,x\n3,2024-01-02,-7.00,A,B,debit,x\n")
    (folder / "c.csv").write_text("transaction_type,transaction_id,date,description\ndebit,5,2024-01-03,NO AMOUNT\n")
    rows = {r["transaction_id"]: r for r in read_csv_text(spark, str(folder)).collect()}
    assert rows["1"]["description"] == 'KROGER, "X"' and rows["1"]["amount"] == "-5.00" and rows["1"]["more"] is None
    assert rows["2"]["description"] == "SHELL" and rows["2"]["amount"] == "-6.00" and rows["2"]["more"] == "x"
    assert rows["4"]["amount"] == "-1" and rows["4"]["transaction_type"] is None
    assert rows["5"]["amount"] is None and rows["5"]["transaction_type"] == "debit"
    assert {k for k, r in rows.items() if r["_malformed"]} == {"3"}
    (folder / "b.csv").write_text(SWAPPED + "2,2024-01-02,-6.00,SHELL,debit,x\n")
    (folder / "a.csv").write_text(HEADER + "1,2024-01-01,KROGER,-5.00,debit\n")
    (folder / "c.csv").unlink()
    store = RawStore(spark, scratch("raw"))
    out, ok = load_sources(spark, store, [SourceFile("bank", str(folder))])
    assert ok and out.first()["rows_loaded"] == 2
    got = {r["transaction_id"]: (r["description"], r["amount"]) for r in store.read(BANK.raw_table).collect()}
    assert got == {"1": ("KROGER", -5.0), "2": ("SHELL", -6.0)}


def test_one_header_saves_the_look_and_is_enforced(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "1,2024-01-01,KROGER,-5.00,debit\n")
    (folder / "b.csv").write_text(SWAPPED + "2,2024-01-02,-6.00,SHELL,debit,x\n")
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, str(folder), one_header=True).collect()
    (folder / "b.csv").write_text(HEADER + "2,2024-01-02,SHELL,-6.00,debit\n")
    assert read_csv_text(spark, str(folder), one_header=True).count() == 2


def test_numbers_that_are_not_finite_are_no_numbers(spark):
    df = spark.createDataFrame([(str(k), "2024-01-01", "A", a, "debit") for k, a in
                                enumerate(["NaN ", "Infinity", "-inf", "1e300", "5"])],
                               ",".join(f"{c} string" for c in BANK.required))
    checks = {r["check"]: r["n_bad"] for r in quality.row_checks(df, BANK).collect()}
    assert checks["non_numeric_amounts"] == 3


def test_missing_id_is_stored_once(spark, scratch):
    store = RawStore(spark, scratch("raw"))
    batch = raw_frame(spark, [("a", "2024-01-01", "X", -1.0, "debit"), (None, "2024-01-01", "Y", -2.0, "debit")], "bank")
    assert [store.load(batch, "t").rows_loaded for _ in range(3)] == [2, 0, 0]
    assert store.read("t").count() == 2
    later = raw_frame(spark, [(None, "2024-01-05", "Z", -3.0, "debit"), ("b", "2024-01-05", "Z", -3.0, "debit")], "bank")
    assert store.load(later, "t").rows_loaded == 1


def test_stored_ids_are_not_shuffled(spark, scratch):
    root = scratch("raw")
    store = RawStore(spark, root, buckets=4)
    store.load(raw_frame(spark, [(f"i{k}", "2024-01-01", "X", -1.0, "debit") for k in range(500)], "bank"), "t")
    again = RawStore(spark, root)  # another store over the folder keeps its buckets
    batch = raw_frame(spark, [(f"i{k}", "2024-01-01", "X", -1.0, "debit") for k in range(400, 600)], "bank")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = again.new_rows(batch, "t")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        assert "SelectedBucketsCount: 4 out of 4" in plan
        assert len(re.findall(r"- Exchange \(\d+\)", plan)) == 1  # the batch's
        assert df.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert again.load(batch, "t").rows_loaded == 100 and again.read("t").count() == 600


def test_provider_category_from_file_to_mart(spark, sample_paths, scratch):
    from tally.plans.job import run
    found = {}
    for carry in (False, True):
        marts_root = scratch("marts")
        run(spark, sample_paths["bank"], sample_paths["card"], scratch("raw"), marts_root, "2024-01-01",
            carry_provider_category=carry)
        spend = SnapshotStore(spark, marts_root).read("mart_monthly_spend").collect()
        found[carry] = {r["category"]: r["total_spend"] for r in spend if r["source"] == "card"}
        summary = SnapshotStore(spark, marts_root).read("validation_summary").count()
        assert summary == 3
    assert found[True]["Home Improvement"] == 113.76 and "Home Improvement" not in found[False]


def outcome(done):
    return {o["file"].rsplit("/", 1)[1]: o["status"] for o in done}


def test_stream_reads_each_file_by_its_own_header(spark, tmp_path, scratch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.csv").write_text(HEADER + "1,2024-01-01,walmart,-5.00,debit\n")
    (tmp_path / "in" / "c.csv").write_text("transaction_type,amount,description,date,transaction_id,more\n"
                                          "debit,-6.00,shell,2024-01-02,2,x\n")
    store = RawStore(spark, scratch("raw"))
    stream_load(spark, store, BANK, str(tmp_path / "in"), scratch("ckpt"))
    got = {r["transaction_id"]: (r["description"], r["transaction_type"], r["amount"]) for r in store.read(BANK.raw_table).collect()}
    assert got == {"1": ("WALMART", "debit", -5.0), "2": ("SHELL", "debit", -6.0)}


def test_bad_file_among_good_ones_is_kept_and_retried(spark, tmp_path, scratch):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text(HEADER + "1,2024-01-01,A,-5.00,debit\n")
    (folder / "bad.csv").write_text(HEADER + "2,2024-01-02,B,n/a,debit\n3,2024-01-02,C,-1,debit\n")
    (folder / "odd.csv").write_text("id,when\n9,2024-01-01\n")
    store, ckpt = RawStore(spark, scratch("raw")), scratch("ckpt")
    done = stream_load(spark, store, BANK, str(folder), ckpt)
    assert outcome(done) == {"good.csv": "loaded", "bad.csv": "rejected", "odd.csv": "rejected"}
    assert store.read(BANK.raw_table).count() == 1
    noted = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in quarantined(spark, store, BANK.raw_table).collect()}
    assert "null_amounts=1" in noted["bad.csv"] and "transaction_id" in noted["odd.csv"]
    (folder / "bad.csv").write_text(HEADER + "2,2024-01-02,B,-2.00,debit\n3,2024-01-02,C,-1,debit\n")
    done = stream_load(spark, store, BANK, str(folder), ckpt)
    assert outcome(done) == {"bad.csv": "loaded", "odd.csv": "rejected"}
    assert store.read(BANK.raw_table).count() == 3
    assert [r["file"].rsplit("/", 1)[1] for r in quarantined(spark, store, BANK.raw_table).collect()] == ["odd.csv"]


def test_empty_file_is_noted_and_loaded_when_filled(spark, tmp_path, scratch):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a b.csv").write_text("")
    (folder / "blank.csv").write_text("\n  \n\n")
    (folder / "head.csv").write_text(HEADER)
    (folder / "good.csv").write_text(HEADER + "1,2024-01-01,A,-5.00,debit\n")
    (folder / "_SUCCESS").write_text("")
    store, ckpt = RawStore(spark, scratch("raw")), scratch("ckpt")
    done = stream_load(spark, store, BANK, str(folder), ckpt)
    assert outcome(done) == {"a b.csv": "rejected", "blank.csv": "rejected", "head.csv": "rejected", "good.csv": "loaded"}
    noted = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in quarantined(spark, store, BANK.raw_table).collect()}
    assert noted["a b.csv"] == noted["blank.csv"] == "the file is empty" and "rows=0" in noted["head.csv"]
    # Still empty: tried and noted again, once. One file goes away.
    (folder / "head.csv").unlink()
    done = stream_load(spark, store, BANK, str(folder), ckpt)
    assert outcome(done) == {"a b.csv": "rejected", "blank.csv": "rejected", "head.csv": "gone"} and len(done) == 3
    (folder / "a b.csv").write_text(HEADER + "2,2024-01-02,B,-6.00,debit\n")
    (folder / "late.csv").write_text("")
    done = stream_load(spark, store, BANK, str(folder) + "/*", ckpt, max_files_per_trigger=1)
    assert outcome(done) == {"a b.csv": "loaded", "blank.csv": "rejected", "late.csv": "rejected"}
    assert sorted(r["transaction_id"] for r in store.read(BANK.raw_table).collect()) == ["1", "2"]


@pytest.mark.parametrize("per_batch", [1, 10])
def test_an_id_in_two_files_is_stored_once(spark, tmp_path, scratch, per_batch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEADER + "1,2024-01-01,A,-5.00,debit\n")
    (tmp_path / "in" / "b.csv").write_text(HEADER + "1,2024-01-01,B,-9.00,debit\n2,2024-01-01,C,-1.00,debit\n")
    store = RawStore(spark, scratch("raw"))
    stream_load(spark, store, BANK, str(tmp_path / "in"), scratch("ckpt"), max_files_per_trigger=per_batch)
    assert sorted(r["transaction_id"] for r in store.read(BANK.raw_table).collect()) == ["1", "2"]


def ids(store, table="t", **more):
    return sorted(r["transaction_id"] for r in store.read(table, **more).collect())


def bank(spark, first, last, text="X", date="2024-01-01"):
    return raw_frame(spark, [(f"i{k:03d}", date, text, -1.0, "debit") for k in range(first, last)], "bank")


def test_a_large_load_has_more_tasks_of_the_same_size(spark, scratch, monkeypatch):
    from tally.sources import raw
    monkeypatch.setattr(raw, "TASK_ROWS", 10)
    monkeypatch.setattr(raw, "BUCKET_ROWS", 40)
    store = RawStore(spark, scratch("raw"), buckets=2)

    def largest_file():
        load = store.versions("t").latest()[1]["loads"][-1]["id"]
        files = spark.read.parquet(f"{store.path('t')}/_load={load}").groupBy(F.input_file_name()).count()
        return files.agg(F.max("count")).first()[0]
    assert store.load(bank(spark, 0, 200), "t").rows_loaded == 200
    assert store.versions("t").latest()[1]["buckets"] == 20 and largest_file() <= 30
    # 1,800 rows more than the buckets were made for: both sides' ids go to more tasks.
    batch = bank(spark, 100, 2_000, "Y")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            store.new_rows(batch, "t", size=1_900).explain("formatted")
        assert plan.getvalue().count("hashpartitioning(transaction_id") + plan.getvalue().count("hashpartitioning(_stored") == 2
        assert ", 200)" in plan.getvalue()  # 1,900 rows in tasks of 10, a multiple of 20 buckets
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert store.load(batch, "t").rows_loaded == 1_800 and largest_file() <= 30
    rows = store.read("t")
    assert rows.count() == rows.select("transaction_id").distinct().count() == 2_000
    assert rows.filter("description = 'X'").count() == 200  # stored rows stay
    assert store.load(batch, "t").rows_loaded == 0
    assert store.load(batch, "t", full_refresh=True).rows_loaded == 1_900
    assert store.versions("t").latest()[1]["buckets"] == 190 and store.read("t").count() == 1_900


def test_a_large_export_lands_as_several_files(spark, scratch, monkeypatch):
    from tally import queries
    monkeypatch.setattr(queries, "LANDED_ROWS", 25)
    folder = scratch("landing")
    export = spark.createDataFrame([(f"i{k}", "2024-01-01", "A", "-1.00", "debit") for k in range(100)],
                                   ",".join(f"{c} string" for c in BANK.required)).repartition(8)
    queries._land(spark, export, folder + "/export-1.csv")
    assert sorted(queries.names_in(spark, folder)) == ["export-1-1.csv", "export-1-2.csv", "export-1-3.csv", "export-1.csv"]
    store = RawStore(spark, scratch("raw"))
    stream_load(spark, store, BANK, folder, scratch("ckpt"))
    assert store.read(BANK.raw_table).select("transaction_id").distinct().count() == store.read(BANK.raw_table).count() == 100


def test_lines_meet_their_headers_where_they_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,2024-01-01,A,-1.00,debit\n")
    (tmp_path / "b.csv").write_text("date,transaction_id,description,amount,transaction_type\n2024-01-02,2,B,-2.00,debit\n")
    plan, before = io.StringIO(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # lines are never shuffled by file
    try:
        rows = read_csv_text(spark, str(tmp_path))
        with contextlib.redirect_stdout(plan):
            rows.explain("formatted")
        assert "SortMergeJoin" not in plan.getvalue()
        assert {(r["transaction_id"], r["date"]) for r in rows.collect()} == {("1", "2024-01-01"), ("2", "2024-01-02")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def racing(store, monkeypatch, other):
    """Let ``other`` load right before the store's next commit."""
    from tally.sources import raw
    todo = [other]

    def commit(self, number, manifest, plain=raw.Versions.commit):
        if todo:
            todo.pop()()
        return plain(self, number, manifest)
    monkeypatch.setattr(raw.Versions, "commit", commit)


def test_two_loads_of_the_same_ids_at_once(spark, scratch, monkeypatch):
    root = scratch("raw")
    store, rival = RawStore(spark, root, buckets=2), RawStore(spark, root, buckets=2)
    store.load(bank(spark, 0, 10), "t")
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 5, 20, "RIVAL"), "t"))
    assert store.load(bank(spark, 0, 30, "MINE"), "t").rows_loaded == 10
    assert ids(store) == [f"i{k:03d}" for k in range(30)]
    texts = {r["transaction_id"]: r["description"] for r in store.read("t").collect()}
    assert (texts["i004"], texts["i012"], texts["i025"]) == ("X", "RIVAL", "MINE")
    # Other ids: nothing is written anew; the very same ids: nothing is left to add.
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 40, 45), "t"))
    assert store.load(bank(spark, 30, 40), "t").rows_loaded == 10
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 50, 60), "t"))
    assert store.load(bank(spark, 50, 60), "t").rows_loaded == 0
    assert ids(store) == [f"i{k:03d}" for k in range(45)] + [f"i{k:03d}" for k in range(50, 60)]


def test_first_loads_and_refreshes_at_once(spark, scratch, monkeypatch):
    root = scratch("raw")
    store, rival = RawStore(spark, root, buckets=2), RawStore(spark, root, buckets=3)
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 0, 5, "RIVAL"), "t"))
    assert store.load(bank(spark, 0, 8), "t").rows_loaded == 3
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 6, 9), "t", full_refresh=True))
    assert store.load(bank(spark, 0, 12), "t").rows_loaded == 9
    assert ids(store) == [f"i{k:03d}" for k in range(12)]
    racing(store, monkeypatch, lambda: rival.load(bank(spark, 20, 30), "t"))
    assert store.load(bank(spark, 0, 2), "t", full_refresh=True).rows_loaded == 2
    assert ids(store) == ["i000", "i001"]


def test_loads_from_threads(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    root = scratch("raw")
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: RawStore(spark, root, buckets=2).load(bank(spark, k, k + 20), "t").rows_loaded, (0, 10, 5, 0)))
    assert sum(done) == 30 and ids(RawStore(spark, root)) == [f"i{k:03d}" for k in range(30)]


def test_killed_writes_leave_the_old_table(spark, scratch, monkeypatch):
    from tally.sources import raw
    store = RawStore(spark, scratch("raw"), buckets=2)
    store.load(bank(spark, 0, 10), "t")

    def killed(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(raw.Versions, "commit", killed)  # all rows written, the job ends before its version
        for refresh in (False, True):
            with pytest.raises(KeyboardInterrupt):
                store.load(bank(spark, 5, 20), "t", full_refresh=refresh)
    broken = bank(spark, 0, 5).withColumn("amount", F.raise_error(F.lit("lost in the middle")).cast("double"))
    with pytest.raises(Exception, match="lost in the middle"):
        store.load(broken, "t", full_refresh=True)
    assert ids(store) == [f"i{k:03d}" for k in range(10)]
    assert ids(RawStore(spark, store.root)) == ids(store) and store.versions("t").numbers() == [1]


def test_readers_keep_their_version(spark, scratch):
    store = RawStore(spark, scratch("raw"), buckets=2)
    store.load(bank(spark, 0, 3), "t")
    old = store.read("t")
    store.load(bank(spark, 3, 5), "t")
    added = store.read("t")
    store.load(bank(spark, 9, 10), "t", full_refresh=True)
    assert (old.count(), added.count(), store.read("t").count()) == (3, 5, 1)
    assert ids(store, version=1) == ["i000", "i001", "i002"] and len(ids(store, version=2)) == 5
    store.vacuum("t", keep=1)
    assert store.versions("t").numbers() == [3] and ids(store) == ["i009"]


def test_start_date_skips_files(spark, scratch):
    store = RawStore(spark, scratch("raw"), buckets=2)
    for month in range(1, 7):
        store.load(bank(spark, 10 * month, 10 * month + 4, date=f"2024-{month:02d}-15"), "t")
    store.load(raw_frame(spark, [("none", None, "A", -1.0, "debit")], "bank"), "t")
    recent = store.read("t", since="2024-05-20")
    assert len(recent.inputFiles()) < len(store.read("t").inputFiles())
    assert ids(store, since="2024-05-20") == sorted([f"i{k:03d}" for m in (5, 6) for k in range(10 * m, 10 * m + 4)] + ["none"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        recent.select("amount").explain("formatted")
    assert re.search(r"PartitionFilters: .*_month#\d+ >= 2024-05", buf.getvalue())
    assert len(store.read("t").columns) == 6


def test_tables_by_year(spark, scratch):
    store = RawStore(spark, scratch("raw"), buckets=2, period="year")
    for k, year in enumerate((2022, 2023, 2024)):
        store.load(bank(spark, 10 * k, 10 * k + 4, date=f"{year}-06-15"), "t")
    assert ids(RawStore(spark, store.root), since="2023-09-01") == [f"i{k:03d}" for j in (10, 20) for k in range(j, j + 4)]
    assert store.versions("t").latest()[1]["loads"][1]["months"] == ["2023"]


def test_new_ids_read_no_stored_id(spark, scratch, monkeypatch):
    store = RawStore(spark, scratch("raw"), buckets=4, bloom_ids=5_000)
    plain = RawStore(spark, scratch("raw"), buckets=4)
    read = []
    rows = RawStore._rows
    monkeypatch.setattr(RawStore, "_rows", lambda self, *a, **k: read.append(self) or rows(self, *a, **k))
    batches = [bank(spark, 0, 300), bank(spark, 300, 900), bank(spark, 900, 901)]
    for batch in batches:
        assert store.load(batch, "t").rows_loaded == plain.load(batch, "t").rows_loaded > 0
    assert store not in read and plain in read  # disjoint batches: filters alone
    some = bank(spark, 890, 950)  # few ids that are stored: their buckets are looked into
    plan, before = io.StringIO(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    with contextlib.redirect_stdout(plan):
        few = store.new_rows(bank(spark, 5, 6).unionByName(bank(spark, 2_000, 2_010)), "t")
        few.explain("formatted")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SelectedBucketsCount: 1 out of 4" in plan.getvalue() and few.count() == 10
    whole = bank(spark, 0, 1_000)  # many: the plain way
    for batch in (some, whole, whole, raw_frame(spark, [(None, "2024-01-01", "N", -1.0, "debit")], "bank")):
        assert store.load(batch, "t").rows_loaded == plain.load(batch, "t").rows_loaded
    assert store.load(raw_frame(spark, [(None, "2024-01-01", "N", -1.0, "debit")], "bank"), "t").rows_loaded == 0
    key = ["transaction_id", "date", "amount"]
    assert sorted(map(str, store.read("t").select(*key).collect())) == sorted(map(str, plain.read("t").select(*key).collect()))


def test_bloom_filters_never_miss_and_seldom_err(spark):
    from tally.sources.blooms import block_count, bloom_filter, possible, united
    stored = spark.range(20_000).select(F.concat(F.lit("id"), F.col("id")).alias("i"))
    blocks = block_count(20_000)
    parts = [bloom_filter(stored.filter(F.pmod(F.xxhash64("i"), F.lit(3)) == k), "i", blocks) for k in range(3)]
    bloom = united(parts[0].unionByName(parts[1]).unionByName(parts[2])).persist()
    assert possible(stored, "i", bloom, blocks).count() == 20_000
    other = spark.range(20_000, 120_000).select(F.concat(F.lit("id"), F.col("id")).alias("i"))
    assert possible(other, "i", bloom, blocks).count() < 20
    bloom.unpersist()


def test_catalog_names_go_with_the_scratch(spark, scratch):
    from tally import session
    store = RawStore(spark, scratch("raw"), buckets=2)
    store.load(bank(spark, 0, 2), "t")
    store.read("t")
    mine = [n for n, where in session._NAMED.items() if where == store.root]
    assert mine and all(spark.catalog.tableExists(n) for n in mine)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tally_load_")]


def test_snapshots_are_whole_and_pinned(spark, scratch):
    store = SnapshotStore(spark, scratch("marts"))
    with pytest.raises(FileNotFoundError):
        store.read("m")
    assert store.write(spark.range(5), "m") == 1
    old = store.read("m")
    broken = spark.range(8).select(F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        store.write(broken, "m")
    assert store.read("m").count() == 5
    assert store.write(spark.range(3).toDF("other"), "m") == 2
    assert old.count() == 5 and store.read("m").columns == ["other"] and store.read("m", version=1).count() == 5
    assert not store.versions("m").commit(2, {}) and store.versions("m").latest()[1]["schema"]
    store.write(spark.range(1), "m")
    store.vacuum("m", keep=1)
    assert store.versions("m").numbers() == [3] and store.read("m").count() == 1


def test_profile_scans_a_source_once(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-01-01", "A", "1", "debit")] * 3, ",".join(f"{c} string" for c in BANK.required))
    p = str(tmp_path / "t")
    df.write.parquet(p)
    checks = quality.profile(spark, spark.read.parquet(p), BANK, with_samples=False)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        checks.explain()
    assert buf.getvalue().count("FileScan") == 1 and "repartition" not in buf.getvalue().lower()
    assert {r["check"]: r["n_bad"] for r in checks.collect()}["duplicate_ids"] == 2


def test_gate_of_a_card_export_by_name(spark, sample_paths):
    gate = quality.load_gate(standardise(read_source(spark, sample_paths["card"], CARD)), "card").first()
    assert gate["passed"] and gate["rows"] == 20 and gate["malformed_rows"] == 0
