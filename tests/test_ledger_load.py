"""Loads by content with their error account; exclusive records, claims and
commits that recover."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lakeshore.plans import ledger_load as L
from lakeshore.plans import records, storage
from lakeshore.session import local_path

HEADER = "location_name,location_id,ts,temperature_2m,precipitation,windspeed_10m,source,ingested_at,run_id\n"


def row(i, temperature="1.5", ts="2026-02-23 0{h}:00:00"):
    return f'"Chicago, IL",{i},{ts.format(h=str(i)[-1] if str(i)[-1].isdigit() else 0)},{temperature},NULL,,open-meteo,2026-03-01 05:00:00,7\n'


def land(folder, name, *rows, when=None):
    path = os.path.join(local_path(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(HEADER + "".join(rows))
    if when:
        os.utime(path, (when, when))
    return path


def statuses(report):
    return {r["file"].rsplit("/", 1)[1]: (r["status"], r["rows_parsed"], r["rows_loaded"], r["errors_seen"])
            for r in report.collect()}


def test_only_new_content_is_loaded(spark, scratch):
    src, root = f"{scratch}/in", f"{scratch}/table"
    land(src, "a.csv", row(1), row(2), when=1_700_000_000)
    land(src, "b.csv", row(3), when=1_700_000_000)
    land(src, "empty.csv")
    land(src, "notes.txt", "not a CSV file")
    assert statuses(L.load_files(spark, src, root)) == {
        "a.csv": ("LOADED", 2, 2, 0), "b.csv": ("LOADED", 1, 1, 0), "empty.csv": ("LOADED", 0, 0, 0)}
    assert L.load_files(spark, src, root).count() == 0
    land(src, "deep er/copy of a.csv", row(2), row(1))      # a's records under another name and order
    land(src, "b.csv", row(4), when=1_700_000_001)          # rewritten in place, same length
    land(src, "c.csv", row(5))
    land(src, "d.csv", row(5))                              # two new files with the same records
    land(src, "a.csv", row(1), row(2), when=1_700_000_009)  # touched, not changed
    got = {k.replace("%20", " "): v for k, v in statuses(L.load_files(spark, src, root)).items()}
    assert got == {"copy of a.csv": ("DUPLICATE", 2, 0, 0), "b.csv": ("LOADED", 1, 1, 0), "c.csv": ("LOADED", 1, 1, 0),
                   "d.csv": ("DUPLICATE", 1, 0, 0), "a.csv": ("DUPLICATE", 2, 0, 0)}
    assert sorted(r.location_id for r in L.loaded_rows(spark, root).collect()) == [1, 2, 3, 4, 5]
    assert L.load_files(spark, src, root).count() == 0
    one = L.loaded_rows(spark, root).where("location_id = 1").first()
    assert (one.location_name, one.temperature_2m, one.precipitation, one.windspeed_10m) == ("Chicago, IL", 1.5, None, None)


def bad_files(src):
    land(src, "good.csv", row(1), row(2))
    land(src, "some.csv", row(3), row(4, "n/a"), "too,few\n", row(5), '"open,9,x\n', row(6, ts="2026-02-30 00:00:00"))
    land(src, "none.csv", row("x"), row(7).strip() + ",one more\n")


def test_errors_are_kept_with_file_record_and_column(spark, scratch):
    src, root = f"{scratch}/in", f"{scratch}/table"
    bad_files(src)
    report = L.load_files(spark, src, root, on_error="continue")
    assert statuses(report) == {"good.csv": ("LOADED", 2, 2, 0), "some.csv": ("PARTIALLY_LOADED", 6, 2, 4),
                                "none.csv": ("LOAD_FAILED", 2, 0, 2)}
    first = report.where("file LIKE '%some.csv'").first()
    assert (first.first_error, first.first_error_row, first.first_error_column) == ("not a double", 2, "temperature_2m")
    rejects = {(r.file.rsplit("/", 1)[1], r.row_number, r.column, r.value, r.reason)
               for r in L.rejected_records(spark, root).collect()}
    assert rejects == {
        ("some.csv", 2, "temperature_2m", "n/a", "not a double"), ("some.csv", 3, None, None, "wrong number of columns"),
        ("some.csv", 5, None, None, "open quote"), ("some.csv", 6, "ts", "2026-02-30 00:00:00", "not a timestamp_ntz"),
        ("none.csv", 1, "location_id", "x", "not a bigint"), ("none.csv", 2, None, None, "wrong number of columns")}
    assert L.rejected_records(spark, root).where("row_number = 3").first().record == "too,few"
    assert sorted(r.location_id for r in L.loaded_rows(spark, root).collect()) == [1, 2, 3, 5]
    # A failed file is tried again; mended it loads.
    assert statuses(L.load_files(spark, src, root, on_error="continue")) == {"none.csv": ("LOAD_FAILED", 2, 0, 2)}
    land(src, "none.csv", row(8))
    assert statuses(L.load_files(spark, src, root)) == {"none.csv": ("LOADED", 1, 1, 0)}


def test_skip_file_and_abort(spark, scratch):
    src, root = f"{scratch}/in", f"{scratch}/table"
    bad_files(src)
    with pytest.raises(L.LoadAborted, match=r"none.csv record 1 column location_id: not a bigint \(2 in all\)"):
        L.load_files(spark, src, root)
    assert L.load_history(spark, root).count() == 0 and L.loaded_rows(spark, root).count() == 0
    assert statuses(L.load_files(spark, src, root, on_error="skip_file")) == {
        "good.csv": ("LOADED", 2, 2, 0), "some.csv": ("LOAD_FAILED", 6, 0, 4), "none.csv": ("LOAD_FAILED", 2, 0, 2)}
    assert sorted(r.location_id for r in L.loaded_rows(spark, root).collect()) == [1, 2]
    with pytest.raises(ValueError, match="on_error"):
        L.load_files(spark, src, root, on_error="ignore")


def test_record_numbers_of_a_file_read_in_blocks(spark, scratch):
    src, root = f"{scratch}/in", f"{scratch}/table"
    land(src, "large.csv", *(row(i, "bad" if i % 997 == 0 else "1") for i in range(1, 6001)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        L.load_files(spark, src, root, on_error="continue")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    rejects = L.rejected_records(spark, root).collect()
    assert sorted(r.row_number for r in rejects) == [997 * k for k in range(1, 7)]
    assert L.load_history(spark, root).first().first_error_row == 997


def test_a_load_that_dies_has_not_happened_and_a_lost_race_starts_again(spark, scratch, monkeypatch):
    src, root = f"{scratch}/in", f"{scratch}/table"
    land(src, "a.csv", row(1))
    with monkeypatch.context() as m:
        m.setattr(storage, "_commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            L.load_files(spark, src, root)
    assert L.loaded_rows(spark, root).count() == 0
    commit = storage._commit

    def beaten(spark_, path, version, folder, **k):
        monkeypatch.setattr(storage, "_commit", commit)
        L.load_files(spark, src, root)          # another load of the same files is faster
        commit(spark_, path, version, folder, **k)
    monkeypatch.setattr(storage, "_commit", beaten)
    assert L.load_files(spark, src, root).count() == 0
    assert [r.location_id for r in L.loaded_rows(spark, root).collect()] == [1]


# ---------------------------------------------------------------- records

def test_a_record_is_whole_and_has_one_writer(spark, scratch):
    assert records.names(spark, scratch) == [] and records.next_number(spark, scratch) == 1
    wins = []

    def write(i):
        wins.append(records.create(spark, scratch, "000000001.json", f'{{"by": {i}}}'))
    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(wins) == [False] * 5 + [True]
    assert records.names(spark, scratch) == ["000000001.json"] and "by" in records.read(spark, scratch, "000000001.json")
    assert records.next_number(spark, scratch) == 2 and records.read(spark, scratch, "2.json") is None


def test_rename_without_overwriting_is_exclusive(spark, scratch, monkeypatch):
    # The way of file systems without hard links.
    monkeypatch.setattr(records, "_file", lambda spark, path: (
        spark._jvm.org.apache.hadoop.fs.Path(f"file://{local_path(path)}"), _NoLinks(spark)))
    assert records.create(spark, scratch, "1.json", "one") and not records.create(spark, scratch, "1.json", "two")
    with open(f"{local_path(scratch)}/1.json") as f:
        assert f.read() == "one"


class _NoLinks:
    def __init__(self, spark):
        path = spark._jvm.org.apache.hadoop.fs.Path("file:///")
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def getScheme(self):  # noqa: N802
        return "other"

    def __getattr__(self, name):
        return getattr(self.fs, name)


def test_a_broken_commit_record_locks_nothing(spark, scratch):
    for text in ("", '{"version": 2, "fold'):
        path = f"{scratch}/{len(text)}"
        df = spark.range(3).withColumn("day", F.lit("2026-01-01").cast("date"))
        storage.replace_table(df, path)
        with open(f"{local_path(path)}/_commits/000000002.json", "w") as f:
            f.write(text)
        assert storage.read_current(spark, path).count() == 3
        assert storage.replace_table(df.limit(1), path) == 3
        assert storage.read_current(spark, path).count() == 1
        days = f"{scratch}/days{len(text)}"
        for n in (1, 2):
            storage.upsert_partitions(spark, days, df.schema, df.where(f"id < {n}"), ["id"], "day", F.col("day"))
            with open(f"{local_path(days)}/_commits/{storage.next_version(spark, days):09d}.json", "w") as f:
                f.write(text)
        assert storage.read_parts(spark, days, df.schema).count() == 2


def test_upserts_at_once_lose_nothing(spark, scratch):
    schema = "id long, v long, day date"
    errors = []

    def write(i):
        try:
            rows = spark.createDataFrame([(i, i, None), (100, i, None)], schema)
            storage.upsert_partitions(spark, scratch, rows.schema, rows.drop("day"), ["id"], "day",
                                      F.lit("2026-01-01").cast("date"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = storage.read_parts(spark, scratch, spark.createDataFrame([], schema).schema).collect()
    assert sorted(r.id for r in got) == [0, 1, 2, 3, 100]


def test_claims_never_overlap(spark, scratch):
    got = []

    def claim(i):
        got.append((records.claim_ids(spark, scratch, i + 1, after=10), i + 1))
    threads = [threading.Thread(target=claim, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    ids = [k for first, n in got for k in range(first, first + n)]
    assert sorted(ids) == list(range(11, 11 + sum(range(1, 7))))
    once = records.claim_ids(spark, scratch, 5, owner="job 1 batch 3")
    assert records.claim_ids(spark, scratch, 5, owner="job 1 batch 3") == once
    assert records.claim_ids(spark, scratch, 1, owner="job 1 batch 4") == once + 5
    assert records.claim_ids(spark, scratch, 1, after=1000) == 1001
