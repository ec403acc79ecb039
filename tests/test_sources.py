import csv
import datetime as dt
import io
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from sparkmart.plans import entities, ledger, spec
from sparkmart.sources import delimited, raw, tables

NOTES = spec.EntitySpec(
    name="notes", separator=",", fields=(spec.trimmed("id"), spec.trimmed("note"), spec.trimmed("tag")),
    keys=("id",), hashed=("id",), order=(), rules=lambda: [], admits=lambda: [],
)


def test_quotes_stay_and_empty_fields_are_null(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text('product_category_name|product_category_name_english\n"a"|x,y\n|b\n', encoding="utf-8")
    got = delimited.read_delimited(spark, str(file), entities.TRANSLATION).collect()
    assert [tuple(r) for r in got] == [('"a"', "x,y"), (None, "b")]


def write_notes(path, count, seed=7):
    random.seed(seed)
    pieces = ["plain", 'say "hi"', "a,b", "x|y", "line\nbreak", "cr\r\nlf", "", " padded ", '"', "ção", "\n\n"]
    rows = [(str(i), " ".join(random.choice(pieces) for _ in range(random.randint(0, 6))), random.choice(pieces)) for i in range(count)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    writer.writerow(("id", "note", "tag"))
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())

    def flat(v):
        return v.replace("|", " ").replace("\r", " ").replace("\n", " ").strip(" ") or None

    return sorted((i, flat(n), flat(t)) for i, n, t in rows)


def test_quoted_fields_are_flattened(spark, tmp_path, rows):
    want = sorted(write_notes(tmp_path / "notes.csv", 200), key=repr)
    path = str(tmp_path / "notes.csv")
    assert rows(delimited.read_quoted(spark, path, NOTES)) == want


QUOTED = {
    "quotes inside plain fields": (b'1,5" screen,x\n2,plain,y\n3,7" tab,z\n4,last,w\n', [("1", '5" screen', "x"), ("2", "plain", "y"), ("3", '7" tab', "z"), ("4", "last", "w")]),
    "one stray quote": (b'1,5" screen,x\n2,plain,y\n3,tab,z\n4,last,w\n', [("1", '5" screen', "x"), ("2", "plain", "y"), ("3", "tab", "z"), ("4", "last", "w")]),
    "two blanks for a line break of two signs": (b'1,"a\r\nb",x\r\n2,"q","z"\r\n3,p,"e""e"\r\n', [("1", "a  b", "x"), ("2", "q", "z"), ("3", "p", 'e"e')]),
    "quoted and unquoted fields": (b'1,"x,y|z",\n2,ab"cd"ef,"k"\n3,"open "" q",""\n', [("1", "x,y z", None), ("2", 'ab"cd"ef', "k"), ("3", 'open " q', None)]),
}


@pytest.mark.parametrize("case", QUOTED)
@pytest.mark.parametrize("split", ["64", "100000"])
@pytest.mark.parametrize("head", [b"id,note,tag\n", b"\nid,note,tag\n"])
def test_quoted_files_of_every_shape(spark, tmp_path, rows, case, split, head):
    text, want = QUOTED[case]
    for copy in ("a.csv", "b.csv"):
        (tmp_path / copy).write_bytes(head + text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rows(delimited.read_quoted(spark, str(tmp_path), NOTES))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(want * 2, key=repr)


@pytest.mark.parametrize("seed", range(8))
def test_records_cut_split_by_split_equal_whole_files(spark, tmp_path, rows, seed):
    rng = random.Random(seed)
    head = rng.choice(["id,note,tag\n", "\n\nid,note,tag\n", '"i\nd",note,tag\r\n'])
    for name in ("a.csv", "b.csv"):
        text = "".join(rng.choice('ab",\n\n"é') for _ in range(400)) + rng.choice(["", "\n", '"', '",\n'])
        (tmp_path / name).write_text(head + text, encoding="utf-8", newline="")
    want = rows(delimited.read_quoted(spark, str(tmp_path), NOTES, whole_below=1 << 30))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.choice([7, 33, 150])))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = delimited.read_quoted(spark, str(tmp_path), NOTES)
        assert rows(got) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_record_over_many_splits(spark, tmp_path, rows):
    note = "x" * 40 + "\n" + "y" * 300 + "\r\n" + "z, "
    (tmp_path / "a.csv").write_text(f'id,note,tag\n1,"{note}",t\n2,b,u\n3,"open\n', encoding="utf-8", newline="")
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    (tmp_path / "head.csv").write_text("id,note,tag", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rows(delimited.read_quoted(spark, str(tmp_path), NOTES))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [("1", "x" * 40 + " " + "y" * 300 + "  z,", "t"), ("2", "b", "u"), ("3", "open", None)]


def test_empty_source_is_an_error(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("product_category_name|product_category_name_english\n", encoding="utf-8")
    with pytest.raises(raw.EmptyLoad):
        raw.append_raw(delimited.read_delimited(spark, str(file), entities.TRANSLATION), str(tmp_path / "raw"), "b", "t.csv")


def test_batches_are_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch in ("b1", "b2"):
        raw.append_raw(spark.range(3).select(F.lit(batch).alias("v")), path, batch, "f.csv")
    one = raw.read_batch(spark, path, "b1")
    assert {r["v"] for r in one.collect()} == {"b1"}
    assert "PartitionFilters: [isnotnull(batch_id" in one._jdf.queryExecution().executedPlan().toString()
    assert {r["v"] for r in raw.latest_batch(spark.read.parquet(path)).collect()} == {"b2"}
    assert set(one.columns) == {"row_id", "v", "load_ts", "file_name", "batch_id"}


def test_changed_sources(spark):
    at = dt.datetime
    log = spark.createDataFrame(
        [("a.csv", "SUCCESS", at(2024, 1, 2)), ("a.csv", "FAILED", at(2024, 1, 9)), ("b.csv", "SUCCESS", at(2024, 1, 2)),
         ("c.csv", "FAILED", at(2024, 1, 2))], "file_name string, status string, load_ts timestamp")
    sources = spark.createDataFrame(
        [("a.csv", at(2024, 1, 3)), ("b.csv", at(2024, 1, 1)), ("c.csv", at(2024, 1, 1)), ("d.csv", at(2024, 1, 1))],
        "file_name string, modified_ts timestamp")
    assert sorted(r["file_name"] for r in raw.changed_sources(sources, log).collect()) == ["a.csv", "c.csv", "d.csv"]


def test_file_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a")
    (tmp_path / "y.txt").write_text("a")
    assert [r["file_name"] for r in raw.source_files(spark, str(tmp_path)).collect()] == ["x.csv"]


def test_failed_version_is_never_current(spark, tmp_path):
    root = str(tmp_path)
    ledger.create(spark, root)

    def log(version, status, minute):
        ledger.append(ledger.row(spark, "load_log", table_name="cleansed/t", version=version, status=status,
                                 load_ts=dt.datetime(2024, 1, 1, 0, minute)), root, "load_log")

    assert tables.read_current(spark, root, "cleansed/t") is None
    first = tables.write_version(spark.range(1), root, "cleansed/t")
    log(first, "SUCCESS", 1)
    log(tables.write_version(spark.range(9), root, "cleansed/t"), "FAILED", 2)
    assert tables.read_current(spark, root, "cleansed/t").count() == 1
    log(tables.write_version(spark.range(5), root, "cleansed/t"), "SUCCESS", 3)
    assert tables.read_current(spark, root, "cleansed/t").count() == 5


def test_staged_copy_lives_in_the_named_folder_and_goes_away(spark, tmp_path):
    folder = tables.staging_folder(spark, str(tmp_path) + "/")
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or str(tmp_path)).rstrip("/")

    def copies():
        return {p.name for p in pathlib.Path(folder).glob("sparkmart-*")} if pathlib.Path(folder).exists() else set()

    before = copies()
    with tables.materialised(spark.range(4), str(tmp_path)) as copy:
        assert copy.count() == 4 and len(copies() - before) == 1
    assert copies() == before


def test_ledger_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        ledger.row(spark, "job_log", nonsense=1)


def test_job_status(spark):
    rows = [("j1", "p1", "SUCCESS"), ("j1", "p2", "SUCCESS"), ("j2", "p1", "FAILED"), ("j2", "p2", "SUCCESS"),
            ("j3", "p1", "FAILED"), ("j3", "p1", "RUNNING")]
    log = spark.createDataFrame(rows, "job_run_id string, pipeline string, status string")
    got = {r["job_run_id"]: (r["status"], r["pipeline_count"], r["pipelines_failed"]) for r in ledger.job_rollup(log).collect()}
    assert got == {"j1": ("SUCCESS", 2, 0), "j2": ("PARTIAL", 2, 1), "j3": ("FAILED", 1, 1)}
