"""Landed files: drift, corrupt records, fingerprints and incremental pickup; quality rules."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators import bronze, quality
from folioforge.schemas import LANDED
from folioforge.session import materialize
from folioforge.sinks.tables import replace_months
from folioforge.sources.landing import event_files, header_columns, read_landed
from folioforge.sources.tables import batch_of
from folioforge.streaming.ingest import BATCH, ingest_stream, read_ingested

DECLARED = LANDED["currencies"]
AT = "2026-02-01 00:00:00"


def put(base, name, text, month="202601"):
    path = base / "currencies" / month / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def ingest(spark, path, load_id="l1", at=AT):
    raw = bronze.with_control_columns(read_landed(spark, str(path), DECLARED), "snapshot", load_id, at)
    return materialize(raw, "raw")


def test_files_with_different_headers_lose_nothing(spark, rows, tmp_path):
    put(tmp_path, "a.csv", "currency_code,currency_name,decimal_precision,as_of_month\nUSD,Dollar,2,202601\n")
    put(tmp_path, "b.csv", "as_of_month,symbol,currency_code,decimal_precision\n202601,E,EUR,2\n")
    raw = ingest(spark, event_files(str(tmp_path), "currencies", "202601"))
    assert rows(raw, "currency_code", "currency_name", "decimal_precision", "symbol") == [
        ("EUR", None, 2, "E"), ("USD", "Dollar", 2, None)]
    assert rows(raw, "source_file_name", "source_yyyymm") == [("a.csv", "202601"), ("b.csv", "202601")]
    report = bronze.drift_report(raw, [f.name for f in DECLARED])
    assert rows(report, "new_columns", "missing_columns", "row_count") == [
        (["symbol"], ["currency_name"], 1), ([], [], 1)]


def test_corrupt_records_are_flagged_and_kept(spark, rows, tmp_path):
    put(tmp_path, "a.csv", "currency_code,currency_name,decimal_precision,as_of_month\n"
        "USD,Dollar,2,202601\nEUR,Euro,two,202601\nGBP,Pound\nINR,Rupee,2,202601,extra\n")
    clean, corrupt = bronze.split_corrupt(ingest(spark, tmp_path))
    assert rows(clean, "currency_code") == [("USD",)]
    assert rows(corrupt, "currency_code") == [("EUR",), ("GBP",), ("INR",)]
    assert corrupt.where("_corrupt_record = 'EUR,Euro,two,202601'").count() == 1


def test_fingerprint_depends_on_the_record_only(spark, rows, tmp_path):
    put(tmp_path, "a.csv", "currency_code,currency_name,decimal_precision,as_of_month\nUSD,Dollar,2,202601\n")
    first = ingest(spark, tmp_path)
    second = ingest(spark, tmp_path, "l2", "2027-01-01 00:00:00")
    assert rows(first, "record_hash") == rows(second, "record_hash")
    assert set(bronze.CONTROL) <= set(first.columns)


def test_no_readable_file_is_an_error(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(FileNotFoundError):
        read_landed(spark, str(tmp_path), DECLARED)


def test_stream_picks_up_new_files_only(spark, rows, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    header = "currency_code,currency_name,decimal_precision,as_of_month\n"
    put(landing, "a.csv", header + "USD,Dollar,2,202601\nEUR,Euro,x,202601\n")

    def run():
        ingest_stream(spark, str(landing), DECLARED, table, progress, "snapshot", "l1", AT).awaitTermination()
        return rows(spark.read.parquet(table), "currency_code", "source_yyyymm", "is_corrupt_record")

    assert run() == [("EUR", "202601", True), ("USD", "202601", False)]
    assert len(run()) == 2
    put(landing, "b.csv", header + "GBP,Pound,2,202602\n", month="202602")
    assert run() == [("EUR", "202601", True), ("GBP", "202602", False), ("USD", "202601", False)]


def stream(spark, landing, table, progress, **more):
    ingest_stream(spark, str(landing), DECLARED, table, progress, "snapshot", "l1", AT, **more).awaitTermination()
    return read_ingested(spark, table)


def test_stream_takes_changed_headers(spark, rows, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(landing, "a.csv", "currency_code,currency_name,decimal_precision,as_of_month\nUSD,Dollar,2,202601\n")
    assert stream(spark, landing, table, progress).count() == 1
    # one column more, one less, another order, and a file of the first layout in the same batch
    put(landing, "b.csv", "as_of_month,symbol,currency_code,decimal_precision\n202602,E,EUR,2\n", "202602")
    put(landing, "c.csv", "currency_code,currency_name,decimal_precision,as_of_month\nGBP,Pound,x,202602\n", "202602")
    shown = ("currency_code", "currency_name", "symbol", "source_yyyymm", "is_corrupt_record", "source_file_name")
    want = [("EUR", None, "E", "202602", False, "b.csv"), ("GBP", "Pound", None, "202602", True, "c.csv"),
            ("USD", "Dollar", None, "202601", False, "a.csv")]
    assert rows(stream(spark, landing, table, progress), *shown) == want
    assert rows(stream(spark, landing, table, progress), *shown) == want
    lists = stream(spark, landing, table, progress).where("currency_code = 'EUR'").select("source_column_list").first()
    assert lists[0] == ["as_of_month", "currency_code", "decimal_precision", "symbol"]


def test_batch_that_runs_again_replaces_its_rows(spark, rows, tmp_path):
    """Progress of the last micro-batch is lost after its rows were written, as in a crash between the two."""
    landing, table, progress = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    for n in range(3):
        put(landing, f"{n}.csv", f"currency_code,note{n}\nC{n},text\n")
    raw = stream(spark, landing, table, str(progress), files_per_batch=1)
    assert raw.select(BATCH).distinct().count() == 3
    want = rows(raw, "currency_code", "note0", "note1", "note2", BATCH)
    for name in ("2", ".2.crc"):
        (progress / "commits" / name).unlink(missing_ok=True)
    assert rows(stream(spark, landing, table, str(progress)), "currency_code", "note0", "note1", "note2", BATCH) == want
    # a stream of its own does not touch the rows of the first
    assert stream(spark, landing, table, str(tmp_path / "cp2")).count() == 6


def test_streams_of_blank_files_write_nothing(spark, tmp_path):
    landing, table = tmp_path / "in", tmp_path / "out"
    put(landing, "a.csv", "\n\n")
    ingest_stream(spark, str(landing), DECLARED, str(table), str(tmp_path / "cp"), "snapshot", "l1", AT).awaitTermination()
    assert not table.exists()


def test_headers(spark, rows, tmp_path):
    assert header_columns("\ufeffa,,b,A,_corrupt_record") == ["a", "_c1", "b", "A_3", "_corrupt_record_4"]
    put(tmp_path, "a.csv", "\ufeff\n\ncurrency_code,note,note,\r\nUSD,x,y,z\r\n\r\n\"E,R\",\"\",,\r\n")
    # joined end to end: the second header is no record
    put(tmp_path, "b.csv", "Currency_Code,`odd`\nGBP,1\nCurrency_Code,`odd`\nINR,2\n")
    put(tmp_path, "c.csv", "currency_code\n")
    raw = read_landed(spark, str(tmp_path), DECLARED)
    assert rows(raw, "currency_code", "note", "note_2", "_c3", "```odd```", "_corrupt_record") == [
        ("E,R", None, None, None, None, None), ("GBP", None, None, None, "1", None), ("INR", None, None, None, "2", None),
        ("USD", "x", "y", "z", None, None)]
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1  # whatever the number of headers


def test_split_files_have_one_header(spark, rows, tmp_path):
    lines = [f"C{n:05d},Name {n},{n % 7},202601" for n in range(3000)]
    put(tmp_path, "a.csv", "currency_code,currency_name,decimal_precision,as_of_month\n" + "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        raw = read_landed(spark, str(tmp_path), DECLARED)
        assert raw.select(F.spark_partition_id()).distinct().count() > 3
        assert rows(raw.where("_corrupt_record IS NULL"), "currency_code") == [(f"C{n:05d}",) for n in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_align_and_project(spark):
    df = spark.createDataFrame([("a", "1")], "z string, b string")
    target = T.StructType([T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    assert bronze.align(df, target).columns == ["b", "c", "z"]
    declared = T.StructType([T.StructField("b", T.LongType()), T.StructField("n", T.DateType())])
    row = quality.project_to(df, declared).first()
    assert row.asDict() == {"b": 1, "n": None}
    assert [tuple(v) for v in quality.schema_violations(df.schema, declared)] == [
        ("b", "is string, expected bigint"), ("n", "missing"), ("z", "unexpected")]


def test_quality_rules(spark, rows):
    df = spark.createDataFrame(
        [("a", "2026-01-01", 1.0), ("a", "2026-13-01", None), (None, None, -1.0), ("b", "2026-02-30", 2.0)],
        "k string, d string, v double",
    )
    assert rows(quality.null_shares(df, {"k": 0.5, "v": 0.1}), "column_name", "null_share", "is_breached") == [
        ("k", 0.25, False), ("v", 0.25, True)]
    assert rows(quality.null_shares(df.where("false"), {"k": 0.5}), "null_share", "is_breached") == [(None, False)]
    assert rows(quality.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert rows(quality.invalid_dates(df, "d"), "d") == [("2026-02-30",), ("2026-13-01",), (None,)]
    known = spark.createDataFrame([("a",)], "k string")
    assert rows(quality.unknown_references(df, known, "k"), "k") == [("b",), (None,)]
    assert rows(quality.orphan_keys(df, known, "k")) == [("b", 1), (None, 1)]
    rules = {"dated": F.try_to_date("d").isNotNull(), "positive": F.col("v") > 0}
    accepted, rejected = quality.split_rejects(df, rules)
    assert rows(accepted, "k", "v") == [("a", 1.0)]
    assert rows(rejected, "reject_reasons") == [(["dated", "positive"],), (["dated", "positive"],), (["dated"],)]
    assert accepted.count() + rejected.count() == df.count()


def test_batch_scan_reads_one_partition(spark, rows, tmp_path):
    raw = spark.createDataFrame([("a", "202601"), ("b", "202602"), ("c", None)], "k string, source_yyyymm string")
    replace_months(raw, str(tmp_path / "raw"), "source_yyyymm")
    batch = batch_of(spark, str(tmp_path / "raw"), "202601")
    assert rows(batch, "k", "source_yyyymm") == [("a", "202601")]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_yyyymm" in plan and "PushedFilters: []" in plan
    assert rows(batch_of(spark, str(tmp_path / "raw"), "209901")) == []
