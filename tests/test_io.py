"""CSV loading with NA tokens and bad dates (S1-S4, N16, N17); streaming upsert sink."""

import datetime as dt
import os

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from curata.sources import io
from curata.sources.upsert import read_current
from curata.streaming.upsert_stream import start_upsert_stream


def test_csv_na_tokens_and_dates(spark, scratch):
    p = os.path.join(scratch, "orders.csv")
    with open(p, "w") as f:
        f.write("order_id,order_date,total\n")
        f.write("o1,2025-05-01T10:00:00+00:00,10.5\n")
        f.write("o2,not a date,NA\n")
        f.write("NULL,2025-05-02 11:00:00,abc\n")
    schema = StructType([StructField("order_id", StringType()), StructField("order_date", TimestampType()),
                         StructField("total", DoubleType())])
    df = io.read_csv_table(spark, p, schema)
    rows = {r.order_id: r for r in df.collect()}
    assert rows["o1"].order_date == dt.datetime(2025, 5, 1, 10, 0) and rows["o1"].total == 10.5
    assert rows["o2"].order_date is None and rows["o2"].total is None      # bad text -> null
    assert None in rows and rows[None].total is None                       # NULL token, bad number
    raw = io.read_csv_table(spark, p)
    _, fails = io.coerce_timestamps(raw, ["order_date"])
    assert fails.first()["order_date"] == 1


def test_csv_by_name_quotes_and_whole_floats(spark, scratch):
    from pyspark.sql.types import IntegerType, LongType
    p = os.path.join(scratch, "t.csv")
    with open(p, "w") as f:
        f.write('year,order_id,note,big\n1985.0,o1,"say ""hi"", ok",9007199254740993\n1985.5,o2,"two\nlines",7.0\n,o3,"",x\n')
    schema = StructType([StructField("order_id", StringType()), StructField("note", StringType()), StructField("year", IntegerType()),
                         StructField("big", LongType())])
    got = {r.order_id: tuple(r)[1:] for r in io.read_csv_table(spark, p, schema).collect()}
    assert got == {"o1": ('say "hi", ok', 1985, 9007199254740993), "o2": ("two\nlines", None, 7), "o3": (None, None, None)}
    with pytest.raises(ValueError, match="gone"):
        io.read_csv_table(spark, p, StructType([StructField("gone", StringType())]))


BAD_CSV = """id,n,at,note
a,1,2025-01-01,fine
b,2,2025-01-02,"two, ""quoted"" cells",extra
c,3
d,abc,never,"broken
line"
e,4.0,2025-01-03,NA
f,,,
g,5,2025-01-04,x,y,z
"""


@pytest.mark.parametrize("multi_line", [True, False])
def test_rejected_records_and_bad_cells_are_kept_and_counted(spark, scratch, multi_line):
    from pyspark.sql.types import IntegerType
    os.makedirs(f"{scratch}/in/t.csv")
    text = BAD_CSV if multi_line else BAD_CSV.replace('"broken\nline"', "broken")
    for k in range(2):
        with open(f"{scratch}/in/t.csv/part{k}.csv", "w") as f:
            f.write(text)
    schema = StructType([StructField("at", TimestampType()), StructField("id", StringType()), StructField("n", IntegerType()), StructField("note", StringType())])
    rows, counts = io.land_csv(spark, f"{scratch}/in/t.csv", schema, f"{scratch}/out", "t", "r1", multi_line)
    assert rows.columns == ["at", "id", "n", "note"]
    assert counts == {"rows_read": 14, "rows_rejected": 6, "bad at": 2, "bad n": 2}
    got = rows.collect()
    assert len(got) == counts["rows_read"] - counts["rows_rejected"]
    assert sorted({(r.id, r.n, r.note) for r in got}) == [("a", 1, "fine"), ("d", None, "broken\nline" if multi_line else "broken"), ("e", 4, None), ("f", None, None)]
    rejected = spark.read.parquet(f"{scratch}/out/quarantine/t_rejected/run_id=r1").collect()
    assert sorted((r._reason, r._record[0]) for r in rejected) == [("short record", "c")] * 2 + [("surplus cells", "b")] * 2 + [("surplus cells", "g")] * 2
    assert {os.path.basename(r._file) for r in rejected} == {"part0.csv", "part1.csv"}
    cells = spark.read.parquet(f"{scratch}/out/quarantine/t_cells/run_id=r1").collect()
    assert sorted((r["column"], r.text) for r in cells) == [("at", "never")] * 2 + [("n", "abc")] * 2


def test_counts_come_from_the_pass_that_writes(spark, scratch):
    """One scan of the CSV files per table: the counts are observed while the rows are written."""
    with open(f"{scratch}/t.csv", "w") as f:
        f.write(BAD_CSV)
    schema = StructType([StructField("id", StringType()), StructField("at", TimestampType())])
    plan = io.parsed_csv(spark, f"{scratch}/t.csv", schema)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("land", "land")
    try:
        io.land_csv(spark, f"{scratch}/t.csv", schema, f"{scratch}/out", "t", "r1")
        # the header, the write, and the two small tables read back from it
        assert len(tracker.getJobIdsForGroup("land")) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_load_tables_lists_missing(spark):
    with pytest.raises(FileNotFoundError, match="nope"):
        io.load_tables(spark, "/root/testdata/sf0.001", ["orders", "nope"])
    inv = io.inventory(io.load_tables(spark, "/root/testdata/sf0.001", ["region"]), {"region": 5}).first()
    assert inv.rows == 5 and inv.delta_vs_expected == 0


def test_zone_path():
    assert io.zone_path("/w", "curated", "orders") == "/w/curated/orders"
    with pytest.raises(ValueError):
        io.zone_path("/w", "nowhere", "orders")


def test_streaming_upsert(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    T = dt.datetime
    schema = "id string, updated_at timestamp, v string"
    spark.createDataFrame([("a", T(2025, 1, 1), "1"), ("b", T(2025, 1, 1), "1")], schema).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema(schema).parquet(f"{src}/*")
    target = os.path.join(scratch, "curated")
    q = start_upsert_stream(stream, target, "id", "updated_at", os.path.join(scratch, "ckpt"))
    q.processAllAvailable()
    spark.createDataFrame([("a", T(2025, 1, 2), "2"), ("b", T(2024, 1, 1), "0")], schema).write.parquet(f"{src}/b2")
    q.processAllAvailable()
    q.stop()
    got = {r.id: r.v for r in read_current(spark, target).collect()}
    assert got == {"a": "2", "b": "1"}                 # newer wins, late older row ignored


def test_run_daily_keeps_every_line_and_is_idempotent(spark, scratch):
    from curata.plans.daily import run_daily
    sf = "/root/testdata/sf0.001"
    base = os.path.join(scratch, "lake")
    out1 = run_daily(spark, sf, base, "2026-01-01")
    n_in = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert out1.get("lines_curated", 0) + out1.get("lines_quarantine", 0) == n_in      # curated ∪ quarantine = input
    q = spark.read.parquet(f"{base}/quarantine/lineitem")
    assert q.count() == out1["lines_quarantine"]
    curated = read_current(spark, f"{base}/curated/lineitem")
    assert curated.count() == curated.select("l_orderkey", "l_linenumber").distinct().count()
    reg = spark.read.parquet(f"{base}/monitoring/anomaly_register")
    n_reg = reg.count()
    run_daily(spark, sf, base, "2026-01-01")                                 # same day again
    assert spark.read.parquet(f"{base}/quarantine/lineitem").count() == out1["lines_quarantine"]
    assert spark.read.parquet(f"{base}/monitoring/anomaly_register").count() == n_reg
    assert read_current(spark, f"{base}/curated/lineitem").count() == curated.count()


def test_run_profiling_writes_report_tables(spark, scratch):
    from curata.plans.report import run_profiling
    sf = "/root/testdata/sf0.001"
    paths = run_profiling(spark, sf, scratch, "2025-05-01", ["anomaly_register", "orders_by_month"])
    assert paths["anomaly_register"].endswith("/monitoring/anomaly_register")
    assert paths["orders_by_month"].endswith("/marts/orders_by_month")
    reg = spark.read.parquet(paths["anomaly_register"])
    assert reg.where("run_id = '2025-05-01'").count() == 14
    with pytest.raises(ValueError, match="salt"):
        run_profiling(spark, sf, scratch, "2025-05-01", ["pii_rehash"])
    # re-running the same day replaces it
    run_profiling(spark, sf, scratch, "2025-05-01", ["anomaly_register"])
    assert spark.read.parquet(paths["anomaly_register"]).count() == 14


def test_locate_tables_override_then_candidates(spark, scratch):
    import os

    import pytest

    from curata.sources.io import locate_tables
    full, partial = os.path.join(scratch, "full"), os.path.join(scratch, "partial")
    for folder, tables in ((full, ["a", "b"]), (partial, ["a"])):
        os.makedirs(folder)
        for t in tables:
            open(os.path.join(folder, f"{t}.csv"), "w").write("x\n1\n")
    assert locate_tables(spark, ["a", "b"], [partial, full]) == full
    assert locate_tables(spark, ["a"], [full], override=partial) == partial
    with pytest.raises(FileNotFoundError, match="searched"):
        locate_tables(spark, ["a", "b"], [partial], override=os.path.join(scratch, "nowhere"))


def test_session_factory(spark):
    from curata.session import get_spark
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert get_spark() is not None
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        with pytest.raises(ValueError, match="UTC"):
            get_spark()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
