"""Feature store: partitioned sink, incremental dates, upsert, versions."""

from pyspark.sql import functions as F

from paylabel.plans import stores
from paylabel.queries import sender_spec
from paylabel.session import shared_path
from paylabel.sources import fixtures, io

SF = "/root/testdata/sf0.001"


def test_incremental_build_and_upsert(spark):
    t = fixtures.transactions(spark, SF)
    spec = sender_spec(spark, SF)
    root = shared_path(spark, "test", "x_snd", unique=True)
    all_dates = sorted(str(r[0]) for r in stores.transaction_dates(t).collect())
    cut = all_dates[9]
    stores.build_sender_store(spark, t.where(F.to_date("txn_time_utc") <= cut), root, spec)
    assert io.stored_dates(spark, root) == all_dates[:10]
    todo = sorted(str(r[0]) for r in stores.incremental_dates(spark, t, root).collect())
    assert todo == all_dates[10:]
    first = {(r.sender_id, str(r.snapshot_date)) for r in io.scan_cumulative(spark, root).collect()}
    stores.build_sender_store(spark, t, root, spec)
    assert io.stored_dates(spark, root) == all_dates
    second = {(r.sender_id, str(r.snapshot_date)) for r in io.scan_cumulative(spark, root).collect()}
    new_senders = {s for s, d in second if d > cut}
    # every untouched key keeps its rows; touched keys hold only the new batch
    assert {(s, d) for s, d in first if s not in new_senders} <= second
    assert all(d > cut for s, d in second if s in new_senders)
    # nothing left to do; an explicit date forces a rebuild of that date only
    assert stores.build_sender_store(spark, t, root, spec) is None
    again = stores.build_sender_store(spark, t, root, spec, snapshot_date=all_dates[3])
    assert {str(r.snapshot_date) for r in again.collect()} == {all_dates[3]}


def test_scan_snapshots_prunes_and_reports_missing(spark):
    t = fixtures.transactions(spark, SF)
    spec = sender_spec(spark, SF)
    root = shared_path(spark, "test", "x_snd2", unique=True)
    stores.build_sender_store(spark, t, root, spec)
    wanted = spark.createDataFrame([("2024-01-05",), ("2023-12-31",)], "d string")
    got = io.scan_snapshots(spark, root, wanted)
    assert {str(r[0]) for r in got.select("_feature_date").distinct().collect()} == {"2024-01-05"}
    missing = [str(r[0]) for r in io.missing_snapshot_dates(spark, root, wanted).collect()]
    assert missing == ["2023-12-31"]
    assert io.scan_snapshots(spark, shared_path(spark, "test", "empty", unique=True), wanted) is None


def test_scan_by_suffix_rejects_unknown(spark):
    import pytest

    with pytest.raises(ValueError):
        io.scan_by_suffix(spark, "/tmp/whatever.json")


def test_label_map(spark):
    lm = io.scan_label_map(spark)
    rows = sorted((r.idx, r.code) for r in lm.collect())
    assert [c for _, c in rows] == ["BIL", "FOO", "TRN", "HLT", "INS", "SHP", "ENT", "EDU", "FIN", "OTH"]


def test_explicit_date_rebuild_equals_full_build(spark):
    """The pushed-down window bound must not change any vector of a rebuilt date."""
    t = fixtures.transactions(spark, SF)
    spec = sender_spec(spark, SF)
    full_root = shared_path(spark, "test", "x_full", unique=True)
    full = stores.build_sender_store(spark, t, full_root, spec)
    d = sorted(str(r[0]) for r in stores.transaction_dates(t).collect())[20]
    one_root = shared_path(spark, "test", "x_one", unique=True)
    one = stores.build_sender_store(spark, t, one_root, spec, snapshot_date=d)
    a = {(r.sender_id, tuple(round(x, 12) for x in r.snd_emb)) for r in full.where(F.col("date") == d).collect()}
    b = {(r.sender_id, tuple(round(x, 12) for x in r.snd_emb)) for r in one.collect()}
    assert a == b and len(a) > 0


def test_scan_by_suffix_csv_with_iso_z_times(spark):
    """CSV input with ISO-8601 ``...Z`` time strings reads back as the same rows."""
    t = fixtures.transactions(spark, SF)
    path = shared_path(spark, "test", "landing", unique=True) + "/txn.csv"
    t.withColumn("txn_time_utc", F.concat(F.date_format("txn_time_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))).write.option(
        "header", "true"
    ).csv(path)
    from pyspark.sql import types as T

    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "txn_time_utc" else f.dataType) for f in io.TRANSACTION_SCHEMA.fields]
    )
    back = io.scan_by_suffix(spark, path, as_text)  # the ISO strings are parsed on read
    assert back.count() == t.count()
    assert back.select("txn_id", "txn_time_utc").exceptAll(t.select("txn_id", "txn_time_utc")).count() == 0
