"""Daily bars, latest snapshot, history union, upsert, TSV load (F2, F4-F7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbar.operators import bars as B
from tickbar.session import path_exists
from tickbar.sources import files as FS

QCOLS = "symbol string, trade_time string, msg_seq long, open_price double, max_price double, min_price double, " \
        "close_price double, traded_quantity double"


def _quotes(spark, rows):
    return spark.createDataFrame(rows, QCOLS).withColumn("trade_time", F.col("trade_time").cast("timestamp"))


def test_daily_bar_from_last_snapshot_and_tie(spark):
    q = _quotes(spark, [
        ("ABC", "2024-01-05 09:00:00", 1, 10.0, 10.0, 10.0, 10.0, 100.0),
        ("ABC", "2024-01-05 14:00:00", 2, 10.0, 12.0, 9.0, 11.0, 300.0),
        ("ABC", "2024-01-05 14:00:00", 3, 10.0, 12.5, 9.0, 11.5, 350.0),  # tie on time: higher seq wins
        ("XYZ", "2024-01-06 10:00:00", 4, 5.0, 5.0, 5.0, 5.0, 1.0),
    ])
    syms = spark.createDataFrame([("ABC", "abc"), ("XYZ", "xyz"), ("NOD", "nod")], "symbol string, tb string")
    bars = {(r["symbol"], r["trade_date"]): r for r in B.daily_bars(q, syms).collect()}
    b = bars[("ABC", dt.date(2024, 1, 5))]
    assert (b["open"], b["high"], b["low"], b["close"], b["volume"]) == (10.0, 12.5, 9.0, 11.5, 350)
    assert len(bars) == 2
    one_day = B.daily_bars(q, syms, as_of="2024-01-06").collect()
    assert [r["symbol"] for r in one_day] == ["XYZ"]
    assert [r["symbol"] for r in B.symbols_missing(syms, q).collect()] == ["NOD"]


def test_latest_quote(spark):
    q = _quotes(spark, [("ABC", "2024-01-05 09:00:00", 1, 1.0, 1.0, 1.0, 1.0, 1.0),
                        ("ABC", "2024-01-05 10:00:00", 2, 1.0, 2.0, 1.0, 2.0, 2.0)])
    r = B.latest_quote(q).collect()
    assert len(r) == 1 and r[0]["msg_seq"] == 2 and r[0]["close_price"] == 2.0


def test_history_union_prefers_daily(spark):
    h = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 10),
                               ("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10)],
                              "symbol string, trade_date date, open double, high double, low double, close double, volume long")
    d = spark.createDataFrame([("A", dt.date(2024, 1, 2), 9.0, 9.0, 9.0, 9.0, None)], h.schema)
    out = {r["trade_date"]: r for r in B.history_union(h, d).collect()}
    assert len(out) == 2 and out[dt.date(2024, 1, 2)]["open"] == 9.0
    assert out[dt.date(2024, 1, 2)]["volume"] == 10  # a null of the daily source doesn't hide a known volume


def test_upsert_is_idempotent(spark, tmp_dir):
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 10)],
                                 "symbol string, trade_date date, open double, high double, low double, close double, volume long")
    path = f"{tmp_dir}/bars"
    B.write_bars(bars, path)
    B.write_bars(bars, path)
    assert B.read_bars(spark, path).count() == 1


def test_upsert_keeps_other_symbols_and_newer_snapshots(spark, tmp_dir):
    schema = "symbol string, trade_date date, open double, high double, low double, close double, volume long, seq long"
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    row = lambda s, d, close, seq: (s, d, 1.0, 2.0, 0.5, close, 10, seq)
    path = f"{tmp_dir}/bars"
    B.write_bars(spark.createDataFrame([row("A", day, 1.0, 1), row("B", day, 2.0, 1), row("A", other, 3.0, 1)], schema), path)
    B.write_bars(spark.createDataFrame([row("A", day, 9.0, 2), row("C", day, 4.0, 2)], schema), path)
    got = {(r["symbol"], r["trade_date"]): r["close"] for r in B.read_bars(spark, path).collect()}
    assert got == {("A", day): 9.0, ("B", day): 2.0, ("C", day): 4.0, ("A", other): 3.0}
    path = f"{tmp_dir}/ordered"
    for part in ([row("A", day, 5.0, 7), row("B", day, 1.0, 1)], [row("A", day, 4.0, 3), row("B", day, 2.0, 2)]):
        B.write_bars(spark.createDataFrame(part, schema), path, order=("seq",))
    assert {r["symbol"]: r["close"] for r in B.read_bars(spark, path).collect()} == {"A": 5.0, "B": 2.0}


def test_upsert_keeps_rows_without_a_date(spark, tmp_dir):
    schema = "symbol string, trade_date date, open double, high double, low double, close double, volume long, seq long"
    day = dt.date(2024, 1, 1)
    row = lambda s, d, close, seq=1: (s, d, 1.0, 2.0, 0.5, close, 10, seq)
    for order in ((), ("seq",)):
        path = f"{tmp_dir}/nulls{len(order)}"
        for part in ([row("N1", None, 1.0), row("A", day, 1.0)], [row("N2", None, 2.0), row(None, day, 3.0)],
                     [row("N1", None, 4.0, 2), row(None, day, 5.0, 2)]):
            B.write_bars(spark.createDataFrame(part, schema), path, order=order)
        got = {(r["symbol"], r["trade_date"]): r["close"] for r in B.read_bars(spark, path).collect()}
        assert got == {("N1", None): 4.0, ("N2", None): 2.0, ("A", day): 1.0, (None, day): 5.0}


def test_upsert_reads_only_touched_dates_and_leaves_nothing_behind(spark, tmp_dir, monkeypatch):
    schema = "symbol string, trade_date date, open double, high double, low double, close double, volume long"
    day = lambda i: dt.date(2024, 1, i)
    path = f"{tmp_dir}/bars"
    B.write_bars(spark.createDataFrame([("A", day(i), 1.0, 2.0, 0.5, float(i), 10) for i in range(1, 10)], schema), path)
    before = B.bar_table(spark, path).manifest()
    seen, read, landed = [], B.SnapshotTable.read_dates, []
    monkeypatch.setattr(B.SnapshotTable, "read_dates", lambda self, *a: seen.append(read(self, *a)) or seen[-1])
    scratch = B.scratch_path
    monkeypatch.setattr(B, "scratch_path", lambda *a: landed.append(scratch(*a)) or landed[-1])
    B.write_bars(spark.createDataFrame([("B", day(3), 1.0, 2.0, 0.5, 7.0, 10)], schema), path)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    after = B.bar_table(spark, path).manifest()
    assert [p for p in after.folders if after.folders[p] != before.folders.get(p)] == ["trade_date=2024-01-03"]
    assert not any(path_exists(spark, p) for p in landed)

    def killed(self, rows):
        write(self, rows)
        raise KeyboardInterrupt
    write = B.SnapshotTable.write
    monkeypatch.setattr(B.SnapshotTable, "write", killed)
    with pytest.raises(KeyboardInterrupt):
        B.write_bars(spark.createDataFrame([("C", day(4), 1.0, 2.0, 0.5, 7.0, 10)], schema), path)
    assert B.bar_table(spark, path).manifest() == after and not any(path_exists(spark, p) for p in landed)
    assert B.read_bars(spark, path, [day(3)]).count() == 2 and B.read_bars(spark, path).count() == 10


def test_upsert_starts_anew_after_another_writer(spark, tmp_dir, monkeypatch):
    schema = "symbol string, trade_date date, open double, high double, low double, close double, volume long"
    row = lambda s: spark.createDataFrame([(s, dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.0, 10)], schema)
    path, write = f"{tmp_dir}/bars", B.SnapshotTable.write

    def interrupted(self, rows):
        monkeypatch.setattr(B.SnapshotTable, "write", write)
        B.write_bars(row("OTHER"), path)
        return write(self, rows)
    monkeypatch.setattr(B.SnapshotTable, "write", interrupted)
    B.write_bars(row("OWN"), path)
    assert sorted(r["symbol"] for r in B.read_bars(spark, path).collect()) == ["OTHER", "OWN"]


def test_layout_aliases_and_exact_volume(spark):
    d = spark.createDataFrame([(0, dt.date(2024, 1, 1), 1.0, 2.0, 3.0, 0.5, "9007199254740993", "ABC")],
                              "index long, Date date, Open double, Close double, Max double, Min double, Vol string, ticker string")
    out = B.normalise_daily(d, "ticker")
    assert out.columns[0] == "symbol" and out.collect()[0]["volume"] == 9007199254740993


def test_tsv_layouts(spark, tmp_dir):
    p = f"{tmp_dir}/dht.tsv"
    with open(p, "w") as f:
        f.write("0\t22.9\t23\t22.6\t23\t49500\t2023-11-24 00:00:00\n1\t23\t23.7\t22.7\t22.9\t\\N\t2023-11-23 00:00:00\n")
    h = B.normalise_history(FS.read_history_tsv(spark, p, by_symbol_dir=False), F.lit("DHT")).orderBy("trade_date").collect()
    assert h[1]["trade_date"] == dt.date(2023, 11, 24) and h[1]["high"] == 23.0 and h[0]["volume"] is None
    p2 = f"{tmp_dir}/daily.tsv"
    with open(p2, "w") as f:
        f.write("0\t2023-11-24\t80.69\t333.46\t372.83\t372.83\t\\N\n")
    d = B.normalise_daily(FS.read_daily_tsv(spark, p2, by_symbol_dir=False), F.lit("DHT")).collect()[0]
    assert (d["open"], d["close"], d["high"], d["low"], d["volume"]) == (80.69, 333.46, 372.83, 372.83, None)


def test_symbols_pk(spark, tmp_dir):
    s = spark.createDataFrame([("DHT", "dht"), ("HAT", "hat"), ("DHT", "dht2")], "symbol string, tb string")
    FS.write_symbols_csv(s, f"{tmp_dir}/sym")
    loaded = FS.read_symbols_csv(spark, f"{tmp_dir}/sym")
    assert [(r["symbol"], r["n_rows"]) for r in FS.symbols_pk_audit(loaded).collect()] == [("DHT", 2)]
    assert sorted(tuple(r) for r in FS.dedup_symbols(loaded).collect()) == [("DHT", "dht"), ("HAT", "hat")]


def test_partition_scan_single_digit_month(spark, tmp_dir):
    from tickbar.operators.framing import partition_columns

    q = _quotes(spark, [("ABC", "2024-01-05 09:00:00", 1, 1.0, 1.0, 1.0, 1.0, 1.0),
                        ("ABC", "2024-11-05 09:00:00", 2, 1.0, 1.0, 1.0, 1.0, 1.0)])
    partition_columns(q).write.partitionBy("year", "month", "day").parquet(f"{tmp_dir}/q")
    schema = T.StructType([*q.schema.fields, *[T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]])
    t = B.for_day(FS.read_partitioned_quotes(spark, f"{tmp_dir}/q", schema), "2024-01-05")
    assert [r["msg_seq"] for r in t.collect()] == [1]
    plan = t._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(c in filters for c in ("year", "month", "day"))
    assert "trade_time" in plan.split("PushedFilters: [")[1].split("]")[0]
