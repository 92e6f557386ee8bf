"""A dump with several sections, cut into splits anywhere."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickbar.operators import bars as B
from tickbar.schemas import DAILY_TSV_SCHEMA, HISTORY_TSV_SCHEMA, SYMBOL_SCHEMA
from tickbar.sources import dump as D

HISTORY = 'COPY public.{} (index, "Open", "Max", "Min", "Close", "Vol", "Date") FROM stdin;'
DAILY = 'COPY public.{} (index, "Date", "Open", "Close", "Max", "Min", "Vol") FROM stdin;'


def five_sections(n=3000):
    day = dt.date(2010, 1, 4)
    out = ["-- a dump", "SET x = 1;", "", "\\connect historical", "CREATE TABLE public.dht (index bigint);", HISTORY.format("dht")]
    out += [f"{i}\t{i}.5\t9\t1\t{i}\t{i * 10}\t{day + dt.timedelta(i)} 00:00:00" for i in range(n)]
    out += ["\\.", "", "", HISTORY.format("hat"), "0\t1\t2\t0.5\t1.5\t\\N\t2020-02-02 00:00:00", "\\.", "-- no row: 1\t2\t3"]
    out += ["COPY public.symbols (symbol, tb) FROM stdin;", "DHT\tdht", "HAT\that", "\\.", "\\connect stock", DAILY.format('"hat"')]
    out += ["0\t2023-11-24\t56.62\t38.32\t59.25\t59.25\t\\N", "0\t2023-11-25\t1\t2\t3\t0.5\t9007199254740993", "\\."]
    out += ['COPY odd."a ""b"" c" ("x y", "z") FROM stdin;', "COPY public.fake (a) FROM stdin;\tq\\tr\\\\n\\ns", "\\\\.\t\\N", "\t\\\\N",
            "\\.", "COPY public.empty (a) FROM stdin;", "\\.", "END;"]
    return out


@pytest.fixture(params=[128 << 20, 4096, 64], ids=["one split", "some splits", "a split in every line or two"])
def dump(request, spark, tmp_dir):
    n = 3000 if request.param > 64 else 40
    path = f"{tmp_dir}/dump.sql"
    with open(path, "w") as f:
        f.write("\n".join(five_sections(n)) + "\n")
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield n, D.read_dump(spark, path)
    for k, v in was.items():
        spark.conf.set(k, v)


def test_five_tables(dump):
    n, rows = dump
    sizes = {(r["database"], r["schema_name"], r["table_name"]): r["count"] for r in rows.groupBy("database", "schema_name", "table_name").count().collect()}
    assert sizes == {("historical", "public", "dht"): n, ("historical", "public", "hat"): 1, ("historical", "public", "symbols"): 2,
                     ("stock", "public", "hat"): 2, ("stock", "odd", 'a "b" c'): 3}
    history = B.normalise_history(D.typed(rows.where("database = 'historical' AND table_name <> 'symbols'"), HISTORY_TSV_SCHEMA), "table_name")
    got = history.where("symbol = 'dht'").agg(F.count("*"), F.sum("open"), F.sum("volume"), F.min("trade_date"), F.countDistinct("trade_date")).collect()[0]
    assert tuple(got) == (n, sum(range(n)) + n / 2, 10 * sum(range(n)), dt.date(2010, 1, 4), n)
    assert history.where("symbol = 'hat'").collect()[0]["volume"] is None
    symbols = D.typed(rows.where("table_name = 'symbols'"), SYMBOL_SCHEMA, keep=())
    assert sorted(map(tuple, symbols.collect())) == [("DHT", "dht"), ("HAT", "hat")]
    daily = B.normalise_daily(D.typed(rows.where("database = 'stock' AND table_name = 'hat'"), DAILY_TSV_SCHEMA), "table_name").orderBy("trade_date").collect()
    assert [(r["open"], r["close"], r["high"], r["low"], r["volume"]) for r in daily] == [
        (56.62, 38.32, 59.25, 59.25, None), (1.0, 2.0, 3.0, 0.5, 9007199254740993)]
    odd = rows.where("schema_name = 'odd'").collect()
    assert {tuple(r["columns"]) for r in odd} == {("x y", "z")}
    assert sorted((tuple(r["fields"]) for r in odd), key=str) == sorted(
        [("COPY public.fake (a) FROM stdin;", "q\tr\\n\ns"), ("\\.", None), ("", "\\N")], key=str)


def test_dumps_without_rows(spark, tmp_dir):
    with open(f"{tmp_dir}/a.sql", "w") as f:
        f.write("-- nothing\n\n")
    assert D.read_dump(spark, f"{tmp_dir}/a.sql").count() == 0
    with open(f"{tmp_dir}/b.sql", "w") as f:
        f.write("COPY t (a, b) FROM stdin;\n1\t2\n3")  # not ended
    rows = D.read_dump(spark, f"{tmp_dir}/b.sql").collect()
    assert [(r["database"], r["schema_name"], r["table_name"], r["fields"]) for r in rows] == [(None, None, "t", ["1", "2"]), (None, None, "t", ["3"])]
    short = D.typed(D.read_dump(spark, f"{tmp_dir}/b.sql"), SYMBOL_SCHEMA, keep=()).collect()
    assert [tuple(r) for r in short] == [(None, None), (None, None)]
