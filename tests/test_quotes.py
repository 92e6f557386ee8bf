"""Payload parsing edge cases (FIXTURES F1)."""

import json

from pyspark.sql import functions as F

from tickbar.operators import quotes as Q


def _typed(spark, contents):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "item_pos int, content string")
    good, bad = Q.quotes_from_content(df, trade_time="2024-01-02 10:00:00", keep=("item_pos",))
    return ({r["item_pos"]: r for r in good.collect()}, {r["item_pos"]: r["reject_reason"] for r in bad.collect()})


def test_normal_comma_empty_duplicate(spark):
    good, bad = _typed(spark, [
        "|ABC|ABC_LAST_PRICE*12.5*f|",
        "|ABC|ABC_TRADED_QUANTITY*1,234*n|",
        "|ABC|ABC_OPEN_PRICE**f|",
        "|ABC|ABC_LAST_PRICE*1*f|ABC_LAST_PRICE*2*f|",
    ])
    assert not bad
    assert good[0]["symbol"] == "ABC" and good[0]["last_price"] == 12.5
    assert good[1]["traded_quantity"] == 1234.0
    assert good[2]["open_price"] is None
    assert good[3]["last_price"] == 2.0  # last duplicate wins
    assert good[0]["exchange_name"] == "HNX"
    assert str(good[0]["trade_time"]) == "2024-01-02 10:00:00"


def test_rejects(spark):
    good, bad = _typed(spark, ["nothing", "x|ABC|ABC_LAST_PRICE*1*f", "|ABC|ABC_LAST_PRICE*n/a*f|", None,
                               "||ABC_LAST_PRICE*1*f|", "|", "|ABC|ABC_LAST_PRICE*12.5f*f|", "|ABC|ABC_LAST_PRICE*12d*f|",
                               "|ABC|ABC_LAST_PRICE*ABC_5*f|"])
    assert not good
    assert bad == {0: "no_pipe", 1: "bad_frame", 2: "bad_number", 3: "null_content", 4: "missing_symbol",
                   5: "missing_symbol", 6: "bad_number", 7: "bad_number", 8: "bad_number"}


def test_metadata_and_trailing_pipe(spark):
    df = spark.createDataFrame([("|ABC|META|ABC_LAST_PRICE*1*f|",)], "content string")
    row = Q.parse_payload(df).collect()[0]
    assert row["metadata"] == ["META", ""]
    assert [(e["k"], e["v"]) for e in row["fields"]] == [("last_price", "1")]


def test_unknown_field_ignored_and_map_last_wins(spark):
    df = spark.createDataFrame([("|ABC|ABC_FOO*3*f|ABC_LAST_PRICE*1*f|ABC_LAST_PRICE*2,000*f|",)], "content string")
    m = Q.parsed_map(Q.parse_payload(df)).collect()[0]["quote_map"]
    assert m == {"foo": "3", "last_price": "2000"}
    good, bad = Q.quotes_from_content(df)
    assert good.collect()[0]["last_price"] == 2000.0 and bad.count() == 0


def test_feed_explode_status_and_empty_obj(spark):
    rows = [(1, 200, json.dumps({"obj": ["|A|A_LAST_PRICE*1*f|", "|B|B_LAST_PRICE*2*f|"]})),
            (2, 200, json.dumps({"obj": None})), (3, 200, json.dumps({"obj": []})),
            (4, 500, json.dumps({"obj": ["|C|C_LAST_PRICE*3*f|"]}))]
    raw = spark.createDataFrame(rows, "response_id long, status int, body string")
    out = sorted((r["response_id"], r["item_pos"]) for r in Q.feed_explode(raw).collect())
    assert out == [(1, 0), (1, 1)]


def test_request_grid(spark):
    g = Q.feed_request_grid(spark).orderBy("request_seq").collect()
    assert len(g) == 16 and (g[0]["exchange_code"], g[0]["key_area"]) == ("LIS", "ABC")
    assert (g[-1]["exchange_code"], g[-1]["key_area"]) == ("UPC", "WXYZ")
    assert spark.range(1).select(F.lit(1)).count() == 1
