"""Randomised payloads: the Spark parse/type/reject path against a direct
reading of the payload grammar in plain Python."""

import random

from tickbar.operators import quotes as Q
from tickbar.schemas import QUOTE_NUMERIC_FIELDS

NAMES = QUOTE_NUMERIC_FIELDS[:6] + ["foo", "bar_baz", 'q"x', "b\\s"]
VALUES = ["", "1", "12.5", "1,234", "-3.25", "0", "7,000.5", "n/a", "x1", "1e3", "12.5f", "12d", "ABC_5", ".5", "+7.", "-"]


def expected(content):
    """(reject_reason, {field: value}) by the grammar |T|T_NAME*value*fmt|..."""
    if "|" not in content:
        return "no_pipe", None
    toks = content.split("|")
    if toks[0] != "":
        return "bad_frame", None
    ticker = toks[1]
    fields = {}
    for tok in toks[2:]:
        if "*" in tok:
            parts = tok.split("*")
            fields[parts[0].replace(ticker + "_", "").lower()] = parts[1]
    typed = {}
    for f in QUOTE_NUMERIC_FIELDS:
        v = fields.get(f)
        if v is None or v == "":
            typed[f] = None
            continue
        v = v.replace(",", "")
        try:
            typed[f] = float(v)
        except ValueError:
            return "bad_number", None
    return None, typed


def payload(rng):
    t = rng.choice(["ABC", "XY", "Q1"])
    toks = ["", t]
    for _ in range(rng.randint(0, 7)):
        kind = rng.random()
        if kind < 0.75:
            name = rng.choice(NAMES)
            pre = t + "_" if rng.random() < 0.8 else ""
            name = name.upper() if rng.random() < 0.7 else name
            tok = f"{pre}{name}*{rng.choice(VALUES)}"
            if rng.random() < 0.7:
                tok += "*" + rng.choice(["f", "n", ""])
            toks.append(tok)
        else:
            toks.append(rng.choice(["META", "", "LOT5", "x y"]))
    s = "|".join(toks)
    r = rng.random()
    if r < 0.05:
        return s.replace("|", "/")
    if r < 0.1:
        return "z" + s
    return s + ("|" if rng.random() < 0.5 else "")


def test_random_payloads(spark):
    rng = random.Random(20240101)
    contents = [payload(rng) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(contents)), "item_pos int, content string")
    good, bad = Q.quotes_from_content(df, trade_time="2024-01-01 00:00:00", keep=("item_pos",))
    got_good = {r["item_pos"]: r for r in good.collect()}
    got_bad = {r["item_pos"]: r["reject_reason"] for r in bad.collect()}
    for i, c in enumerate(contents):
        reason, typed = expected(c)
        if reason is not None:
            assert got_bad.get(i) == reason, (c, got_bad.get(i), reason)
            continue
        assert i in got_good, (c, got_bad.get(i))
        row = got_good[i]
        assert row["symbol"] == c.split("|")[1]
        for f, v in typed.items():
            assert row[f] == v, (c, f, row[f], v)


def test_random_payload_maps(spark):
    rng = random.Random(7)
    contents = [payload(rng) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(contents)), "item_pos int, content string")
    rows = Q.parsed_map(Q.parse_payload(df)).where("has_pipe AND first_empty").collect()
    got = {r["item_pos"]: r["quote_map"] for r in rows}
    for i, c in enumerate(contents):
        toks = c.split("|")
        if "|" not in c or toks[0] != "":
            assert i not in got
            continue
        want = {}
        for tok in toks[2:]:
            if "*" in tok:
                parts = tok.split("*")
                v = parts[1]
                want[parts[0].replace(toks[1] + "_", "").lower()] = None if v == "" else v.replace(",", "")
        assert got[i] == want, (c, got[i], want)
