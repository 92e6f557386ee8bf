"""Feed responses -> parsed payloads -> typed, stamped quote snapshots.

Payload grammar: ``|NAME|NAME_<COL>*<value>*<format>|...``.  Tokens with a
``*`` are fields (the ``NAME_`` is removed from the field name only and
the rest lower-cased; the last duplicate wins); tokens without are metadata.
Values: empty -> NULL, thousands commas removed, then a double.  Rows that do
not parse go to a reject table with a reason instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EXCHANGE_CODES, EXCHANGE_NAME, KEY_AREAS, QUOTE_NUMERIC_FIELDS
from .running import col_or_lit

RESPONSE_SCHEMA = T.StructType([T.StructField("obj", T.ArrayType(T.StringType()))])


def feed_requests() -> list[tuple[int, str, str]]:
    """(request_seq, exchange_code, key_area): every code x every area, in poll order."""
    return [(i + 1, c, a) for i, (c, a) in enumerate((c, a) for c in EXCHANGE_CODES for a in KEY_AREAS)]


def feed_request_grid(spark) -> DataFrame:
    """The 16-row request grid as a generator over a literal array (bounded, no join)."""
    arr = F.array(*[F.struct(F.lit(s).alias("request_seq"), F.lit(c).alias("exchange_code"),
                             F.lit(a).alias("key_area")) for s, c, a in feed_requests()])
    return spark.range(1).select(F.inline(arr))


def feed_explode(raw: DataFrame, keep: tuple[str, ...] = ("response_id",)) -> DataFrame:
    """One row per string of ``obj`` for responses with status 200; null or empty ``obj`` gives none."""
    parsed = raw.where(F.col("status") == 200).withColumn("_obj", F.from_json("body", RESPONSE_SCHEMA).getField("obj"))
    return parsed.select(*keep, F.posexplode("_obj").alias("item_pos", "content"))


def _tokens(content: Column) -> Column:
    return F.split(content, r"\|", -1)


def parse_payload(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Add ``ticker``, ``has_pipe``, ``first_empty``, ``fields`` (array<struct<k,v>>
    in token order) and ``metadata``.  Unused columns are pruned by the optimizer,
    so callers that only need the frame checks never evaluate the arrays."""
    c = F.col(content_col)
    toks = _tokens(c)
    body = F.slice(toks, 3, F.greatest(F.size(toks) - 2, F.lit(0)))
    out = df.withColumns({
        "ticker": F.get(toks, 1),
        "has_pipe": F.coalesce(F.instr(c, "|") > 0, F.lit(False)),
        "first_empty": F.substring_index(c, "|", 1) == "",
    })
    entries = F.transform(
        F.filter(body, lambda x: F.instr(x, "*") > 0),
        lambda x: F.struct(
            F.lower(F.replace(F.get(F.split(x, r"\*", -1), 0), F.concat(F.col("ticker"), F.lit("_")), F.lit(""))).alias("k"),
            F.get(F.split(x, r"\*", -1), 1).alias("v"),
        ),
    )
    return out.withColumns({"fields": entries, "metadata": F.filter(body, lambda x: F.instr(x, "*") == 0)})


def last_wins(entries: Column) -> Column:
    """Keep the last occurrence of each key, in first-seen order of the kept entries."""
    rev = F.reverse(entries)
    keys = F.transform(rev, lambda e: e.getField("k"))
    kept = F.filter(rev, lambda e, i: F.array_position(keys, e.getField("k")) == i + 1)
    return F.reverse(kept)


def field_value(entries: Column, name: str) -> Column:
    """Raw text of the last token named ``name`` (NULL if absent)."""
    return F.try_element_at(F.filter(entries, lambda e: e.getField("k") == name), F.lit(-1)).getField("v")


def clean_number(text: Column) -> Column:
    """'' -> NULL, strip thousands commas."""
    return F.replace(F.nullif(text, F.lit("")), F.lit(","), F.lit(""))


def parsed_entries(fields: Column) -> Column:
    """array<struct<k, v>>: one entry per field name (last duplicate wins), cleaned values."""
    return F.transform(last_wins(fields),
                       lambda e: F.struct(e.getField("k").alias("k"), clean_number(e.getField("v")).alias("v")))


def parsed_map(df: DataFrame) -> DataFrame:
    """The symbol's field map (last duplicate wins) with cleaned values."""
    return df.withColumn("quote_map", F.map_from_entries(parsed_entries(F.col("fields"))))


# What counts as a number; a Java cast alone would also take type suffixes (12.5f, 12d).
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def typed_quotes(parsed: DataFrame) -> DataFrame:
    """Project to the quote model: known numeric fields typed, unknown keys ignored.

    The entries of ``parse_payload``, last one first, as an array of names and one of texts; a model field is
    the text at its name's first place there (so the last duplicate wins).  Texts are then cleaned, checked and
    cast.  One that isn't a number or an empty symbol rejects the payload.  The model's fields are handled
    as an array: 27 times the same expressions side by side would be a method too long for the JIT compiler.
    """
    last_first = F.reverse("fields")
    rec = parsed.withColumns({"_names": last_first.getField("k"), "_texts": last_first.getField("v")})
    model = F.array(*[F.lit(f) for f in QUOTE_NUMERIC_FIELDS])
    rec = rec.withColumn("_clean", F.transform(
        model, lambda f: clean_number(F.get("_texts", F.array_position("_names", f).cast("int") - 1))))
    rec = rec.withColumn("_numbers", F.transform("_clean", lambda t: F.when(t.rlike(_NUMBER), t.try_cast("double"))))
    bad = F.size(F.array_compact("_numbers")) < F.size(F.array_compact("_clean"))
    reason = (
        F.when(F.col("content").isNull(), F.lit("null_content"))
        .when(~F.col("has_pipe"), F.lit("no_pipe"))
        .when(~F.col("first_empty"), F.lit("bad_frame"))
        .when(F.coalesce(F.col("ticker"), F.lit("")) == "", F.lit("missing_symbol"))
        .when(bad, F.lit("bad_number"))
    )
    typed = rec.withColumns({f: F.get("_numbers", F.lit(i)) for i, f in enumerate(QUOTE_NUMERIC_FIELDS)})
    return typed.withColumn("reject_reason", reason).drop("_names", "_texts", "_clean", "_numbers")


def stamp(df: DataFrame, trade_time=None, exchange_name: str = EXCHANGE_NAME) -> DataFrame:
    """Constant exchange name and one shared fetch time; these override parsed keys."""
    ts = F.current_timestamp() if trade_time is None else col_or_lit(trade_time).cast("timestamp")
    return df.withColumns({"exchange_name": F.lit(exchange_name), "trade_time": ts})


def quotes_from_content(items: DataFrame, trade_time=None, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid quotes in the model's column order, rejects with a reason)."""
    typed = stamp(typed_quotes(parse_payload(items)), trade_time)
    cols = [*keep, F.col("ticker").alias("symbol"), "exchange_name", "trade_time", *QUOTE_NUMERIC_FIELDS,
            "content", "reject_reason"]
    # The record leaves a one-row generator, so the split filters below cannot be
    # pushed under it (that would inline the payload decode once per field).
    rec = typed.select(F.inline(F.array(F.struct(*cols))))
    good = rec.where(F.col("reject_reason").isNull()).select(
        *keep, "symbol", "exchange_name", "trade_time", *QUOTE_NUMERIC_FIELDS)
    bad = rec.where(F.col("reject_reason").isNotNull()).select(*keep, "content", "reject_reason")
    return good, bad


__all__ = ["feed_requests", "feed_request_grid", "feed_explode", "parse_payload", "parsed_map",
           "typed_quotes", "stamp", "quotes_from_content", "parsed_entries"]
