"""Schema-registry framing of quote messages and decoding by schema id.

Wire format of a message value: one magic byte (0), the writer schema id as a
4-byte big-endian integer, then the encoded body.  Bodies are Avro when the
``spark-avro`` package is on the classpath (``codec="avro"``) and JSON
otherwise; everything around the body is native Catalyst expressions.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "mode": "PERMISSIVE"}
HEADER_BYTES = 5
_CORRUPT = "_corrupt"
FRAME_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])


def _avro():
    from pyspark.sql.avro import functions as avro  # needs the spark-avro package at runtime

    return avro


_AVRO_KINDS = {T.StringType: "string", T.DoubleType: "double", T.LongType: "long", T.IntegerType: "int"}
_TIMESTAMP = {"type": "long", "logicalType": "timestamp-micros"}


def avro_schema_json(schema: T.StructType, name: str = "Quote") -> str:
    """Avro text of a writer schema: required fields are plain, optional ones a union with null.
    (Avro bodies carry no tags: a union has a branch byte on the wire, a plain field has none.)"""
    fields = []
    for f in schema.fields:
        kind = _TIMESTAMP if isinstance(f.dataType, T.TimestampType) else _AVRO_KINDS[type(f.dataType)]
        fields.append({"name": f.name, "type": ["null", kind], "default": None} if f.nullable
                      else {"name": f.name, "type": kind})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def struct_from_avro(text: str) -> T.StructType:
    """The struct of an Avro record schema's text (the kinds that quote messages use)."""
    by_kind = {v: k() for k, v in _AVRO_KINDS.items()} | {"boolean": T.BooleanType(), "float": T.FloatType(),
                                                          "bytes": T.BinaryType()}
    fields = []
    for f in json.loads(text)["fields"]:
        kind, nullable = f["type"], False
        if isinstance(kind, list):
            nullable = "null" in kind
            kind = next(k for k in kind if k != "null")
        if isinstance(kind, dict):
            stamp = kind.get("logicalType", "").startswith("timestamp")
            dtype = T.TimestampType() if stamp else by_kind[kind["type"]]
        else:
            dtype = by_kind[kind]
        fields.append(T.StructField(f["name"], dtype, nullable))
    return T.StructType(fields)


def as_struct(schema: T.StructType | str) -> T.StructType:
    """A catalogue entry as a struct; a registry's schema text may stand for it."""
    return struct_from_avro(schema) if isinstance(schema, str) else schema


def as_avro(schema: T.StructType | str) -> str:
    return schema if isinstance(schema, str) else avro_schema_json(schema)


def encode_body(schema: T.StructType | str, present: set[str], codec: str = "json") -> Column:
    """Encode the writer schema's fields; a field the frame lacks is written as NULL."""
    text, schema = schema, as_struct(schema)
    rec = F.struct(*[(F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
                     for f in schema.fields])
    if codec == "avro":
        return _avro().to_avro(rec, as_avro(text))
    return F.encode(F.to_json(rec, JSON_OPTIONS), "UTF-8")


def frame_value(schema_id: Column, body: Column) -> Column:
    """magic byte 0 + big-endian 4-byte id + body."""
    id_bytes = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0"))
    return F.concat(F.unhex(F.lit("00")), id_bytes, body)


def frame_quotes(df: DataFrame, schemas: dict[int, T.StructType], schema_id_col: str = "schema_id",
                 key: Column | None = None, codec: str = "json", keep: list[str] | None = None) -> DataFrame:
    """Frame each row with the writer schema named by ``schema_id_col``.

    ``key`` defaults to a random UUID as the producer does; pass a column for a
    deterministic key.
    """
    sid = F.col(schema_id_col)
    body = None
    for k, schema in sorted(schemas.items()):
        enc = encode_body(schema, set(df.columns), codec)
        body = F.when(sid == k, enc) if body is None else body.when(sid == k, enc)
    key = key if key is not None else F.expr("uuid()")
    return df.select(*(keep or []), key.cast("string").alias("key"), frame_value(sid, body).alias("value"))


def unframe(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Split the wire value into magic byte, schema id and body (no UDF)."""
    v = F.col(value_col)
    return df.withColumns({
        "magic": F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int"),
        "schema_id": F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint").cast("int"),
        "payload": F.expr(f"substring({value_col}, 6, greatest(length({value_col}) - 5, 0))"),
    })


def distinct_schema_ids(frames: DataFrame) -> DataFrame:
    return frames.groupBy("schema_id").agg(F.count(F.lit(1)).alias("n_messages"))


def decode_by_schema(frames: DataFrame, schemas: dict[int, T.StructType | str], codec: str = "json",
                     keep: tuple[str, ...] = ("key", "schema_id"), unknown: str = "reject") -> DataFrame:
    """Decode each message with its own writer schema, in one pass over the frames.

    ``frames`` has ``value`` (the whole frame); the result has the kept columns, the union of
    all schemas' fields, ``value`` and ``reason``, which is NULL for a good message:

    * ``short_frame``: no value, or fewer than the five header bytes;
    * ``bad_magic``: the first byte isn't 0;
    * ``unknown_schema``: an id that the catalogue lacks (``unknown="raise"`` fails the job, as a
      failed registry lookup does);
    * ``bad_body``: the body doesn't decode, or a field has the wrong type;
    * ``missing_field``: a required field of the writer schema is null, or the symbol is empty.

    A field is kept only for the ids whose schema declares it.  The catalogue is the whole
    id set, so nothing is collected to build the plan.
    """
    structs = {i: as_struct(s) for i, s in sorted(schemas.items())}
    types: dict[str, T.DataType] = {}
    owners: dict[str, list[int]] = {}
    required: dict[str, list[int]] = {}
    for i, struct in structs.items():
        for f in struct.fields:
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise TypeError(f"field {f.name!r} has conflicting types across writer schemas")
            owners.setdefault(f.name, []).append(i)
            if not f.nullable:
                required.setdefault(f.name, []).append(i)
    u = unframe(frames)
    sid = F.col("schema_id")
    known = sid.isin(list(structs)) & (F.length("value") >= HEADER_BYTES) & (F.col("magic") == 0)
    if codec == "avro":
        options = {"datetimeRebaseMode": "CORRECTED", "mode": "PERMISSIVE"}
        u = u.withColumns({f"_r{i}": _avro().from_avro(F.when(known & (sid == i), F.col("payload")), as_avro(schemas[i]), options)
                           for i in structs})
        value = {n: F.coalesce(*[F.col(f"_r{i}.{n}") for i in ids]) for n, ids in owners.items()}
        decoded = reduce(lambda a, b: a | b, [F.col(f"_r{i}").isNotNull() for i in structs])
    else:
        union = T.StructType([T.StructField(n, t) for n, t in types.items()] + [T.StructField(_CORRUPT, T.StringType())])
        options = {**JSON_OPTIONS, "columnNameOfCorruptRecord": _CORRUPT}
        # a cast, not decode(): bytes that aren't UTF-8 must not stop the job
        u = u.withColumn("_r", F.from_json(F.when(known, F.col("payload").cast("string")), union, options))
        value = {n: F.when(sid.isin(ids), F.col(f"_r.{n}")) for n, ids in owners.items()}
        decoded = F.col("_r").isNotNull() & F.col(f"_r.{_CORRUPT}").isNull()
    missing = [sid.isin(ids) & value[n].isNull() for n, ids in required.items()]
    if "symbol" in value:
        missing.append(value["symbol"] == "")
    lacks = reduce(lambda a, b: a | b, missing) if missing else F.lit(False)
    stranger = F.lit("unknown_schema")
    if unknown == "raise":
        stranger = F.raise_error(F.concat(F.lit("no writer schema registered for id "), sid.cast("string"))).cast("string")
    reason = (F.when(F.col("value").isNull() | (F.length("value") < HEADER_BYTES), F.lit("short_frame"))
              .when(F.col("magic") != 0, F.lit("bad_magic"))
              .when(~sid.isin(list(structs)), stranger)
              .when(~decoded, F.lit("bad_body"))
              .when(F.coalesce(lacks, F.lit(False)), F.lit("missing_field")))
    # the record leaves a one-row generator, so that filters on the reason are not pushed
    # below it (that would repeat the decode in each)
    record = F.struct(*keep, *[value[n].alias(n) for n in types], F.col("value"), reason.alias("reason"))
    return u.select(F.inline(F.array(record)))


def partition_columns(df: DataFrame, ts_col: str = "trade_time") -> DataFrame:
    """year / month / day as zero-padded strings in the session time zone."""
    ts = F.col(ts_col)
    return df.withColumns({
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    })
