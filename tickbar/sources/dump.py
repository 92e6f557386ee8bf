"""A database dump as it is: SQL text with the rows of many tables between ``COPY ... FROM stdin;`` and ``\\.``.

A dump is one long file, so Spark reads it in splits, and a line doesn't say whose row it is: that is settled by
the lines before it, perhaps in other splits.  The lines are first written with their place (file,
split, order inside the split); then the end marks before a line are counted, inside its split by a running sum and
over the splits by the sums of whole splits.  Between two end marks the first header opens the section, and the
lines after it are rows (a row may look like a header).  ``\\connect`` lines, counted in the same way, give the database.
Nothing is collected, and no task holds more than a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# The dump's own words, and the escapes of its text format.
END = "\\."
HEADER = r"^COPY\s+(\S.*?)\s*\((.*)\)\s+FROM\s+stdin;\s*$"
CONNECT = r"^\\connect\s+(?:-\S+\s+)*(\S+)"
NULL = "\\N"
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_NAME = r'"((?:[^"]|"")*)"|([^\s,."]+)'


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, file, split, at: written once, so that a line's place is the same in every later step."""
    placed = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    out = scratch_path(spark, "dump_lines")
    placed.write.parquet(out)
    return spark.read.schema(placed.schema).parquet(out)


def _names(col: Column) -> Column:
    """The identifiers of a list or a dotted name; quotes taken off."""
    parts = F.regexp_extract_all(col, F.lit(_NAME), F.lit(0))
    return F.transform(parts, lambda p: F.when(p.startswith('"'), F.replace(p.substr(F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"')))
                       .otherwise(p))


def _value(text: Column) -> Column:
    """A field of a row: null mark, escapes."""
    def plain(piece: Column) -> Column:
        for letter, char in ESCAPES.items():
            piece = F.replace(piece, F.lit("\\" + letter), F.lit(char))
        return F.replace(piece, F.lit("\\"), F.lit(""))
    pieces = F.transform(F.split(text, r"\\\\", -1), plain)  # between escaped backslashes
    return F.when(text == NULL, None).when(text.contains("\\"), F.array_join(pieces, "\\")).otherwise(text)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all sections: database, schema_name, table_name, columns (array) and fields (array, null for the mark).

    ``database`` is that of the last ``\\connect`` line, null before the first.  A section that its file doesn't end
    goes on to the end of the file.  Lines outside sections give no rows.
    """
    lines = _placed_lines(spark, path)
    ends, connects = F.when(F.col("line") == END, 1).otherwise(0), F.when(F.col("line").rlike(CONNECT), 1).otherwise(0)
    per_split = lines.groupBy(F.col("file").alias("in_file"), F.col("split").alias("in_split")).agg(
        F.sum(ends).alias("e"), F.sum(connects).alias("c"))
    earlier = Window.partitionBy("in_file").orderBy("in_split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    carried = per_split.select("in_file", "in_split", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}0") for x in "ec"])
    inside = Window.partitionBy("file", "split").orderBy("at")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    known = lines.select("*", F.coalesce(F.sum(ends).over(before), F.lit(0)).alias("e"), F.sum(connects).over(inside).alias("c"))
    known = known.join(carried, (F.col("file") == F.col("in_file")) & (F.col("split") == F.col("in_split")))
    known = known.select("line", "file", F.struct("split", "at").alias("place"), (F.col("e") + F.col("e0")).alias("section"),
                         (F.col("c") + F.col("c0")).alias("connection"))

    opened = known.where(F.col("line").startswith("COPY ") & F.col("line").rlike(HEADER)).groupBy(
        F.col("file").alias("of_file"), F.col("section").alias("of_section")).agg(
        F.min(F.struct("place", "line", "connection")).alias("head"))
    named = known.where(F.col("line").startswith("\\connect") & F.col("line").rlike(CONNECT)).select(
        F.col("file").alias("to_file"), F.col("connection").alias("to"), F.regexp_extract("line", CONNECT, 1).alias("database"))
    heads = opened.join(named, (F.col("of_file") == F.col("to_file")) & (F.col("head.connection") == F.col("to")), "left")
    whose = _names(F.regexp_extract("head.line", HEADER, 1))
    heads = heads.select("of_file", "of_section", F.col("head.place").alias("from"), F.element_at(_names(F.col("database")), 1).alias("database"),
                         F.when(F.size(whose) > 1, whose[0]).alias("schema_name"), F.element_at(whose, -1).alias("table_name"),
                         _names(F.regexp_extract("head.line", HEADER, 2)).alias("columns"))
    rows = known.where(F.col("line") != END).join(heads, (F.col("file") == F.col("of_file")) & (F.col("section") == F.col("of_section")))
    return rows.where(F.col("place") > F.col("from")).select(
        "database", "schema_name", "table_name", "columns", F.transform(F.split("line", "\t", -1), _value).alias("fields"))


def typed(rows: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("database", "table_name")) -> DataFrame:
    """Kept columns and those of ``schema``, taken by name from the fields of each row's own column list.

    A column that a section lacks, and a field that doesn't convert, is null.
    """
    def field(f: T.StructField) -> Column:
        at = F.array_position("columns", F.lit(f.name))
        return F.when(at > 0, F.try_element_at("fields", at.cast("int"))).try_cast(f.dataType).alias(f.name)
    return rows.select(*keep, *[field(f) for f in schema.fields])
