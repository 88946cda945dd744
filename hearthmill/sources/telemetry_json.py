"""Telemetry samples kept as JSON arrays or JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthmill.operators.ordered import running_sums
from hearthmill.sources import splits
from hearthmill.sources.shared import settle

# One sample as it arrives; every field is read as text or left as a variant.
SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("telemetry_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("latency_ms", T.StringType()),
        T.StructField("active_containers", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
    ]
)


def read_sample_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole JSON files as ``path``, ``document``."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("document")
    )


def _variant_type(value: Column) -> Column:
    return F.schema_of_variant(value)


def explode_samples(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row per object of a JSON array, with its ``position``.

    Elements that are not objects are skipped. A document that is not JSON or
    not an array yields one row with ``error`` set and no ``sample``. Each
    element is a variant of its own, so a document may be larger than one.
    """
    parsed = documents.withColumn("_elements", F.from_json(document, "array<variant>"))
    elements = F.col("_elements")
    error = F.when(elements.isNull() & F.try_parse_json(document).isNull(), F.lit("not JSON")).when(
        elements.isNull(), F.lit("root is not a list")
    )
    kept = [F.col(name) for name in documents.columns if name != document]
    exploded = parsed.select(
        *kept, error.alias("error"), F.posexplode_outer(elements).alias("position", "sample")
    )
    is_object = _variant_type(F.col("sample")).startswith("OBJECT")
    return exploded.where(F.col("error").isNotNull() | is_object)


def _bracket_effects() -> dict[str, Column]:
    """What text up to a closing brace does to an open or closed quote and to the depth of brackets."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    parity = (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2

    def change(text: Column, open_after: Column) -> Column:
        outside = F.regexp_replace(text, r'"[^"]*+(?:"|\z)', "")
        deeper = F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))
        return (deeper - F.when(open_after == 0, 1).otherwise(0)).cast("long")  # the brace itself

    return {
        "when_closed": parity.cast("long"),
        "when_open": (1 - parity).cast("long"),
        "depth_closed": change(bare, parity),
        "depth_open": change(F.concat(F.lit('"'), bare), 1 - parity),
    }


def _first_char(text: Column) -> Column:
    return F.substring(F.ltrim(text), 1, 1)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+", "")


def _elements(inner: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), inner), "array<variant>")


def read_sample_arrays(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per object of JSON array files: path, error, position, sample, as explode_samples has them.

    Files are read up to each closing brace, by as many tasks as they have
    splits; an array may be larger than what one task could hold. One object,
    with the other elements right before it, is one row. A file that is not a
    list is put together again, in one row, to tell what is wrong with it.
    """
    pieces = splits.read_pieces(spark, paths, "}")
    cut = splits.records(pieces.withColumns(_bracket_effects()), "}", end_depth=1)
    text = _trimmed(F.col("text"))
    place = F.struct("block", "seq")
    files = cut.groupBy("file").agg(
        F.min_by(_first_char(text), place).alias("opens"), F.max("rest").alias("closed"), F.count_if(~F.col("rest")).alias("objects"), F.min(place).alias("first")
    )
    files = settle(files, "array-files")
    named = cut.withColumn("text", text).join(files, "file")
    lists = named.filter("opens = '['")
    leading = F.when(place == F.col("first"), F.lit("[")).otherwise(F.lit(","))
    inner = F.concat(F.expr("substring(text, 2)"), F.lit("}"))
    plain = _first_char(_trimmed(inner)) == "{"  # nothing but the object itself
    several = F.when(~plain, _elements(F.concat(inner, F.lit("]"))))
    found = lists.filter("not rest").select(
        "file", "block", "seq", F.when(_first_char(F.col("text")) == leading, inner).alias("inner"), plain.alias("plain"),
        F.when(plain, 1).otherwise(F.coalesce(F.size(several), F.lit(0))).cast("long").alias("n"),
    )
    placed = running_sums(found, ["file"], ["block"], ["seq"], {"reached": F.col("n")})
    objects = F.when(F.col("plain"), F.from_json("inner", "variant")).otherwise(F.element_at(_elements(F.concat(F.col("inner"), F.lit("]"))), -1))
    rows = placed.select("file", (F.col("reached") - 1).cast("int").alias("position"), objects.alias("sample"))
    rows = settle(rows, "array-objects")
    # What follows the last object, or the whole of a list without any.
    end = lists.filter("rest").select("file", "objects", "text")
    after = F.expr("substring(text, 2)")
    ends = F.when(F.col("objects") == 0, F.from_json("text", "array<variant>")).when(
        F.col("text").startswith("]"), _elements(F.col("text"))
    ).when(F.col("text").startswith(",") & (_first_char(_trimmed(after)) != "]"), _elements(after))
    bad = rows.filter("sample is null").select("file").union(end.filter(ends.isNull()).select("file")).union(files.filter("opens = '[' and not closed").select("file"))
    bad = settle(bad.distinct().withColumn("error", F.lit("not JSON")), "array-errors")
    good = rows.join(bad, "file", "left_anti").select(F.col("file").alias("path"), F.lit(None).cast("string").alias("error"), "position", "sample")
    wrong = bad.union(_other_roots(spark, paths, named.filter("opens <> '['")))
    none = F.lit(None)
    return good.unionByName(wrong.select(F.col("file").alias("path"), "error", none.cast("int").alias("position"), none.cast("variant").alias("sample")))


def _other_roots(spark: SparkSession, paths: str | list[str], named: DataFrame) -> DataFrame:
    """(file, error) of files whose first character opens no list, and of empty files."""
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "length")
    whole = named.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", "text"))), lambda part: part.text), "}").alias("document"))
    # Reading drops a brace at a file's very end (and a byte order mark of three bytes); the length tells.
    missing = (F.col("length") - F.octet_length("document")) % 3
    whole = whole.join(listed, "file").withColumn("document", F.when(missing == 1, F.concat("document", F.lit("}"))).otherwise(F.col("document")))
    is_json = F.try_parse_json("document").isNotNull()
    odd = whole.select("file", F.when(is_json, "root is not a list").otherwise("not JSON").alias("error"))
    return odd.union(listed.filter("length = 0").select("file", F.lit("not JSON")))


def read_sample_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON lines: one object per line, splittable at any size."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.try_parse_json("value").alias("sample"),
        F.when(F.try_parse_json("value").isNull(), F.lit("not JSON")).alias("error"),
    )
