"""Raw CSV and JSON files of one table, whatever their headers and forms, in one text scan.

The raw text is read once: its lines are written to the shared scratch folder with their file and
place. What else is needed to read them (each file's header or form, the columns of all files,
their types) are small aggregates over that copy, so their cost doesn't grow with the
number of headers, and no header or path of a file reaches the driver.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakestrata.functions.expressions import quoted
from lakestrata.operators.relational import broadcast_if_bounded
from lakestrata.session import staged

CORRUPT = "_corrupt_record"
SOURCE_FILE = "__source_file"

#: Up to this many files their headers or forms are sent to all tasks; more are joined by file.
MAX_BROADCAST_FILES = 100_000

#: The types a text column may get, narrowest first; each bit of a column's profile stands for one.
KINDS = ("int", "bigint", "double", "date", "timestamp", "string")


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file at k line``: the lines with text, written once. ``k`` is unique and grows along a
    split of a file, ``at`` is where the split starts."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                         F.monotonically_increasing_id().alias("k"), F.col("value").alias("line"))
    return staged(lines.where(F.trim(F.regexp_replace("line", "^\ufeff", "")) != ""), "raw-lines", "zstd")


def first_lines(lines: DataFrame) -> DataFrame:
    """``file head line``: place (its ``k``) and text of the first line of each file, without a byte order mark.

    Only the splits that can hold it are read (the ``at`` filter reaches the Parquet scan).
    """
    place = F.struct("at", "k")
    least = lines.groupBy("file").agg(F.min("at").alias("at")).agg(F.max("at")).first()[0]  # 0 unless a file starts with blank splits
    first = lines.where(F.col("at") <= F.lit(least or 0)).groupBy("file").agg(F.min_by(F.struct("k", "line"), place).alias("x"))
    return first.select("file", F.col("x.k").alias("head"), F.regexp_replace("x.line", "^\ufeff", "").alias("line"))


def _without_nan(df: DataFrame) -> DataFrame:
    """``NaN`` tokens, which the extractor writes for missing values, as nulls."""
    out = {}
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            out[f.name] = F.when(~F.isnan(c), c)
        elif kind == "string" and f.name not in (CORRUPT, SOURCE_FILE):
            out[f.name] = F.when(c != "NaN", c)
    return df.withColumns(out) if out else df


# --- CSV ---------------------------------------------------------------------------------

def _header_names(line: str) -> list[str]:
    """Column names of a header; an empty name is ``_c{place}``, a repeated one gets its place appended."""
    names = [n.strip() for n in next(csv.reader([line], escapechar="\\"))]
    folded = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if folded.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def csv_headers(lines: DataFrame) -> DataFrame:
    """``file head line names``: each file's header with its column names, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([_header_names(x) for x in batch.column(2).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, names], names=["file", "head", "line", "names"])

    return staged(first_lines(lines).mapInArrow(run, "file string, head long, line string, names array<string>"), "csv-headers")


def all_columns(headers: DataFrame) -> list[str]:
    """Columns of all headers: those of the first header (by text) first, names equal but for case as one."""
    named = headers.select("line", F.posexplode("names").alias("pos", "name"))
    found = named.groupBy(F.lower("name").alias("folded")).agg(F.min(F.struct("line", "pos", "name")).alias("first")).orderBy("first.line", "first.pos")
    return [r.name for r in found.select("first.name").collect()]  # distinct column names only


def csv_text_columns(lines: DataFrame, headers: DataFrame, columns: list[str]) -> DataFrame:
    """Every data line as text columns, its values placed by its own file's header.

    A line with fewer values than its header has nulls for the rest. A line with more keeps the
    named ones, and ``_corrupt_record`` holds the line. Values are cut as Spark's CSV reader cuts them.
    """
    folded = F.transform("names", lambda n: F.lower(n))
    places = F.array(*[F.array_position(folded, F.lit(c.lower())).cast("int") for c in columns]) if columns else F.array().cast("array<int>")
    known = broadcast_if_bounded(headers.select("file", "head", F.size("names").alias("width"), places.alias("places")), MAX_BROADCAST_FILES)
    widest = headers.agg(F.max(F.size("names"))).first()[0] or 0
    cut = StructType([StructField(f"c{i}", StringType()) for i in range(widest + 1)])
    rows = lines.join(known, "file").where("k <> head").withColumn("cut", F.from_csv("line", cut.simpleString()[7:-1].replace(":", " ")))
    rows = rows.withColumn("values", F.array(*[F.col(f"cut.c{i}") for i in range(widest + 1)]))
    over = F.exists(F.slice("values", F.col("width") + 1, widest + 1), lambda x: x.isNotNull())
    # place 0: the file has no such column
    return rows.select(*[F.when(F.col("places")[i] > 0, F.get("values", F.col("places")[i] - 1)).alias(c) for i, c in enumerate(columns)],
                       F.when(over, F.col("line")).alias(CORRUPT), F.col("file").alias(SOURCE_FILE))


def _kind(c: Column) -> Column:
    """Bit of the narrowest type that holds a text value (null: 0)."""
    whole = c.rlike(r"^\s*[+-]?[0-9]+\s*$")
    bit = {k: F.lit(1 << i) for i, k in enumerate(KINDS)}
    return (F.when(c.isNull(), F.lit(0))
            .when(whole, F.when(c.try_cast("int").isNotNull(), bit["int"]).when(c.try_cast("bigint").isNotNull(), bit["bigint"]).otherwise(bit["double"]))
            .when(c.try_cast("double").isNotNull(), bit["double"])
            .when(c.rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$") & c.try_cast("date").isNotNull(), bit["date"])
            .when(c.try_cast("timestamp").isNotNull(), bit["timestamp"]).otherwise(bit["string"]))


def narrowest_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The narrowest type that holds all values of each text column, from one aggregate.

    Numbers widen to ``double``, dates to ``timestamp``; other mixtures and columns without a value are text.
    """
    if not columns:
        return {}
    seen = df.agg(*[F.bit_or(_kind(F.col(quoted(c)))).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    numbers, days = 0b111, 0b11000
    pick = lambda b: KINDS[b.bit_length() - 1] if b and (not b & ~numbers or not b & ~days) else "string"
    return {c: pick(seen[f"b{i}"] or 0) for i, c in enumerate(columns)}


def read_raw_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Raw CSV files, each by its own header, united by column name; plus ``_corrupt_record`` and ``__source_file``.

    No row is left out. ``_corrupt_record`` holds the line of a row that has more values than its
    header, or with a declared ``schema`` a value its type can't hold (null then); else it is null. Without
    ``schema`` types come from all values of a column. Files without a line with text have no rows.
    """
    lines = landed_lines(spark, path)
    headers = csv_headers(lines)
    columns = all_columns(headers)
    text = csv_text_columns(lines, headers, columns)
    if schema is None:
        kinds = narrowest_types(text, columns)
        return text.select(*[F.col(quoted(c)).try_cast(kinds[c]).alias(c) for c in columns], CORRUPT, SOURCE_FILE)
    have = {c.lower(): c for c in columns}
    cast, lost = [], F.lit(False)
    for f in schema.fields:
        if f.name == CORRUPT:
            continue
        c = F.col(quoted(have[f.name.lower()])) if f.name.lower() in have else F.lit(None).cast("string")
        cast.append(c.try_cast(f.dataType).alias(f.name))
        lost = lost | (c.isNotNull() & c.try_cast(f.dataType).isNull())
    every = F.to_json(F.struct(*[F.col(quoted(c)) for c in columns])) if columns else F.lit(None).cast("string")
    return text.select(*cast, F.coalesce(CORRUPT, F.when(lost, every)).alias(CORRUPT), SOURCE_FILE)


# --- JSON --------------------------------------------------------------------------------

def json_records(lines: DataFrame, array: bool | None = None) -> DataFrame:
    """``file record corrupt``: the text of every record, or what could not be cut into records.

    A file whose first line starts with ``[`` is a JSON array, else it has a record on each line;
    ``array`` says so for all files. Arrays are cut line by line where each line holds whole records (on one
    line or many); an array whose records run over lines is put together, one file in a task, as
    the format needs. Numbers inside arrays that are cut keep double precision.
    """
    heads = first_lines(lines).withColumn("array", F.ltrim("line").startswith("[") if array is None else F.lit(array)).drop("line")
    heads = staged(heads.join(lines.groupBy("file").agg(F.max_by("k", F.struct("at", "k")).alias("last")), "file"), "json-forms")
    own = lines.join(broadcast_if_bounded(heads, MAX_BROADCAST_FILES), "file")
    plain = own.where("NOT array").select("file", F.regexp_replace("line", "^\ufeff", "").alias("record"), F.lit(None).cast("string").alias("corrupt"))
    if heads.where("array").isEmpty():
        return plain
    body = F.trim(F.regexp_replace("line", "^\ufeff", ""))
    body = F.when(F.col("k") == F.col("head"), F.regexp_replace(body, r"^\[", "")).otherwise(body)
    body = F.when(F.col("k") == F.col("last"), F.regexp_replace(body, r"\]\s*$", "")).otherwise(body)
    body = F.regexp_replace(body, r"^\s*,|,\s*$", "")
    cut = lambda text: F.from_json(text, "array<string>")
    whole = lambda c: F.coalesce(F.forall(c, lambda x: F.coalesce(x.startswith("{"), F.lit(False))), F.lit(False))
    pieces = own.where("array").withColumn("parts", F.when(F.trim(body) == "", F.array().cast("array<string>")).otherwise(cut(F.concat(F.lit("["), body, F.lit("]")))))
    cut_off = (F.col("k") == F.col("last")) & ~F.rtrim("line").endswith("]")
    pieces = staged(pieces.select("file", "at", "k", "line", "parts", (cut_off | ~whole(F.col("parts"))).alias("odd")), "json-pieces")
    odd = pieces.groupBy("file").agg(F.max("odd").alias("odd"))
    pieces = pieces.drop("odd").join(broadcast_if_bounded(odd, MAX_BROADCAST_FILES), "file")
    out = plain.unionByName(pieces.where("NOT odd").select("file", F.explode("parts").alias("record"), F.lit(None).cast("string").alias("corrupt")))
    together = (pieces.where("odd").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", "k", "line"))).alias("x"))
                .select("file", F.regexp_replace(F.array_join("x.line", "\n"), "^\ufeff", "").alias("text")).withColumn("parts", cut(F.col("text"))))
    rest = together.select("file", F.explode(F.when(whole(F.col("parts")), F.transform("parts", lambda x: F.struct(x.alias("record"), F.lit(None).cast("string").alias("corrupt"))))
                                     .otherwise(F.array(F.struct(F.lit(None).cast("string").alias("record"), F.col("text").alias("corrupt"))))).alias("r")).select("file", "r.*")
    return out.unionByName(rest)


def infer_json_schema(records: DataFrame) -> StructType:
    """Columns and types of all records from one aggregate: whole numbers, doubles, booleans, text, structs and arrays.

    A field of mixed types, or without any value, is text.
    """
    plain = F.try_parse_json(F.col("record"))
    # bare NaN tokens are no JSON; cutting a one-element array quotes them
    quoted_nan = F.try_parse_json(F.get(F.from_json(F.concat(F.lit("["), F.col("record"), F.lit("]")), "array<string>"), 0))
    found = records.select(F.coalesce(plain, quoted_nan).alias("v")).where("v IS NOT NULL").agg(F.schema_of_variant_agg("v")).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return StructType([])
    text = found
    for old, new in ((r"OBJECT<>", "STRING"), (r"OBJECT<", "STRUCT<"), (r"VARIANT", "STRING"), (r"VOID", "STRING")):
        text = text.replace(old, new)
    return _as_json_types(StructType.fromDDL(text[len("STRUCT<"):-1]))


def _as_json_types(kind):
    """Fractions as doubles, as Spark's JSON reader has them."""
    from pyspark.sql.types import ArrayType, DecimalType, DoubleType, FloatType

    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_json_types(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_json_types(kind.elementType))
    return DoubleType() if isinstance(kind, FloatType) or (isinstance(kind, DecimalType) and kind.scale) else kind


def read_raw_json(spark: SparkSession, path: str, schema: StructType | None = None, array: bool | None = None) -> DataFrame:
    """Raw JSON files, each by its own form (a JSON array or a record on each line), plus ``_corrupt_record`` and ``__source_file``.

    ``_corrupt_record`` holds what can't be read: a line or file that is no JSON (no row then: all other
    columns null), or a record with a value its type can't hold. ``NaN`` becomes null. Without ``schema``
    the columns of all records are found first, by one aggregate over the staged lines.
    """
    records = json_records(landed_lines(spark, path), array)
    if schema is None:
        schema = infer_json_schema(records)
    fields = [f for f in schema.fields if f.name != CORRUPT]
    if not fields:
        return records.select(F.coalesce("corrupt", "record").alias(CORRUPT), F.col("file").alias(SOURCE_FILE))
    read = F.from_json("record", StructType([*fields, StructField(CORRUPT, StringType())]), {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    rows = records.withColumn("r", read).select(*[F.col(f"r.{quoted(f.name)}").alias(f.name) for f in fields], F.coalesce("corrupt", f"r.{CORRUPT}").alias(CORRUPT), F.col("file").alias(SOURCE_FILE))
    return _without_nan(rows)
