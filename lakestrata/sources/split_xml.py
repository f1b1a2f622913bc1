"""XML rows by a splittable text scan: one large response file spreads over many tasks.

The ``text`` source cuts the files behind ``<`` of every closing row tag, aligned with its own splits, so each
piece holds one row (and what stands before it). ``from_xml`` parses the row. A file is read
once by as many tasks as it has splits; without a schema one more pass finds the elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from lakestrata.functions.expressions import quoted

CORRUPT = "_corrupt_record"
SOURCE_FILE = "__source_file"
SOURCE_POS = "__source_pos"

#: As in ``read_xml``: attributes and name-space prefixes are ignored, an empty element is null.
OPTIONS = {"nullValue": "", "inferSchema": "false", "excludeAttribute": "true", "ignoreNamespace": "true",
           "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

#: Attributes of a tag, and a comment, section, instruction or tag.
_INSIDE = r"""(?:[^<>"']|"[^"]*"|'[^']*')*"""
_TOKEN = re.compile(rf"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<(/?)(?:[\w.\-]+:)?([^\s<>/:!?]+){_INSIDE}?(/?)>", re.S)

#: Rows whose shapes are known before all rows are looked at.
FIRST_ROWS = 20


def _open_tag(row_tag: str) -> str:
    return rf"<(?:[\w.\-]+:)?{re.escape(row_tag)}(?:\s{_INSIDE})?"


def xml_pieces(spark: SparkSession, paths: str | Sequence[str], row_tag: str) -> DataFrame:
    """One row per row element: ``__xml`` (its text), ``__broken`` (true: no whole element), the
    file and place it comes from, and the folders' partition columns.

    ``__source_pos`` orders the elements of a file. An element counts as broken if it is cut off, holds
    another element of the same tag, or a comment or CDATA section that it opens or closes only.
    """
    df = spark.read.option("lineSep", f"/{row_tag}>").text(paths)  # a closed element's piece ends with "<"
    df = df.withColumns({SOURCE_FILE: F.col("_metadata.file_path"),
                         SOURCE_POS: F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("k"))})
    opened = _open_tag(row_tag)
    closed = F.endswith("value", F.lit("<"))
    # most pieces: one plain opening tag and nothing odd, one cut at the tag's name and no other pattern needed
    df = df.withColumn("__cut", F.split("value", f"<{re.escape(row_tag)}", 3))
    after = F.get("__cut", F.lit(1))
    plain = closed & (F.size("__cut") == 2) & F.startswith(after, F.lit(">")) & ~F.contains("value", F.lit("<!")) & ~F.contains("value", F.lit("-->"))
    df = df.withColumn("__plain", plain)
    text = F.regexp_replace(F.when(closed, F.concat("value", F.lit(f"/{row_tag}>"))).otherwise(F.col("value")), r"(?s)<!--.*?-->", "")
    odd = F.contains(F.regexp_replace("__text", r"(?s)<!\[CDATA\[.*?\]\]>", ""), F.lit("<![CDATA[")) | F.contains("__text", F.lit("<!--")) | F.contains("__text", F.lit("-->"))
    starts = F.regexp_count("__text", F.lit(rf"{opened}(?<!/)>"))
    whole = F.concat(F.lit(f"<{row_tag}"), after, F.lit(f"/{row_tag}>"))
    df = df.withColumns({"__text": F.when(F.col("__plain"), whole).otherwise(text), "__closed": closed})
    df = df.withColumn("__broken", F.when(F.col("__plain"), F.lit(False)).otherwise(odd | (starts != F.col("__closed").cast("int"))))
    # empty elements (<item/>) that stand before the row are rows of their own
    rows = (F.when(F.col("__plain") | F.col("__broken"), F.array("__text"))
            .otherwise(F.regexp_extract_all("__text", F.lit(rf"(?s){opened}/>|{opened}>.*$"), F.lit(0))))
    others = [quoted(c) for c in df.columns if c not in ("value", "__cut", "__text", "__closed", "__plain", SOURCE_POS)]
    df = df.select(*others, SOURCE_POS, F.posexplode(rows).alias("__n", "__xml"))
    return df.withColumn(SOURCE_POS, F.struct(f"{SOURCE_POS}.at", f"{SOURCE_POS}.k", F.col("__n").alias("n"))).drop("__n")


def element_paths(row: str) -> set[tuple[str, bool]]:
    """Paths of the elements inside a row element, and whether one parent holds several of the name.

    An element that isn't well nested has no paths.
    """
    found: set[tuple[str, bool]] = set()
    stack: list[tuple[str, str, dict[str, int]]] = []  # name, path, how often each child so far
    done = False
    for m in _TOKEN.finditer(row):
        end, name, empty = m.groups()
        if name is None:  # a comment, CDATA section or instruction
            continue
        if done or (end and (not stack or stack[-1][0] != name)):
            return set()
        if end:
            stack.pop()
        else:
            path = ""
            if stack:
                _, above, seen = stack[-1]
                path = f"{above}/{name}" if above else name
                seen[name] = seen.get(name, 0) + 1
                found.add((path, seen[name] > 1))
            if not empty:
                stack.append((name, path, {}))
        done = not stack
    return found if done else set()


def infer_xml_schema(pieces: DataFrame) -> StructType:
    """Text leaves, nested structs and arrays of all whole elements; only distinct paths reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, bool]] = set()
        seen: set[str] = set()  # rows without their texts, of which most tables have few
        for batch in batches:
            for row in batch.column(0).unique().to_pylist():
                if row in seen:
                    continue
                if len(seen) < 10_000 and len(row) < 4096:
                    seen.add(row)
                found |= element_paths(row)
        yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in found], pa.string()), "many": pa.array([m for _, m in found], pa.bool_())})

    # the texts stay behind, unless a text may look like markup or an attribute hold ">"
    odd = F.contains("__xml", F.lit("<!")) | F.contains("__xml", F.lit('"')) | F.contains("__xml", F.lit("'"))
    tags = F.when(odd, F.col("__xml")).otherwise(F.regexp_replace("__xml", ">[^<]+<", "><"))
    rows = pieces.select(F.when(~F.col("__broken"), tags).alias("tags"))
    # every row is looked at, but those like one of the first few needn't leave the JVM
    known = sorted({r.tags for r in rows.limit(FIRST_ROWS).where(F.length("tags") < 4096).collect()})
    first = {p for row in known for p in element_paths(row)}
    others = rows.where(~F.col("tags").isin(known)) if known else rows.where("tags IS NOT NULL")
    found = others.mapInArrow(run, "path string, many boolean").groupBy("path").agg(F.max("many").alias("many")).collect()
    many: dict[str, bool] = {}
    for path, more in [*first, *((r.path, r.many) for r in found)]:
        many[path] = many.get(path, False) or more

    def struct(parent: str) -> StructType:
        inside = sorted({p[len(parent):].split("/")[0] for p in many if p.startswith(parent)})
        fields = []
        for name in inside:
            path = parent + name
            kind: DataType = struct(path + "/") if any(p.startswith(path + "/") for p in many) else StringType()
            fields.append(StructField(name, ArrayType(kind) if many.get(path) else kind))
        return StructType(fields)

    return struct("")


def read_xml_split(spark: SparkSession, paths: str | Sequence[str], row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """Repeated ``row_tag`` elements, at any depth, as rows; files are split over tasks.

    Closing tags must be written ``</row_tag>`` (a prefix ``</ns:row_tag>`` leaves its element broken, as does a row
    inside a row) and files must be UTF-8; ``read_xml`` reads the rest. Adds ``_corrupt_record`` (the text of a
    broken or malformed element, whose fields are null; else null), ``__source_file`` and ``__source_pos``.
    Partition columns of the folders are kept. Element names are compared without their prefix.
    """
    pieces = xml_pieces(spark, paths, row_tag)
    if schema is None:
        schema = infer_xml_schema(pieces)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != CORRUPT]
    parsed: Column = F.from_xml("__xml", StructType([*fields, StructField(CORRUPT, StringType())]), OPTIONS)
    others = [c for c in pieces.columns if c not in ("__xml", "__broken", SOURCE_FILE, SOURCE_POS) and c not in {f.name for f in fields}]
    # a broken element isn't parsed: what it lacks could be read as null fields
    rows = pieces.withColumn("__row", F.when(~F.col("__broken"), parsed))
    bad = F.when(F.col("__broken"), F.col("__xml")).otherwise(F.col(f"__row.{CORRUPT}"))
    return rows.select(*[F.col(f"__row.{quoted(f.name)}").alias(f.name) for f in fields], bad.alias(CORRUPT),
                       *[F.col(quoted(c)) for c in others], SOURCE_FILE, SOURCE_POS)
