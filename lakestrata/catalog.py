"""Query catalogue over the synthetic TPC-H-like tables, with DuckDB oracle SQL.

The stalled-cases star maps one to one onto the synthetic tables:

    movements  -> lineitem   case = l_orderkey, unit = l_suppkey, task = l_linestatus,
                             event text = l_shipdate as 'dd/MM/yyyy HH:mm:ss' (month start,
                             so several rows tie on a group's latest time)
    units      -> supplier   key = s_suppkey, name = s_name
    cases      -> orders     code = o_orderkey, type = o_custkey
    case types -> customer   key = c_custkey, name = c_mktsegment

The edge cases the reference's fixtures need are injected the same way on both sides:
a null unit (line 6), an impossible date text (line 5), units without a name (nation 0),
cases missing from ``cases`` (priority 5-LOW), an excluded unit and types outside the list.

Every query reads whole tables; files written by round-trip queries go to a fresh folder
under the session's shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakestrata.fixed import CASE_NESTED_ID_CHILDREN
from lakestrata.functions.expressions import days_since, local_time_text, parse_event_time, quoted
from lakestrata.operators.quality import integrity_check, null_profile, table_profile
from lakestrata.operators.relational import (
    anti_join,
    dedupe_keep_first,
    distinct_rows,
    join_dimension,
    latest_per_group,
    max_by_group,
    preview_topn,
    replicate_rows,
    semi_join,
    sql_over_frames,
    union_by_name,
    union_positional,
)
from lakestrata.operators.transforms import (
    ConformSpec,
    add_audit_columns,
    add_surrogate_key,
    cast_columns,
    clean_string_columns,
    conform,
    conform_to_schema,
    drop_columns,
    map_column_values,
    rename_columns,
)
from lakestrata.plans.facts import StarSpec, detail_from_latest, stalled_by_type, stalled_by_unit, stalled_cases, stalled_cases_from_detail
from lakestrata.plans.incremental_facts import merge_day
from lakestrata.plans.layers import (
    duplicate_raw_files,
    extract_responses,
    ingest_responses,
    land_raw,
    lift_nested_ids,
    nested_entity,
    read_responses,
    refine_dimension,
    standardize,
)
from lakestrata.session import session_key, shared_dir
from lakestrata.sinks.bucketed import join_bucketed, write_bucketed
from lakestrata.sinks.committed import replace_committed
from lakestrata.sinks.writers import write_csv, write_json, write_parquet, write_xml
from lakestrata.sources.files import raw_pattern, read_csv, read_json, read_latest_snapshot, read_parquet, select_raw_files
from lakestrata.sources.layout import LakeLayout
from lakestrata.sources.snapshots import record_snapshot
from lakestrata.sources.split_xml import CORRUPT, read_xml_split
from lakestrata.streaming.incremental import standardize_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2002-01-01"
EXCLUDED_SUPPLIER = "Supplier#000000001"
SEGMENTS = ("BUILDING", "MACHINERY")
LOAD_TS = "2024-01-02 03:04:05"
AUDIT_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
#: Landed text files are compressed; a file is one task's, so its rows are bounded.
CODEC, RECORDS_PER_FILE = "gzip", 50_000

SYN_SPEC = StarSpec(
    move_case="l_orderkey", move_unit="l_suppkey", move_task="l_linestatus", move_time="event_text",
    unit_key="s_suppkey", unit_name="s_name",
    case_code="o_orderkey", case_type="o_custkey",
    type_key="c_custkey", type_name="c_mktsegment",
    task_codes=("F",), excluded_unit=EXCLUDED_SUPPLIER, case_types=SEGMENTS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FIXTURES: dict[tuple[str, str, str], object] = {}


def _fixture(spark: SparkSession, d: str, name: str, build: Callable[[SparkSession, str], object]):
    """Files a query derives from the tables, written once per session and tables folder."""
    key = (session_key(spark), d, name)
    if key not in _FIXTURES:
        _FIXTURES[key] = build(spark, d)
    return _FIXTURES[key]


# --- the synthetic star ------------------------------------------------------------------

def movements(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        "l_linestatus",
        F.when(F.col("l_linenumber") == 5, F.lit("31/02/2001 00:00:00"))
         .otherwise(local_time_text("l_shipdate", "01/MM/yyyy 00:00:00")).alias("event_text"),
    )


def units(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select("s_suppkey",
                    F.when(F.col("s_nationkey") == 0, F.lit(None)).otherwise(F.col("s_name")).alias("s_name"))


def cases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "o_custkey")


def case_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment")


def _star(spark, d):
    return movements(spark, d), units(spark, d), cases(spark, d), case_types(spark, d)


STAR_SQL = """
WITH mv AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS l_suppkey,
         l_linestatus,
         CASE WHEN l_linenumber = 5 THEN '31/02/2001 00:00:00'
              ELSE strftime(l_shipdate, '01/%m/%Y 00:00:00') END AS event_text
  FROM lineitem),
un AS (SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN NULL ELSE s_name END AS s_name FROM supplier),
cs AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority <> '5-LOW'),
ty AS (SELECT c_custkey, c_mktsegment FROM customer)
"""

# the meaning of the facts: the newest movements of each (unit, case), then the dimensions
_NEWEST = f"""
, moved AS (
  SELECT mv.*, try_strptime(event_text, '%d/%m/%Y %H:%M:%S') AS happened
  FROM mv SEMI JOIN cs ON o_orderkey = l_orderkey
  WHERE l_linestatus = 'F' AND l_suppkey IS NOT NULL),
newest AS (
  SELECT * FROM moved WHERE happened IS NOT NULL
  QUALIFY rank() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY happened DESC) = 1),
placed AS (
  SELECT newest.l_orderkey, newest.happened, un.s_name, ty.c_mktsegment
  FROM newest
  INNER JOIN un ON un.s_suppkey = newest.l_suppkey AND un.s_name <> '{EXCLUDED_SUPPLIER}'
  INNER JOIN cs ON cs.o_orderkey = newest.l_orderkey
  INNER JOIN ty ON ty.c_custkey = cs.o_custkey AND ty.c_mktsegment IN ('BUILDING', 'MACHINERY'))
"""


def fact_stalled(spark, d):
    return stalled_cases(*_star(spark, d), SYN_SPEC, as_of=AS_OF, sort_latest_first=True)


def fact_by_unit(spark, d):
    return stalled_by_unit(*_star(spark, d), SYN_SPEC)


def fact_by_type(spark, d):
    return stalled_by_type(*_star(spark, d), SYN_SPEC)


def fact_stalled_join_back(spark, d):
    """The same fact through max + join back (the reference's plan shape)."""
    return stalled_cases(*_star(spark, d), SYN_SPEC, as_of=AS_OF, sort_latest_first=True, method="join_back")


def fact_stalled_window(spark, d):
    """The same fact through ``rank() == 1`` with a map-side group limit."""
    return stalled_cases(*_star(spark, d), SYN_SPEC, as_of=AS_OF, sort_latest_first=True, method="window")


def _hot_movements(spark, d):
    """movements plus copies of one eligible movement, so that one (unit, case) group,
    all tied at its latest time, holds a third of all rows. The copy count is half the
    table size, so the hot group grows with the tables."""
    mv = movements(spark, d)
    ok_cases = cases(spark, d).join(
        case_types(spark, d).where(F.col("c_mktsegment") == "BUILDING"),
        F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    ok_units = units(spark, d).where(F.col("s_name").isNotNull() & (F.col("s_name") != EXCLUDED_SUPPLIER)).select(
        F.col("s_suppkey").alias("l_suppkey"))
    candidates = (mv.where((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1))
                    .join(ok_cases, "l_orderkey", "left_semi").join(ok_units, "l_suppkey", "left_semi"))
    first = candidates.agg(F.min("l_orderkey").alias("l_orderkey"))
    hot = candidates.join(first, "l_orderkey", "left_semi")
    n_copies = mv.agg((F.count(F.lit(1)) / 2).cast("bigint")).first()[0]  # one number
    copies = replicate_rows(hot.withColumn("__n", F.lit(n_copies)), "__n", spread_by=["l_orderkey"]).drop("__n")
    return union_positional(mv, copies.select(*mv.columns))


def fact_by_unit_hot_group(spark, d):
    """fact_by_unit with one (unit, case) group holding a third of all rows as tied copies."""
    return stalled_by_unit(_hot_movements(spark, d), units(spark, d), cases(spark, d), case_types(spark, d), SYN_SPEC)


def fact_stalled_hot_group(spark, d):
    """fact_stalled (sorted) with one (unit, case) group holding a third of all rows."""
    return stalled_cases(_hot_movements(spark, d), units(spark, d), cases(spark, d), case_types(spark, d),
                         SYN_SPEC, as_of=AS_OF, sort_latest_first=True)


_HOT_SQL = STAR_SQL.replace("ty AS (", """hot AS (
  SELECT m.* FROM mv m
  WHERE m.l_linestatus = 'F' AND m.l_linenumber = 1
    AND m.l_orderkey IN (SELECT o_orderkey FROM cs JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
    AND m.l_suppkey IN (SELECT s_suppkey FROM un WHERE s_name IS NOT NULL AND s_name <> '__EXCL__')),
hot1 AS (SELECT * FROM hot WHERE l_orderkey = (SELECT min(l_orderkey) FROM hot)),
mvh AS (SELECT * FROM mv UNION ALL
        SELECT h.* FROM hot1 h, range(CAST((SELECT count(*) FROM mv) / 2 AS BIGINT))),
ty AS (""").replace("__EXCL__", EXCLUDED_SUPPLIER)

_ORDER_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_ORDERS_TEXT_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, {_ORDER_DAY} AS o_orderdate{{more}} FROM orders{{missing}}
"""

_FACT_SQL = STAR_SQL + _NEWEST + f"""
SELECT l_orderkey AS IdProcedimentoFormatado, s_name AS Sigla, c_mktsegment AS tipo,
       CAST(date_diff('day', CAST(happened AS DATE), DATE '{AS_OF}') AS INTEGER) AS Dias_Sem_Movimentacao
FROM placed
"""

# --- latest / max per group -------------------------------------------------------------

def q_latest_per_group(spark, d):
    li = table(spark, d, "lineitem")
    return latest_per_group(li, "l_suppkey", "l_shipdate", materialize=True).select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"))


def q_max_by_group(spark, d):
    mv = semi_join(movements(spark, d).where(F.col("l_linestatus").isin("F")),
                   cases(spark, d).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    mv = mv.withColumn("ts", parse_event_time("event_text"))
    return max_by_group(mv, ["l_suppkey", "l_orderkey"], "ts", "max_ts").select(
        "l_suppkey", "l_orderkey", local_time_text("max_ts", "yyyy-MM-dd HH:mm:ss").alias("latest"))


# --- joins ---------------------------------------------------------------------------------

def q_star_left_join(spark, d):
    mv, un, cs, ty = _star(spark, d)
    out = join_dimension(mv, un, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    out = join_dimension(out, cs, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    out = join_dimension(out, ty, F.col("o_custkey") == F.col("c_custkey"), "left")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "o_custkey", "c_mktsegment")


def q_semi_join_filter(spark, d):
    keys = cases(spark, d).select(F.col("o_orderkey").alias("l_orderkey"))
    return semi_join(movements(spark, d), keys, "l_orderkey").select("l_orderkey", "l_linenumber", "l_suppkey")


def q_anti_join_blocklist(spark, d):
    blocked = table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return anti_join(table(spark, d, "lineitem"), blocked, "l_orderkey").select("l_orderkey", "l_linenumber")


# --- scalar functions ------------------------------------------------------------------------

def _order_text():
    return (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("not a date"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.lit("31/02/1999 10:00:00"))
             .otherwise(local_time_text("o_orderdate", "dd/MM/yyyy HH:mm:ss")))


def q_parse_ts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", _order_text().alias("event_text"))
    ts = parse_event_time("event_text")
    return o.select("o_orderkey", "event_text",
                    local_time_text(ts, "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                    F.to_date(ts).alias("parsed_date"))


def q_days_since(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", days_since("o_orderdate", AS_OF).alias("days_since"))


# --- transforms --------------------------------------------------------------------------------

def _part_input(spark, d):
    p = table(spark, d, "part")
    return p.withColumn("p_name", F.when(F.col("p_size") == 1, F.lit("   "))
                                   .when(F.col("p_size") == 2, F.lit(None))
                                   .otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))))


DIM_SPEC = ConformSpec(
    rename={"p_partkey": "nk_part", "p_type": "part_type", "p_absent": "p_other"},
    cast={"p_size": "bigint", "p_brand": "int"},
    drop=["p_retailprice", "p_other"],
    map_values={"part_type": {"ECONOMY": "SMALL", "SMALL": "TINY"}},
    clean_strings=["p_name"],
    surrogate_key="sk_part",
    surrogate_order=["nk_part"],
)


def q_dim_conform(spark, d):
    return conform(_part_input(spark, d), DIM_SPEC)


def q_col_rename(spark, d):
    return rename_columns(table(spark, d, "customer"), {"c_name": "customer_name", "c_absent": "x"})


def q_col_cast(spark, d):
    return cast_columns(table(spark, d, "customer"),
                        {"c_custkey": "string", "c_nationkey": "bigint", "c_mktsegment": "int"})


def q_col_drop(spark, d):
    return drop_columns(table(spark, d, "customer"), ["c_name", "c_acctbal", "c_absent"])


def q_map_values(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "user_id")
    return map_column_values(e, {"event_type": {"click": "view", "view": "open", 1: "one"},
                                 "user_id": {8: 800, 800: 9}})


def _dirty_customer(spark, d):
    c = table(spark, d, "customer")
    n = F.col("c_nationkey")
    return c.withColumn("c_name", F.when(n == 1, F.lit("")).when(n == 2, F.lit(None))
                                  .when(n == 3, F.lit("  ab ")).when(n == 4, F.concat(F.lit("\t"), "c_name"))
                                  .when(n == 5, F.lit("ação")).otherwise(F.lower("c_name")))


def q_clean_strings(spark, d):
    return clean_string_columns(_dirty_customer(spark, d), ["c_name", "c_nationkey"]).select(
        "c_custkey", "c_name", "c_nationkey")


def _audit_text(df):
    return df.withColumns({c: F.date_format(c, AUDIT_TEXT)
                           for c in ("dt_carga", "etl_dt_inicio", "etl_dt_fim")})


def q_audit_columns(spark, d):
    return _audit_text(add_audit_columns(table(spark, d, "supplier"), LOAD_TS))


def q_surrogate_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return add_surrogate_key(o, "sk_order", ["o_orderkey"])


def q_schema_conform(spark, d):
    schema = StructType([
        StructField("c_custkey", StringType()), StructField("c_name", StringType()),
        StructField("c_mktsegment", IntegerType()), StructField("c_phone", StringType()),
        StructField("c_acctbal", DoubleType()),
    ])
    return conform_to_schema(table(spark, d, "customer"), schema)


# --- dedupe and quality -------------------------------------------------------------------------

def q_dedupe_keep_first(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return dedupe_keep_first(e, "user_id", ["ts", "event_id"])


def q_distinct_rows(spark, d):
    li = table(spark, d, "lineitem")
    return distinct_rows(union_positional(li, li))


def q_integrity_check(spark, d):
    li = table(spark, d, "lineitem")
    return integrity_check(union_positional(li, li.where(F.col("l_linenumber") == 1)))


def _nully_customer(spark, d):
    c = table(spark, d, "customer")
    n = F.col("c_nationkey")
    return c.withColumns({
        "c_name": F.when(n == 1, F.lit(None)).when(n == 2, F.lit("")).when(n == 3, F.lit("None"))
                   .when(n == 4, F.lit("xNone")).when(n == 5, F.lit("NULL"))
                   .when(n == 6, F.lit("NONEXISTENT")).when(n == 7, F.lit("null"))
                   .otherwise(F.col("c_name")),
        "c_mktsegment": F.when(n == 8, F.lit(None)).otherwise(F.col("c_mktsegment")),
    })


def q_null_profile(spark, d):
    return null_profile(_nully_customer(spark, d))


def q_table_profile(spark, d):
    return table_profile(table(spark, d, "lineitem"))


# --- unions, ordering, SQL ------------------------------------------------------------------------

def q_union_positional(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return union_positional(c, s)


def q_union_by_name(spark, d):
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("mktsegment"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"))
    return union_by_name(s, c)


def q_preview_topn(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return preview_topn(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def q_sql_over_views(spark, d):
    return sql_over_frames(
        spark,
        "SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price "
        "FROM {orders} WHERE o_orderdate >= :since GROUP BY o_orderstatus",
        args={"since": dt.date(1997, 1, 1)},
        orders=table(spark, d, "orders"))


def q_snapshot_scan(spark, d):
    read_parquet(spark, f"{d}/orders.parquet", view="orders_snapshot")
    return spark.table("orders_snapshot")


# --- file round trips ----------------------------------------------------------------------------

SUPPLIER_SCHEMA = StructType([
    StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
    StructField("s_nationkey", IntegerType()), StructField("s_acctbal", DoubleType()),
])


def q_csv_roundtrip(spark, d):
    path = shared_dir(spark, "csv") + "/supplier.csv"
    write_csv(table(spark, d, "supplier"), path)
    return conform_to_schema(read_csv(spark, path), SUPPLIER_SCHEMA)


def q_json_roundtrip(spark, d):
    path = shared_dir(spark, "json") + "/supplier.json"
    write_json(table(spark, d, "supplier"), path)
    return conform_to_schema(read_json(spark, path), SUPPLIER_SCHEMA)


def q_parquet_overwrite(spark, d):
    path = shared_dir(spark, "parquet") + "/orders.parquet"
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    write_parquet(o, path, "overwrite")
    write_parquet(o, path, "overwrite")  # replaces, still one copy
    write_parquet(o, path, "append")  # adds a second copy
    return read_parquet(spark, path)


# --- XML responses ------------------------------------------------------------------------------

def _write_responses(spark, d) -> str:
    """lineitem x supplier landed as XML responses, one folder per request (return flag);
    lines numbered 1 are re-sent under request Z (duplicates of earlier responses). The
    movement key is made of the row's own values, so rows sharing a key are equal."""
    li = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    local_time_text("l_shipdate", "yyyyMMdd"), "l_returnflag", "l_linestatus").alias("IdAndamento"),
        F.struct(F.col("l_suppkey").cast("string").alias("IdUnidade"), F.col("s_name").alias("Sigla")).alias("Unidade"),
        F.struct(F.col("l_partkey").cast("string").alias("IdUsuario")).alias("Usuario"),
        F.col("l_linestatus").alias("IdTarefa"),
        local_time_text("l_shipdate", "dd/MM/yyyy HH:mm:ss").alias("DataHora"),
        F.col("l_returnflag").alias("request"),
        "l_linenumber",
    )
    path = shared_dir(spark, "xml") + "/responses"
    _write_requests(rows, F.col("l_linenumber") == 1, path, "item", "items", drop=["l_linenumber"])
    return path


def _write_requests(rows: DataFrame, again: Column, path: str, row_tag: str, root_tag: str, drop: tuple | list = ()) -> None:
    """Rows as XML responses by request, those that ``again`` holds for also under request Z: one pass
    without a shuffle or a sort, in compressed files of bounded length."""
    requests = F.when(again, F.array("request", F.lit("Z"))).otherwise(F.array("request"))
    out = rows.withColumn("request", F.explode(requests)).drop(*drop)
    write_xml(out, path, row_tag, root_tag, partition_by=["request"], max_records_per_file=RECORDS_PER_FILE, compression=CODEC)


def _land_responses(spark, d) -> str:
    return _fixture(spark, d, "responses", _write_responses)


RESPONSE_SCHEMA = StructType([
    StructField("IdAndamento", StringType()),
    StructField("Unidade", StructType([StructField("IdUnidade", StringType()), StructField("Sigla", StringType())])),
    StructField("Usuario", StructType([StructField("IdUsuario", StringType())])),
    StructField("IdTarefa", StringType()),
    StructField("DataHora", StringType()),
])


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            cols += [F.col(quoted(f.name, c)).alias(f"{f.name}{sep}{c}") for c in f.dataType.fieldNames()]
        else:
            cols.append(F.col(quoted(f.name)))
    return df.select(*cols)


def q_xml_flatten(spark, d):
    path = _land_responses(spark, d)
    df = read_responses(spark, path, "item").drop("__source_file", "__source_pos")
    return flatten_structs(df)


def q_nested_id_lift(spark, d):
    path = _land_responses(spark, d)
    df = lift_nested_ids(read_responses(spark, path, "item", RESPONSE_SCHEMA))
    return df.select("IdAndamento", "Unidade", "Usuario", "request")


def q_nested_entity_dim(spark, d):
    return nested_entity(spark, _land_responses(spark, d), "item", "Unidade", schema=RESPONSE_SCHEMA)


def q_ingest_movements(spark, d):
    path = _land_responses(spark, d)
    out = ingest_responses(spark, path, "item", "IdAndamento", schema=RESPONSE_SCHEMA,
                           request_key=("IdProcedimentoFormatado", r"/request=([^/]+)/"))
    return out.drop("request")


def fact_stalled_incremental(spark, d):
    """The stalled-cases fact from a state that three days were merged into, the second of them twice."""
    mv, un, cs, ty = _star(spark, d)
    path = shared_dir(spark, "state")
    day = lambda k: mv.where(F.col("l_linenumber") % 3 == k)
    for name, k in (("20240101", 0), ("20240102", 1), ("20240102", 1), ("20240103", 2)):
        state = merge_day(day(k), path, name, SYN_SPEC)
    return stalled_cases_from_detail(detail_from_latest(state, un, cs, ty, SYN_SPEC), as_of=AS_OF)


def q_star_join_bucketed(spark, d):
    """The star of ``star_left_join`` over refined tables bucketed by case: the large join moves no row."""
    folder = shared_dir(spark, "bucketed")
    mv = write_bucketed(movements(spark, d).select("l_orderkey", "l_linenumber", "l_suppkey"), f"{folder}/movements", "l_orderkey", 16)
    cs = write_bucketed(cases(spark, d), f"{folder}/cases", "o_orderkey", 16, hot_factor=None)
    out = join_bucketed(spark, mv, cs)
    out = join_dimension(out, units(spark, d), F.col("s_suppkey") == F.col("l_suppkey"), "left", max_broadcast_rows=1_000_000)
    out = join_dimension(out, case_types(spark, d), F.col("c_custkey") == F.col("o_custkey"), "left", max_broadcast_rows=1_000_000)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "o_custkey", "c_mktsegment")


def q_latest_snapshot_indexed(spark, d):
    """The newest snapshot by the table's index: a newer day whose write hasn't ended isn't taken."""
    lake = LakeLayout(shared_dir(spark, "lake"))
    root = lake.standardized_table("sales", "orders")
    o = _orders_text(spark, d)
    for day, status in RAW_DAYS.items():
        write_parquet(o.where(F.col("o_orderstatus") == status), lake.standardized("sales", "orders", day))
        record_snapshot(spark, root, day)
    write_parquet(o.where("o_orderkey % 2 = 0"), lake.standardized("sales", "orders", "20240104"))  # not recorded: not whole yet
    return read_latest_snapshot(spark, root)


def q_max_records_per_file(spark, d):
    """A table written with at most 1000 rows a file: its rows, the files over the bound, and whether there are as many as that takes."""
    path = shared_dir(spark, "parquet") + "/lineitem.parquet"
    write_parquet(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, max_records_per_file=1000)
    files = read_parquet(spark, path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1000).alias("n_over"), (F.count(F.lit(1)) >= F.sum("n") / 1000).alias("enough"))


def q_xml_split_scan(spark, d):
    """The rows of ``xml_flatten`` by the split scan, elements found in all of them; none is corrupt."""
    df = read_xml_split(spark, _land_responses(spark, d), "item").drop("__source_file", "__source_pos")
    return flatten_structs(df).withColumnRenamed(CORRUPT, "corrupt")


def _write_case_responses(spark, d) -> str:
    """orders x customer landed as case responses (row tag ``parametros``), one folder per request (priority);
    every tenth case is re-sent under request Z."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select(
        F.col("o_orderkey").cast("string").alias("IdProcedimento"), F.concat(F.lit("C-"), F.col("o_orderkey").cast("string")).alias("ProcedimentoFormatado"),
        F.struct(F.col("o_custkey").cast("string").alias("IdTipoProcedimento"), F.col("c_mktsegment").alias("Nome")).alias("TipoProcedimento"),
        local_time_text("o_orderdate", "yyyy-MM-dd").alias("DataAutuacao"), F.col("o_orderpriority").alias("request"))
    path = shared_dir(spark, "xml") + "/cases"
    _write_requests(rows, F.col("IdProcedimento").endswith("0"), path, "parametros", "resposta")
    return path


CASE_RESPONSE_SCHEMA = StructType([
    StructField("IdProcedimento", StringType()), StructField("ProcedimentoFormatado", StringType()),
    StructField("TipoProcedimento", StructType([StructField("IdTipoProcedimento", StringType()), StructField("Nome", StringType())])),
    StructField("DataAutuacao", StringType()),
])


def q_ingest_cases(spark, d):
    """Case responses of all requests but a blocked one: type id lifted, one row per case."""
    out = ingest_responses(spark, _fixture(spark, d, "case_responses", _write_case_responses), "parametros", "IdProcedimento",
                           request_key=("asked", r"/request=([^/]+)/"), children=CASE_NESTED_ID_CHILDREN,
                           schema=CASE_RESPONSE_SCHEMA, blocked=["5-LOW"])
    return out.drop("request", "asked")


def q_case_types_dim(spark, d):
    """Case types out of the same responses, one row per type."""
    return nested_entity(spark, _fixture(spark, d, "case_responses", _write_case_responses), "parametros", "TipoProcedimento", schema=CASE_RESPONSE_SCHEMA)


def q_lake_end_to_end(spark, d):
    """Responses -> keyed dedupe -> raw JSON (dated) -> standardized Parquet -> refined
    dimension with cleaned strings and audit columns."""
    lake = LakeLayout(shared_dir(spark, "lake"))
    moves = extract_responses(spark, _land_responses(spark, d), "item", "IdAndamento", schema=RESPONSE_SCHEMA,
                              request_key=("IdProcedimentoFormatado", r"/request=([^/]+)/"))["rows"].drop("request")
    land_raw(moves, lake, "case_movements", "andamentos", "20240131", max_records_per_file=RECORDS_PER_FILE, compression=CODEC)
    standardize(spark, lake, "json", "20240131", business_area="case_movements", load_ts=LOAD_TS)
    spec = ConformSpec(rename={"IdTarefa": "task"}, clean_strings=["DataHora"])
    path = refine_dimension(spark, lake, "case_movements", "andamentos", "dim_case_movements", spec,
                            load_ts=LOAD_TS)
    return _audit_text(read_parquet(spark, path))


def q_ingest_key_list(spark, d):
    """Only requests in a driving key list (a frame from the tables, never collected),
    minus a block list; re-sent pages under other requests drop out."""
    wanted = table(spark, d, "lineitem").select("l_returnflag")
    out = ingest_responses(spark, _land_responses(spark, d), "item", "IdAndamento", schema=RESPONSE_SCHEMA,
                           request_key=("IdProcedimentoFormatado", r"/request=([^/]+)/"),
                           wanted=wanted, blocked=["N"])
    return out.drop("request")


def q_extract_users_dim(spark, d):
    """Users projected from the same single parse of the responses as the movements."""
    out = extract_responses(spark, _land_responses(spark, d), "item", "IdAndamento",
                            entities={"Usuario": None}, schema=RESPONSE_SCHEMA)
    return out["Usuario"]


# --- raw / standardized layout ---------------------------------------------------------------------

RAW_DAYS = {"20240101": "F", "20240102": "O", "20240103": "P"}


def _orders_text(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        local_time_text("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


def _write_raw_lake(spark, d) -> LakeLayout:
    """orders under three days (one status per day), a CSV of another status on the
    middle day, a second business area, and a dataset outside the layout depth."""
    lake = LakeLayout(shared_dir(spark, "lake"))
    packed = {"max_records_per_file": RECORDS_PER_FILE, "compression": CODEC}
    o = _orders_text(spark, d)
    for day, status in RAW_DAYS.items():
        write_json(o.where(F.col("o_orderstatus") == status), lake.raw("sales", "orders", day, "json"), **packed)
    write_csv(o.where(F.col("o_orderstatus") == "P"), lake.raw("sales", "orders", "20240102", "csv"))
    write_json(table(spark, d, "customer"), lake.raw("finance", "customers", "20240102", "json"), **packed)
    write_json(o, f"{lake.raw_root}/sales/misplaced/20240102/orders.json", **packed)
    return lake


def _land_raw_lake(spark, d) -> LakeLayout:
    return _fixture(spark, d, "raw_lake", _write_raw_lake)


ORDERS_OUT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"]

ORDERS_TEXT_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("o_orderpriority", StringType()), StructField("o_orderdate", StringType()),
])


def q_raw_file_selection(spark, d):
    lake = _land_raw_lake(spark, d)
    files = select_raw_files(spark, lake.raw_root, "json", "20240102", business_area="sales")
    found = read_json(spark, raw_pattern(lake.raw_root, "json", "20240102", "sales"), schema=ORDERS_TEXT_SCHEMA)
    return found.withColumn("n_datasets", F.lit(files.select("dataset_path").distinct().count()).cast("bigint"))


def q_standardize_json(spark, d):
    lake = _land_raw_lake(spark, d)
    out_lake = LakeLayout(shared_dir(spark, "lake"))
    standardize(spark, lake, "json", "20240102", business_area="sales", load_ts=LOAD_TS, target=out_lake)
    out = read_parquet(spark, out_lake.standardized("sales", "orders", "20240102"))
    return _audit_text(out.select(*ORDERS_OUT, "dt_carga", "etl_versao", "etl_dt_inicio", "etl_dt_fim"))


def q_standardize_csv(spark, d):
    lake = _land_raw_lake(spark, d)
    out_lake = LakeLayout(shared_dir(spark, "lake"))
    standardize(spark, lake, "csv", "20240102", load_ts=LOAD_TS, target=out_lake)
    out = read_parquet(spark, out_lake.standardized("sales", "orders", "20240102"))
    out = conform_to_schema(out, ORDERS_TEXT_SCHEMA)
    return out


def _write_standardized(spark, d) -> LakeLayout:
    lake = LakeLayout(shared_dir(spark, "lake"))
    o = _orders_text(spark, d)
    for day, status in RAW_DAYS.items():
        write_parquet(o.where(F.col("o_orderstatus") == status), lake.standardized("sales", "orders", day))
    return lake


def _land_standardized(spark, d) -> LakeLayout:
    return _fixture(spark, d, "standardized_lake", _write_standardized)


def q_latest_snapshot(spark, d):
    lake = _land_standardized(spark, d)
    return read_latest_snapshot(spark, lake.standardized_table("sales", "orders"))


def q_stream_standardize(spark, d):
    """The raw orders of all three days picked up by a file-source stream (availableNow),
    appended to a standardized table with audit columns."""
    lake = _land_raw_lake(spark, d)
    target = shared_dir(spark, "stream") + "/orders"
    glob = f"{lake.raw_root}/sales/operacional/orders/*/orders_*.json/*.json*"
    q = standardize_stream(spark, glob, ORDERS_TEXT_SCHEMA, target, load_ts=LOAD_TS,
                           checkpoint=shared_dir(spark, "stream-checkpoints"))
    q.awaitTermination()
    out = read_parquet(spark, target)
    return _audit_text(out.select(*ORDERS_OUT, "dt_carga", "etl_versao", "etl_dt_inicio", "etl_dt_fim"))


REFINE_SPEC = ConformSpec(
    rename={"o_orderkey": "nk_order"},
    map_values={"o_orderstatus": {"P": "PENDING"}},
    clean_strings=["o_orderpriority"],
)


def q_refine_dimension(spark, d):
    lake = _land_standardized(spark, d)
    path = refine_dimension(spark, lake, "sales", "orders", "dim_orders", REFINE_SPEC, load_ts=LOAD_TS,
                            target=LakeLayout(shared_dir(spark, "lake")))
    return _audit_text(read_parquet(spark, path))


# --- raw files of several forms ----------------------------------------------------------------

def q_standardize_mixed_json(spark, d):
    """One endpoint and day with JSON array files beside JSON Lines files, each read whole."""
    lake, out_lake = LakeLayout(shared_dir(spark, "lake")), LakeLayout(shared_dir(spark, "lake"))
    o = _orders_text(spark, d).select(*ORDERS_OUT)
    write_json(o.where("o_orderstatus <> 'F'"), lake.raw("sales", "orders", "20240102", "json"))
    arrays = (o.where("o_orderstatus = 'F'").groupBy(F.expr("o_orderkey DIV 4000").alias("g"))
              .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.to_json(F.struct(*ORDERS_OUT))), ",\n"), F.lit("\n]")).alias("value")))
    folder = lake.raw("sales", "orders", "20240102", "json").rsplit("/", 1)[0]
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/orders_arrays.json")
    status = standardize(spark, lake, "json", "20240102", load_ts=LOAD_TS, target=out_lake).first()
    out = conform_to_schema(read_parquet(spark, status.standardized_path), ORDERS_TEXT_SCHEMA)
    return out.withColumn("n_corrupt", F.lit(status.n_corrupt).cast("bigint"))


def q_standardize_csv_headers(spark, d):
    """One endpoint and day with CSV files whose columns differ in order and number."""
    lake, out_lake = LakeLayout(shared_dir(spark, "lake")), LakeLayout(shared_dir(spark, "lake"))
    o = _orders_text(spark, d).select(*ORDERS_OUT)
    folder = lake.raw("sales", "orders", "20240102", "csv").rsplit("/", 1)[0]
    write_csv(o.where("o_orderstatus = 'F'"), f"{folder}/orders_20240102.csv")
    write_csv(o.where("o_orderstatus = 'O'").select(*reversed(ORDERS_OUT)), f"{folder}/orders_reversed.csv")
    write_csv(o.where("o_orderstatus = 'P'").select("o_orderstatus", "o_orderkey"), f"{folder}/orders_short.csv")
    status = standardize(spark, lake, "csv", "20240102", load_ts=LOAD_TS, target=out_lake).first()
    out = read_parquet(spark, status.standardized_path)
    return conform_to_schema(out, ORDERS_TEXT_SCHEMA)


def q_duplicate_files(spark, d):
    """Raw CSV files of a day that repeat rows of their own: one does, one shares rows with another, one is clean."""
    lake = LakeLayout(shared_dir(spark, "lake"))
    o = _orders_text(spark, d).select(*ORDERS_OUT)
    folder = lake.raw("sales", "orders", "20240102", "csv").rsplit("/", 1)[0]
    open_, done = o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'")
    write_csv(open_.unionByName(open_.where("o_orderkey % 50 = 0")).unionByName(open_.where("o_orderkey % 100 = 0")), f"{folder}/orders_open.csv")
    write_csv(done, f"{folder}/orders_done.csv")
    write_csv(done.where("o_orderkey % 2 = 0"), f"{folder}/orders_again.csv")
    return duplicate_raw_files(spark, lake, "csv", "20240102").select("endpoint", "file", "n_rows", "n_distinct", "n_duplicates")


def q_replace_committed(spark, d):
    """A table replaced by a commit, then by a write that fails midway (its rows stay), then by rows read from itself."""
    path = shared_dir(spark, "committed") + "/orders.parquet"
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    replace_committed(o.where("o_orderstatus <> 'P'"), path)
    try:
        replace_committed(o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 1000 != 999, F.col("o_custkey")).otherwise(F.raise_error(F.lit("stopped")))), path)
    except PySparkException as e:
        if "stopped" not in str(e):
            raise
    kept = read_parquet(spark, path)
    n = replace_committed(kept.unionByName(o.where("o_orderstatus = 'P'")), path)
    return read_parquet(spark, path).withColumns({"n_written": F.lit(n).cast("bigint"), "n_before": F.lit(kept.count()).cast("bigint")})


def q_raw_json_nulls(spark, d):
    """Raw JSON with a column that has no value at all: it is still there after standardizing."""
    lake, out_lake = LakeLayout(shared_dir(spark, "lake")), LakeLayout(shared_dir(spark, "lake"))
    o = _orders_text(spark, d).select("o_orderkey", F.lit(None).cast("string").alias("o_note"))
    land_raw(o, lake, "sales", "notes", "20240102")
    status = standardize(spark, lake, "json", "20240102", load_ts=LOAD_TS, target=out_lake).first()
    return read_parquet(spark, status.standardized_path).select("o_orderkey", F.col("o_note").cast("string").alias("o_note"))


def q_map_codes_to_names(spark, d):
    """A number column mapped from codes to names (the rest as text)."""
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"))
    return map_column_values(li, {"line": {1: "first", 2: "second", "x": "none"}})


def q_latest_hot_distinct(spark, d):
    """Latest rows per key where distinct rows tied at one key's maximum hold a third of all rows."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).alias("k"),
                                            F.when(F.col("l_orderkey") % 3 == 0, F.lit("9999-12-31")).otherwise(F.col("l_shipdate").cast("string")).alias("day"))
    return latest_per_group(li, "k", "day").select("k", "l_orderkey", "l_linenumber")


def warm_fixtures(spark: SparkSession, d: str) -> None:
    """Write the files the round-trip queries derive from the tables (once per session)."""
    _land_responses(spark, d)
    _fixture(spark, d, "case_responses", _write_case_responses)
    _land_raw_lake(spark, d)
    _land_standardized(spark, d)


# --- registry --------------------------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "standardize_mixed_json": q_standardize_mixed_json,
    "standardize_csv_headers": q_standardize_csv_headers,
    "duplicate_files": q_duplicate_files,
    "replace_committed": q_replace_committed,
    "raw_json_nulls": q_raw_json_nulls,
    "map_codes_to_names": q_map_codes_to_names,
    "latest_hot_distinct": q_latest_hot_distinct,
    "fact_stalled": fact_stalled,
    "fact_by_unit": fact_by_unit,
    "fact_by_type": fact_by_type,
    "fact_stalled_join_back": fact_stalled_join_back,
    "fact_stalled_window": fact_stalled_window,
    "fact_by_unit_hot_group": fact_by_unit_hot_group,
    "fact_stalled_hot_group": fact_stalled_hot_group,
    "latest_per_group": q_latest_per_group,
    "max_by_group": q_max_by_group,
    "star_left_join": q_star_left_join,
    "semi_join_filter": q_semi_join_filter,
    "anti_join_blocklist": q_anti_join_blocklist,
    "parse_ts": q_parse_ts,
    "days_since": q_days_since,
    "dim_conform": q_dim_conform,
    "col_rename": q_col_rename,
    "col_cast": q_col_cast,
    "col_drop": q_col_drop,
    "map_values": q_map_values,
    "clean_strings": q_clean_strings,
    "audit_columns": q_audit_columns,
    "surrogate_key": q_surrogate_key,
    "schema_conform": q_schema_conform,
    "dedupe_keep_first": q_dedupe_keep_first,
    "distinct_rows": q_distinct_rows,
    "integrity_check": q_integrity_check,
    "null_profile": q_null_profile,
    "table_profile": q_table_profile,
    "union_positional": q_union_positional,
    "union_by_name": q_union_by_name,
    "preview_topn": q_preview_topn,
    "sql_over_views": q_sql_over_views,
    "snapshot_scan": q_snapshot_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "parquet_overwrite": q_parquet_overwrite,
    "xml_flatten": q_xml_flatten,
    "fact_stalled_incremental": fact_stalled_incremental,
    "star_join_bucketed": q_star_join_bucketed,
    "latest_snapshot_indexed": q_latest_snapshot_indexed,
    "max_records_per_file": q_max_records_per_file,
    "xml_split_scan": q_xml_split_scan,
    "ingest_cases": q_ingest_cases,
    "case_types_dim": q_case_types_dim,
    "nested_id_lift": q_nested_id_lift,
    "nested_entity_dim": q_nested_entity_dim,
    "ingest_movements": q_ingest_movements,
    "lake_end_to_end": q_lake_end_to_end,
    "extract_users_dim": q_extract_users_dim,
    "ingest_key_list": q_ingest_key_list,
    "raw_file_selection": q_raw_file_selection,
    "standardize_json": q_standardize_json,
    "standardize_csv": q_standardize_csv,
    "latest_snapshot": q_latest_snapshot,
    "refine_dimension": q_refine_dimension,
    "stream_standardize": q_stream_standardize,
}


# --- oracle SQL (DuckDB) -------------------------------------------------------------------------

_TS = "'%d/%m/%Y %H:%M:%S'"
_CLEAN = "COALESCE(NULLIF(upper(trim({x}, ' ')), ''), 'NÃO INFORMADO')"
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
_ORDERS_TEXT = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
                "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate")
_AUDIT_SQL = ("'2024-01-02 03:04:05.000' AS dt_carga, CAST(1 AS INTEGER) AS etl_versao, "
              "'1900-01-01 00:00:00.000' AS etl_dt_inicio, '2200-01-01 00:00:00.000' AS etl_dt_fim")
_RESPONSES = """
WITH r AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'),
                   l_returnflag, l_linestatus) AS IdAndamento,
         CAST(l_suppkey AS VARCHAR) AS IdUnidade, s_name AS Sigla,
         CAST(l_partkey AS VARCHAR) AS IdUsuario, l_linestatus AS IdTarefa,
         strftime(l_shipdate, '%d/%m/%Y %H:%M:%S') AS DataHora, l_returnflag AS request, l_linenumber
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
allr AS (SELECT * FROM r UNION ALL SELECT * REPLACE ('Z' AS request) FROM r WHERE l_linenumber = 1)
"""

ORACLE_SQL: dict[str, str] = {
    "standardize_mixed_json": _ORDERS_TEXT_SQL.format(more=", CAST(0 AS BIGINT) AS n_corrupt", missing=""),
    "standardize_csv_headers": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderstatus <> 'P' THEN {day} END AS o_orderdate FROM orders""".format(day=_ORDER_DAY),
    "raw_json_nulls": "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_note FROM orders",
    "map_codes_to_names": """
        SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE CAST(l_linenumber AS VARCHAR) END AS line FROM lineitem""",
    "latest_hot_distinct": """
        SELECT k, l_orderkey, l_linenumber FROM (
          SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k,
                 CASE WHEN l_orderkey % 3 = 0 THEN DATE '9999-12-31' ELSE CAST(l_shipdate AS DATE) END AS day FROM lineitem)
        QUALIFY day = max(day) OVER (PARTITION BY k)""",
    "fact_stalled": _FACT_SQL,
    "fact_by_unit": STAR_SQL + _NEWEST + "SELECT s_name AS Setor, count(*) AS qtd FROM placed GROUP BY s_name",
    "fact_by_type": STAR_SQL + _NEWEST + "SELECT c_mktsegment AS tipo, count(*) AS qtd FROM placed GROUP BY c_mktsegment",
    "fact_stalled_join_back": _FACT_SQL,
    "fact_stalled_incremental": _FACT_SQL,
    "max_records_per_file": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_over, true AS enough FROM lineitem",
    "star_join_bucketed": STAR_SQL + """
        SELECT mv.l_orderkey, mv.l_linenumber, mv.l_suppkey, s_name, o_custkey, c_mktsegment
        FROM mv LEFT JOIN cs ON o_orderkey = l_orderkey LEFT JOIN un ON s_suppkey = l_suppkey LEFT JOIN ty ON c_custkey = o_custkey""",
    "latest_snapshot_indexed": f"SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'P'",
    "fact_stalled_window": _FACT_SQL,
    "fact_by_unit_hot_group": _HOT_SQL + _NEWEST.replace("mv.*", "mvh.*").replace("FROM mv ", "FROM mvh ")
        + "SELECT s_name AS Setor, count(*) AS qtd FROM placed GROUP BY s_name",
    "fact_stalled_hot_group": _FACT_SQL.replace(STAR_SQL, _HOT_SQL).replace("mv.*", "mvh.*").replace("FROM mv SEMI", "FROM mvh SEMI"),
    "latest_per_group": """
        SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM (
          SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS rk
          FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL) WHERE rk = 1""",
    "max_by_group": STAR_SQL + f"""
        SELECT l_suppkey, l_orderkey,
               strftime(MAX(try_strptime(event_text, {_TS})), '%Y-%m-%d %H:%M:%S') AS latest
        FROM mv WHERE l_linestatus IN ('F') AND l_orderkey IN (SELECT o_orderkey FROM cs)
        GROUP BY l_suppkey, l_orderkey""",
    "star_left_join": STAR_SQL + """
        SELECT a.l_orderkey, a.l_linenumber, a.l_suppkey, u.s_name, p.o_custkey, tp.c_mktsegment
        FROM mv a LEFT JOIN un u ON u.s_suppkey = a.l_suppkey
        LEFT JOIN cs p ON p.o_orderkey = a.l_orderkey
        LEFT JOIN ty tp ON tp.c_custkey = p.o_custkey""",
    "semi_join_filter": STAR_SQL + """
        SELECT l_orderkey, l_linenumber, l_suppkey FROM mv WHERE l_orderkey IN (SELECT o_orderkey FROM cs)""",
    "anti_join_blocklist": """
        SELECT l_orderkey, l_linenumber FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND o.o_orderkey = l.l_orderkey)""",
    "parse_ts": f"""
        SELECT o_orderkey, event_text,
               strftime(try_strptime(event_text, {_TS}), '%Y-%m-%d %H:%M:%S') AS parsed,
               CAST(try_strptime(event_text, {_TS}) AS DATE) AS parsed_date
        FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'not a date'
                                      WHEN o_orderpriority = '2-HIGH' THEN '31/02/1999 10:00:00'
                                      ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') END AS event_text
              FROM orders)""",
    "days_since": f"""
        SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since
        FROM orders""",
    "dim_conform": f"""
        SELECT p_partkey AS nk_part,
               {_CLEAN.format(x="CASE WHEN p_size = 1 THEN '   ' WHEN p_size = 2 THEN NULL ELSE concat(' ', p_name, ' ') END")} AS p_name,
               TRY_CAST(p_brand AS INTEGER) AS p_brand,
               CASE WHEN t1 = 'SMALL' THEN 'TINY' ELSE t1 END AS part_type,
               CAST(p_size AS BIGINT) AS p_size,
               CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS sk_part
        FROM (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN 'SMALL' ELSE p_type END AS t1 FROM part)""",
    "col_rename": "SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "col_cast": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               c_acctbal, TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment FROM customer""",
    "col_drop": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "map_values": """
        SELECT event_id, CASE WHEN e2 = '1' THEN 'one' ELSE e2 END AS event_type,
               CASE WHEN u1 = 800 THEN 9 ELSE u1 END AS user_id
        FROM (SELECT event_id, CASE WHEN e1 = 'view' THEN 'open' ELSE e1 END AS e2, u1
              FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN 'view' ELSE event_type END AS e1,
                           CASE WHEN user_id = 8 THEN 800 ELSE user_id END AS u1 FROM events))""",
    "clean_strings": f"""
        SELECT c_custkey,
               {_CLEAN.format(x="CASE WHEN c_nationkey = 1 THEN '' WHEN c_nationkey = 2 THEN NULL "
                                "WHEN c_nationkey = 3 THEN '  ab ' WHEN c_nationkey = 4 THEN concat(chr(9), c_name) "
                                "WHEN c_nationkey = 5 THEN 'ação' ELSE lower(c_name) END")} AS c_name,
               {_CLEAN.format(x="CAST(c_nationkey AS VARCHAR)")} AS c_nationkey
        FROM customer""",
    "audit_columns": f"SELECT s_suppkey, s_name, s_nationkey, s_acctbal, {_AUDIT_SQL} FROM supplier",
    "surrogate_key": """
        SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS sk_order
        FROM orders""",
    "schema_conform": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment,
               CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer""",
    "dedupe_keep_first": """
        SELECT event_id, user_id, ts, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "distinct_rows": f"SELECT DISTINCT * FROM (SELECT {_LI_COLS} FROM lineitem UNION ALL SELECT {_LI_COLS} FROM lineitem)",
    "integrity_check": f"""
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
               CAST(sum(n - 1) AS BIGINT) AS n_duplicates, sum(n - 1) = 0 AS ok
        FROM (SELECT {_LI_COLS}, count(*) AS n
              FROM (SELECT {_LI_COLS} FROM lineitem UNION ALL SELECT {_LI_COLS} FROM lineitem WHERE l_linenumber = 1)
              GROUP BY {_LI_COLS})""",
    "null_profile": """
        WITH c AS (
          SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
                 CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey = 2 THEN '' WHEN c_nationkey = 3 THEN 'None'
                      WHEN c_nationkey = 4 THEN 'xNone' WHEN c_nationkey = 5 THEN 'NULL'
                      WHEN c_nationkey = 6 THEN 'NONEXISTENT' WHEN c_nationkey = 7 THEN 'null'
                      ELSE c_name END AS c_name,
                 CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
                 CASE WHEN c_nationkey = 8 THEN NULL ELSE c_mktsegment END AS c_mktsegment
          FROM customer),
        counts AS (
          SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL OR contains(c_custkey, 'None') OR contains(c_custkey, 'NULL') OR c_custkey = '') AS n_null_like FROM c
          UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name IS NULL OR contains(c_name, 'None') OR contains(c_name, 'NULL') OR c_name = '') FROM c
          UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL OR contains(c_nationkey, 'None') OR contains(c_nationkey, 'NULL') OR c_nationkey = '') FROM c
          UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL OR contains(c_acctbal, 'None') OR contains(c_acctbal, 'NULL') OR c_acctbal = '') FROM c
          UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL OR contains(c_mktsegment, 'None') OR contains(c_mktsegment, 'NULL') OR c_mktsegment = '') FROM c)
        SELECT column_name, n_null_like FROM counts WHERE n_null_like > 0""",
    "table_profile": "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem",
    "union_positional": """
        SELECT c_custkey, c_name, c_nationkey FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    "union_by_name": """
        SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
        UNION ALL BY NAME
        SELECT c_custkey AS key, c_name AS name, c_mktsegment AS mktsegment, c_nationkey AS nationkey,
               c_acctbal AS acctbal FROM customer""",
    "preview_topn": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "sql_over_views": """
        SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price
        FROM orders WHERE o_orderdate >= DATE '1997-01-01' GROUP BY o_orderstatus""",
    "snapshot_scan": "SELECT * FROM orders",
    "csv_roundtrip": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "json_roundtrip": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "parquet_overwrite": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""",
    "duplicate_files": """
WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
SELECT 'orders' AS endpoint, 'sales/operacional/orders/20240102/orders_open.csv' AS file,
       count(*) + count(*) FILTER (o_orderkey % 50 = 0) + count(*) FILTER (o_orderkey % 100 = 0) AS n_rows, count(*) AS n_distinct,
       count(*) FILTER (o_orderkey % 50 = 0) + count(*) FILTER (o_orderkey % 100 = 0) AS n_duplicates
FROM f""",
    "replace_committed": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, (SELECT count(*) FROM orders) AS n_written,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS n_before FROM orders""",
    "xml_split_scan": _RESPONSES + """
SELECT IdAndamento, IdUnidade AS Unidade_IdUnidade, Sigla AS Unidade_Sigla, IdUsuario AS Usuario_IdUsuario, IdTarefa, DataHora, request, CAST(NULL AS VARCHAR) AS corrupt FROM allr""",
    "ingest_cases": """
SELECT CAST(o_orderkey AS VARCHAR) AS IdProcedimento, 'C-' || o_orderkey AS ProcedimentoFormatado, CAST(o_custkey AS VARCHAR) AS TipoProcedimento,
       strftime(o_orderdate, '%Y-%m-%d') AS DataAutuacao
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 10 = 0""",
    "case_types_dim": """
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS IdTipoProcedimento, c_mktsegment AS Nome FROM customer JOIN orders ON o_custkey = c_custkey""",
    "xml_flatten": _RESPONSES + """
        SELECT IdAndamento, IdUnidade AS Unidade_IdUnidade, Sigla AS Unidade_Sigla, IdUsuario AS Usuario_IdUsuario,
               IdTarefa, DataHora, request FROM allr""",
    "nested_id_lift": _RESPONSES + "SELECT IdAndamento, IdUnidade AS Unidade, IdUsuario AS Usuario, request FROM allr",
    "nested_entity_dim": _RESPONSES + "SELECT DISTINCT IdUnidade, Sigla FROM r",
    "ingest_movements": _RESPONSES + """
        SELECT DISTINCT IdAndamento, IdUnidade AS Unidade, IdUsuario AS Usuario, IdTarefa, DataHora,
               request AS IdProcedimentoFormatado FROM r""",
    "lake_end_to_end": _RESPONSES + f"""
        SELECT DISTINCT IdAndamento, IdUnidade AS Unidade, IdUsuario AS Usuario, IdTarefa AS task,
               upper(DataHora) AS DataHora, request AS IdProcedimentoFormatado, {_AUDIT_SQL} FROM r""",
    "extract_users_dim": _RESPONSES + "SELECT DISTINCT IdUsuario FROM r",
    "ingest_key_list": _RESPONSES + """
        SELECT DISTINCT IdAndamento, IdUnidade AS Unidade, IdUsuario AS Usuario, IdTarefa, DataHora,
               request AS IdProcedimentoFormatado FROM allr
        WHERE request IN (SELECT l_returnflag FROM lineitem) AND request <> 'N'""",
    "raw_file_selection": f"SELECT {_ORDERS_TEXT}, CAST(1 AS BIGINT) AS n_datasets FROM orders WHERE o_orderstatus = 'O'",
    "standardize_json": f"SELECT {_ORDERS_TEXT}, {_AUDIT_SQL} FROM orders WHERE o_orderstatus = 'O'",
    "standardize_csv": f"SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'P'",
    "latest_snapshot": f"SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'P'",
    "stream_standardize": f"SELECT {_ORDERS_TEXT}, {_AUDIT_SQL} FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')",
    "refine_dimension": f"""
        SELECT o_orderkey AS nk_order, o_custkey,
               CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, {_CLEAN.format(x="o_orderpriority")} AS o_orderpriority,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, {_AUDIT_SQL}
        FROM orders WHERE o_orderstatus = 'P'""",
}
