"""Layer steps as Spark jobs: ``spark-submit --py-files lakestrata.zip lakestrata/__main__.py
<step> ...`` on a cluster, or ``python -m lakestrata <step> ...`` locally.

    standardize  --root R --type json|csv --date yyyyMMdd [--area A] [--format parquet|delta]
    refine-dim   --root R --area A --endpoint E --table T [--spec spec.json]
    facts        --root R --movements A:T --units A:T --cases A:T --case-types A:T --out-area A
                 [--as-of yyyy-mm-dd]
    publish      --root R --area A --table T --url JDBC_URL [--mode overwrite|append]
                 [--schema dw] [--prop key=value ...]

The session comes from the cluster (``getOrCreate``); nothing here sets a master or memory.
A transform spec file is JSON with the keys of ``ConformSpec`` (rename, cast, drop,
map_values, clean_strings, surrogate_key, surrogate_order).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from lakestrata.operators.transforms import ConformSpec
from lakestrata.plans.layers import publish_to_warehouse, refine_dimension, refine_stalled_facts, standardize
from lakestrata.sources.layout import LakeLayout


def _pair(text: str) -> tuple[str, str]:
    area, _, table = text.partition(":")
    if not area or not table:
        raise argparse.ArgumentTypeError(f"expected AREA:TABLE, got {text!r}")
    return area, table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakestrata")
    sub = p.add_subparsers(dest="step", required=True)

    s = sub.add_parser("standardize")
    s.add_argument("--root", required=True)
    s.add_argument("--type", required=True, choices=["csv", "json"])
    s.add_argument("--date", required=True)
    s.add_argument("--area")
    s.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    s.add_argument("--no-integrity", action="store_true")

    r = sub.add_parser("refine-dim")
    r.add_argument("--root", required=True)
    r.add_argument("--area", required=True)
    r.add_argument("--endpoint", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--spec")

    f = sub.add_parser("facts")
    f.add_argument("--root", required=True)
    for role in ("movements", "units", "cases", "case-types"):
        f.add_argument(f"--{role}", required=True, type=_pair)
    f.add_argument("--out-area", required=True)
    f.add_argument("--as-of")

    w = sub.add_parser("publish")
    w.add_argument("--root", required=True)
    w.add_argument("--area", required=True)
    w.add_argument("--table", required=True)
    w.add_argument("--url", required=True)
    w.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    w.add_argument("--schema", default="dw")
    w.add_argument("--prop", action="append", default=[])
    return p


def _spec(path: str | None) -> ConformSpec | None:
    if not path:
        return None
    with open(path, encoding="utf-8") as fh:
        return ConformSpec(**json.load(fh))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    lake = LakeLayout(args.root)
    if args.step == "standardize":
        status = standardize(spark, lake, args.type, args.date, args.area,
                             check_integrity=not args.no_integrity, output_format=args.format)
        rows = status.collect()  # one row per table of the day
        for r in rows:
            print(json.dumps(r.asDict(), default=str, ensure_ascii=False))
        return 0 if all(r.error is None for r in rows) else 1
    if args.step == "refine-dim":
        print(refine_dimension(spark, lake, args.area, args.endpoint, args.table, _spec(args.spec)))
        return 0
    if args.step == "facts":
        dims = {"movements": args.movements, "units": args.units, "cases": args.cases,
                "case_types": args.case_types}
        paths = refine_stalled_facts(spark, lake, dims, args.out_area, as_of=args.as_of)
        print(json.dumps(paths))
        return 0
    if args.step == "publish":
        props = dict(p.split("=", 1) for p in args.prop)
        publish_to_warehouse(spark, lake, args.area, args.table, args.url, args.mode, args.schema, props)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
