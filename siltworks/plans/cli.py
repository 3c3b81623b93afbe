"""python -m siltworks.plans.cli clean|validate|list|status|export ROOT OUT [--only NAME ...] [--db NAME ...] [--force] [--rules FILE] [--as-of DAY]"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from siltworks.plans.pipeline import run_clean, run_validate
from siltworks.plans.providers import DocumentRules, HeuristicRules
from siltworks.sources import exports, files, sinks


def main(args: list[str] | None = None) -> list:
    p = argparse.ArgumentParser(prog="siltworks", description=__doc__)
    p.add_argument("what", choices=["clean", "validate", "list", "status", "export"])
    p.add_argument("root")
    p.add_argument("out")
    p.add_argument("--only", nargs="*", default=[])
    p.add_argument("--db", nargs="*", default=[], help="databases whose tables are taken")
    p.add_argument("--force", action="store_true")
    p.add_argument("--rules", help="a JSON document of rules; by default rules come from the columns")
    p.add_argument("--as-of", type=date.fromisoformat, help="the day that counts as today")
    a = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.what == "list":
        said = [{"group": s.key, "files": ps} for s, ps in files.discover(files.list_files(spark, a.root)).items()]
    elif a.what == "status":
        said = [sinks.load_state(spark, f"{a.out}/state.json")]
    elif a.what == "export":
        said = [r["line"] for r in exports.gauges(spark, a.root, a.out).collect()]
    else:
        provider = DocumentRules("\n".join(r[0] for r in spark.read.text(a.rules).collect())) if a.rules else HeuristicRules()
        days = {"as_of": a.as_of} if a.what == "validate" else {}
        said = (run_clean if a.what == "clean" else run_validate)(spark, a.root, a.out, provider, only={*a.only} or None, dbs={*a.db} or None, force=a.force, **days)
    for x in said:
        print(json.dumps(x, default=str, ensure_ascii=False))
    return said


if __name__ == "__main__":
    main()
