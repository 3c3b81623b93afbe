"""The two runs: raw files to clean tables, and clean tables to validated ones. Tables are independent Spark jobs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import names
from siltworks.operators import cleaning, dedup, metrics, rules, schema
from siltworks.operators.conditions import resolved
from siltworks.plans.providers import NoRules, RuleProvider
from siltworks.sources import exports, files, sinks
from siltworks.sources.state import StateFile

#: Rows that reports show.
REPORTED = 100
#: Source types whose rows are never compared with each other.
NEVER_DEDUPLICATED = {"api"}
#: Why rows are quarantined.
REASONS = ("invalid_phone", "duplicate")


def clean(df: DataFrame, source_type: str = "source_file", table: str = "", provider: RuleProvider | None = None, snake: bool = False, keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantine with _reason). Expects _row_id; a bad phone is quarantined as a copy, its row stays without it. snake: names become snake case first.

    keep: stores what is used more than once, so that both results come from one search for copies.
    """
    df = schema.flattened(df)
    df = schema.canonical_names(schema.snake_names(df, ("_row_id",)) if snake else df)
    said = (provider or NoRules()).cleaning(table, df)
    df = cleaning.apply_rules(cleaning.standard_nulls(schema.renamed(df, said.renames)), said)
    phones = names.phone_columns(schema.data_columns(df), said.phones)
    df = cleaning.epoch_texts(cleaning.normal_phones(df, phones), names.epoch_columns(df.columns, said.epochs))
    raw = [f"_raw_{c}" for c in phones]
    keys = [k for k in said.keys if k in df.columns] or schema.data_columns(df)
    bad = df.where(F.size("_bad_phones") > 0).select(*(F.col(f"_raw_{c}").alias(c) if c in phones else schema.quoted(c) for c in df.columns if c not in (*raw, "_bad_phones")), F.lit("invalid_phone").alias("_reason"))
    plain = df.drop(*raw, "_bad_phones")
    if source_type in NEVER_DEDUPLICATED:
        return plain, bad
    told = dedup.with_copies(plain, keys, ["_row_id"], keep)
    told = keep(told) if keep else told
    again = told.where("_is_copy").drop("_is_copy").withColumn("_reason", F.lit("duplicate"))
    return told.where("not _is_copy").drop("_is_copy"), bad.unionByName(again)


def clean_group(spark: SparkSession, source: files.Source, paths: list[str], out: str, at: str, provider: RuleProvider | None) -> dict:
    """One group's tables and report; _row_id stays, as the order of the files' rows. Rows are counted while they are written. Names of CSV files stay as they are written, others become snake case."""
    held: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        return held[-1]

    try:
        raw = keep(files.with_row_id(files.read(spark, source, paths)))
        kept, quarantine = clean(raw, source.type, source.table, provider, source.format != "csv", keep)
        path = f"{out}/tables/{source.key}/processed_{at}"
        rows, bad = Observation(), Observation()
        sinks.write_table(schema.with_source(kept, source.type, source.name, source.table, source.db, at).observe(rows, F.count(F.lit(1)).alias("n")), path)
        sinks.write_quarantine(quarantine.drop("_row_id").observe(bad, *(F.count_if(F.col("_reason") == r).alias(r) for r in REASONS)), f"{out}/quarantine/{source.key}/quarantine_{at}")
        reasons = {r: n for r, n in bad.get.items() if n}
        written = spark.read.parquet(path)
        facts = {"rows_input": raw.count(), "rows_output": rows.get["n"], "rows_quarantined": sum(reasons.values()), "reasons": reasons, "path": path}
    finally:
        for df in reversed(held):
            df.unpersist()
    types = {f.name: f.dataType.simpleString() for f in written.schema}
    sinks.write_document(spark, f"{out}/reports/{source.key}/report_{at}.json", facts | {"table": source.table, "columns": written.columns, "types": types, "sample": sinks.sample_rows(written, REPORTED, "_row_id")})
    return facts


def content_hashes(spark: SparkSession, root: str, groups: dict[files.Source, list[str]]) -> tuple[dict[str, str], dict[str, str]]:
    """(hashes, errors) by group: all groups in one job; only if that fails group by group, so that one that can't be read ends no run."""
    try:
        return {r["group_key"]: r["hash"] for r in files.manifest(spark, root, groups).collect()}, {}
    except Exception:
        hashes, errors = {}, {}
        for source, paths in groups.items():
            try:
                hashes |= {r["group_key"]: r["hash"] for r in files.manifest(spark, root, {source: paths}).collect()}
            except Exception as e:  # reported as a failure of the group
                errors[source.key] = f"{type(e).__name__}: {str(e)[:500]}"
        return hashes, errors


def clean_gauges(spark: SparkSession, done: list[dict]) -> DataFrame:
    """line: six gauges for each group of a run, also of those that failed."""
    rows = [(d["table_name"], d["source_type"], *(float(x) for x in (d["rows_input"], d["rows_output"], d["rows_quarantined"], d["duration_seconds"], d["success"], d["ended"]))) for d in done]
    names_ = ["rows_input_total", "rows_output_total", "rows_quarantined_total", "processing_duration_seconds", "success", "last_run_timestamp_seconds"]
    frame = spark.createDataFrame(rows, "table string, source_type string, " + ", ".join(f"clean_{n} double" for n in names_))
    long = frame.unpivot(["table", "source_type"], [f"clean_{n}" for n in names_], "name", "value")
    return exports.prometheus_lines(long, "name", "value", ["table", "source_type"])


def chosen(source_key: str, table: str, db: str | None, only: set[str] | None, dbs: set[str] | None) -> bool:
    """Whether a run takes a group: by its key or table, and by its database."""
    return (not only or source_key in only or table in only) and (not dbs or db in dbs)


def run_clean(spark: SparkSession, root: str, out: str, provider: RuleProvider | None = None, only: set[str] | None = None, force: bool = False, dbs: set[str] | None = None) -> list[dict]:
    """Cleans each changed group below root. A group that fails is reported and tried again in the next run; each group that succeeds is committed to the state."""
    groups = files.discover(files.list_files(spark, root))
    state = StateFile(spark, f"{out}/state.json")
    known, done = state.read().get("hashes", {}), []
    hashes, errors = content_hashes(spark, root, groups)
    at = datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
    for source, paths in groups.items():
        if not chosen(source.key, source.table, source.db, only, dbs) or not force and source.key in hashes and known.get(source.key) == hashes[source.key]:
            continue
        facts = {"event": "clean", "timestamp": at, "group_key": source.key, "table_name": source.table, "source_type": source.type}
        began = time.monotonic()
        try:
            if source.key in errors:
                raise RuntimeError(errors[source.key])
            facts |= clean_group(spark, source, [f"{root}/{p}" for p in paths], out, at, provider) | {"success": True}
            output = {"path": facts["path"], "type": source.type, "table": source.table, "db": source.db}
            state.update(lambda s, k=source.key, o=output: s | {"hashes": s.get("hashes", {}) | {k: hashes[k]}, "outputs": s.get("outputs", {}) | {k: o}, "last_run": at})
        except Exception as e:  # whatever a group's files do, the other groups go on
            facts |= {"rows_input": 0, "rows_output": 0, "rows_quarantined": 0, "reasons": {}, "success": False, "error": f"{type(e).__name__}: {str(e)[:500]}"}
        facts |= {"duration_seconds": round(time.monotonic() - began, 3), "ended": int(time.time())}
        sinks.append_line(spark, f"{out}/logs", f"{at}_{source.key.replace('/', '_')}", "METRICS: " + json.dumps({k: v for k, v in facts.items() if k not in ("reasons", "path", "ended")}, ensure_ascii=False))
        done.append(facts)
    here = {s.key for s in groups}
    state.update(lambda s: s | {"hashes": {k: v for k, v in s.get("hashes", {}).items() if k in here}, "outputs": s.get("outputs", {}), "last_run": at})
    if done:
        sinks.write_lines(clean_gauges(spark, done), f"{out}/metrics/{at}")
    return done


def validate(df: DataFrame, table: str, provider: RuleProvider | None = None, as_of: date | None = None, order: list | None = None) -> DataFrame:
    provider = provider or NoRules()
    active, mapping = provider.business(table, df)
    own = provider.conditions(table) if hasattr(provider, "conditions") else []
    return rules.validated(rules.repaired(rules.ground_truth(df)), table, active, as_of, mapping, order, own)


def wrong_conditions(df: DataFrame, table: str, provider: RuleProvider | None) -> list[dict]:
    """The conditions of a table's rule document that validate() leaves out, and why."""
    return resolved(rules.repaired(rules.ground_truth(df)), provider.conditions(table))[2] if hasattr(provider, "conditions") else []


def validate_table(spark: SparkSession, key: str, known: dict, out: str, at: str, provider: RuleProvider | None, as_of: date | None) -> dict:
    """One table's valid and quarantined rows, and its report: counts, rules, grade, alerts, samples of both sides."""
    df = spark.read.parquet(known["path"])
    order = [F.col("_row_id")] if "_row_id" in df.columns else None
    checked = validate(df, known["table"], provider, as_of, order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = rules.split(checked)
        sinks.write_table(good, f"{out}/validated/{key}/processed_{at}")
        sinks.write_table(bad, f"{out}/quarantine/{key}/processed_{at}")
        facts = {"rule_errors": wrong_conditions(df, known["table"], provider)}
        facts |= metrics.row_counts(checked).first().asDict() | metrics.by_severity(checked).first().asDict()
        facts |= {"completeness": metrics.average_completeness(checked).first()["average"], "rules": {r["rule_id"]: r["n"] for r in metrics.by_rule(checked).collect()}}
        facts |= {"domains": {r["domain"]: r["n"] for r in metrics.by_domain(checked).collect()}}
        if "_ground_truth" in checked.columns:
            facts |= metrics.precision_recall(metrics.confusion(checked, F.col("_ground_truth"), F.col("_is_quarantined"))).first().asDict()
        rates = spark.createDataFrame([(float(facts["quarantine_rate"] or 0), float(facts["completeness"] or 0), facts.get("recall"))], "quarantine_rate double, completeness double, recall double")
        facts["alerts"] = metrics.alerts(rates).first()["alerts"]
        by = [] if order is None else ["_row_id"]
        shown = {"sample": sinks.sample_rows(good, REPORTED, *by), "quarantine_sample": sinks.sample_rows(bad, REPORTED, *by)}
    finally:
        checked.unpersist()
    sinks.write_document(spark, f"{out}/reports/tables/{key.replace('/', '_')}_{at}/report.json", {"key": key, "table": known["table"]} | facts)
    sinks.write_document(spark, f"{out}/samples/{key}/samples_{at}.json", shown)
    return facts


def run_validate(spark: SparkSession, clean_out: str, out: str, provider: RuleProvider | None = None, as_of: date | None = None, only: set[str] | None = None, force: bool = False, dbs: set[str] | None = None) -> list[dict]:
    """Validates each table whose latest clean run isn't the one done."""
    tables = sinks.load_state(spark, f"{clean_out}/state.json").get("outputs", {})
    kept = StateFile(spark, f"{out}/state.json")
    state = kept.read()
    at, results = datetime.now(UTC).strftime("%Y%m%d_%H%M%S"), []
    failed: list[dict] = []
    for key, known in tables.items():
        if not chosen(key, known["table"], known.get("db"), only, dbs) or not force and state.get(key) == known["path"]:
            continue
        try:
            results.append({"key": key, "table": known["table"]} | validate_table(spark, key, known, out, at, provider, as_of))
        except Exception as e:  # the other tables go on, this one is tried again
            failed.append({"key": key, "table": known["table"], "success": False, "error": f"{type(e).__name__}: {str(e)[:500]}"})
            continue
        kept.update(lambda s, k=key, p=known["path"]: s | {k: p})
    if results:
        measures = ("total", "valid", "quarantined", "validity_rate", "quarantine_rate", "completeness", "critical", "major", "warning")
        frame = spark.createDataFrame([(r["table"], f"validated_{m}", float(r[m] or 0)) for r in results for m in measures], "table string, name string, value double")
        sinks.write_lines(exports.prometheus_lines(frame, "name", "value", ["table"]), f"{out}/metrics/{at}")
        totals = spark.createDataFrame([(int(r["total"]), int(r["valid"]), int(r["quarantined"]), r.get("precision"), r.get("recall"), r.get("f1")) for r in results], "total long, valid long, quarantined long, precision double, recall double, f1 double")
        sinks.write_json(metrics.global_report(totals), f"{out}/reports/global_{at}")
    return results + failed
