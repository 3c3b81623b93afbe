"""Queries of readers, sinks, runs and streams: a given table is written in a source's form to the shared scratch folder and read back by the operator."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import dedup, rules, sketches
from siltworks.plans import pipeline, registry
from siltworks.plans.providers import DocumentRules
from siltworks.plans.registry import AS_OF, dirty, query, table, with_input
from siltworks.sources import exports, files, fingerprints, sinks
from siltworks.sources.scratch import scratch_folder
from siltworks.sources.state import StateFile
from siltworks.streaming import incremental, live


def paths_of(spark: SparkSession, root: str, ext: str) -> list[str]:
    """The files below a folder that a reader is given."""
    return [f"{root}/{p}" for p in files.list_files(spark, root) if p.endswith(ext)]


# --- readers ----------------------------------------------------------------------------------------------------------
@query("csv_scan", "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    """Files of two headers in one group: other order, one column more."""
    df, root = table(spark, sf_dir, "customer"), scratch_folder(spark)
    df.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_nationkey").write.csv(f"{root}/a", header=True)
    df.where("c_custkey % 2 = 1").select("c_nationkey", "c_mktsegment", "c_custkey", "c_name").write.csv(f"{root}/b", header=True)
    return files.read_csv(spark, paths_of(spark, root, ".csv")).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]
ORDER_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM orders"


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def order_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some thousand rows together, as a database's dump has them."""
    rows = order_rows(spark, sf_dir)
    return rows.groupBy(F.expr("o_orderkey div 4000").alias("part")).agg(F.collect_list(F.struct(*ORDER_COLUMNS)).alias("rows"))


@query("json_lines_scan", ORDER_SQL)
def json_lines_scan(spark, sf_dir):
    root = scratch_folder(spark)
    order_rows(spark, sf_dir).write.json(root)
    return files.read_json(spark, paths_of(spark, root, ".json")).select(*ORDER_COLUMNS)


@query("json_array_scan", ORDER_SQL)
def json_array_scan(spark, sf_dir):
    """Arrays of objects that run over lines."""
    root = scratch_folder(spark)
    said = F.concat(F.lit("[\n"), F.array_join(F.transform("rows", lambda r: F.to_json(r)), ",\n"), F.lit("\n]"))
    order_groups(spark, sf_dir).select("part", said.alias("value")).write.partitionBy("part").text(root)
    return files.read_json(spark, paths_of(spark, root, ".txt")).select(*ORDER_COLUMNS)


@query("db_rows_scan", ORDER_SQL)
def db_rows_scan(spark, sf_dir):
    root = scratch_folder(spark)
    order_groups(spark, sf_dir).select("rows").write.json(root)
    return files.read_rows(spark, paths_of(spark, root, ".json")).select(*ORDER_COLUMNS)


@query("db_wrapped_scan", ORDER_SQL)
def db_wrapped_scan(spark, sf_dir):
    root = scratch_folder(spark)
    rest = F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))
    order_groups(spark, sf_dir).select(F.get("rows", F.lit(0)).alias("first"), rest.alias("rest"), F.size("rows").alias("n"), F.lit("x").alias("name")).write.json(root)
    return files.read_wrapped(spark, paths_of(spark, root, ".json")).select(*ORDER_COLUMNS)


@query("xml_scan", "SELECT s_suppkey::VARCHAR AS key, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT c_custkey::VARCHAR, c_name, c_mktsegment FROM customer")
def xml_scan(spark, sf_dir):
    """Roots whose children have two tags, one in each file."""
    root = scratch_folder(spark)
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).write.options(rootTag="all", rowTag="supplier").xml(f"{root}/a")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).write.options(rootTag="all", rowTag="customer").xml(f"{root}/b")
    return files.read_xml(spark, paths_of(spark, root, ".xml")).select("key", "name", "segment")


@query("fingerprint_lines", "SELECT count(*) AS n, true AS same FROM orders")
def fingerprint_lines(spark, sf_dir):
    """Two copies of a table's text under other names: their fingerprints hold all lines, and are the same."""
    root = scratch_folder(spark)
    lines = table(spark, sf_dir, "orders").select(F.concat_ws("|", *(F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "o_comment") if c in table(spark, sf_dir, "orders").columns)).alias("value"))
    for name in "ab":
        lines.write.text(f"{root}/{name}")
    found = {n: fingerprints.fingerprints(spark, paths_of(spark, f"{root}/{n}", ".txt")) for n in "ab"}
    both = found["a"].select("digest", F.col("lines").alias("n"), F.lit(1).alias("of")).unionByName(found["b"].select("digest", F.col("lines").alias("n"), F.lit(-1).alias("of")))
    by_digest = both.groupBy("digest").agg(F.sum("of").alias("left"), F.sum(F.when(F.col("of") > 0, F.col("n"))).alias("n"))
    return by_digest.agg(F.sum("n").alias("n"), F.every(F.col("left") == 0).alias("same"))


# --- sinks ------------------------------------------------------------------------------------------------------------
@query("quarantine_sink", "SELECT doc_id, 'duplicate' AS _reason FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1")
def quarantine_sink(spark, sf_dir):
    bad = dedup.copies(table(spark, sf_dir, "documents").select("text", "doc_id"), ["text"], ["doc_id"])
    return spark.read.schema("doc_id bigint, _reason string").json(sinks.write_quarantine(bad.select("doc_id", "_reason"), scratch_folder(spark)))


@query("state_versions", "SELECT lang AS key, count(*) AS n, 3::BIGINT AS version FROM documents GROUP BY 1")
def state_versions(spark, sf_dir):
    """Counts by language in a state, of which two writers each add a part; the second one finds the first one's."""
    path = f"{scratch_folder(spark)}/state.json"
    sinks.save_state(spark, path, {})
    for part in (0, 1):
        n = {r["lang"]: r["n"] for r in table(spark, sf_dir, "documents").where(F.col("doc_id") % 2 == part).groupBy("lang").agg(F.count("*").alias("n")).collect()}
        StateFile(spark, path).update(lambda s, n=n: {k: s.get(k, 0) + n.get(k, 0) for k in {*s, *n}})
    state = StateFile(spark, path)
    return spark.createDataFrame([(k, n) for k, n in state.read().items()], "key string, n bigint").withColumn("version", F.lit(state.version).cast("bigint"))


# --- runs -------------------------------------------------------------------------------------------------------------
RULES = {"transactions": {"business": {"applicable_rules": [{"rule_id": r} for r in ("BNK-003", "BNK-010", "GEN-009")], "custom_rules": [{"rule_id": "OWN-1", "condition": "priority LIKE '1%' AND amount > 400000", "severity": "WARNING"}, {"rule_id": "OWN-2", "condition": "no_column = 1"}]}}}
KEY = "db_rows/transactions-bancaires/transactions"


@cache
def runs(spark: SparkSession, sf_dir: str) -> tuple[str, str, list[dict], list[dict]]:
    """(clean output, validated output, what a second clean and a second validate run did) of a raw folder made from orders, of which every tenth row stands twice. Once in a session."""
    root = scratch_folder(spark)
    raw, clean, gold = f"{root}/raw", f"{root}/clean", f"{root}/gold"
    rows = dirty(spark, sf_dir, "orders")
    rows.unionByName(rows.where("id % 10 = 0")).write.json(f"{raw}/transactions-bancaires/transactions")
    provider = DocumentRules(RULES)
    pipeline.run_clean(spark, raw, clean, provider)
    pipeline.run_validate(spark, clean, gold, provider, as_of=AS_OF)
    return clean, gold, pipeline.run_clean(spark, raw, clean, provider), pipeline.run_validate(spark, clean, gold, provider, as_of=AS_OF)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(sinks.load_state(spark, f"{runs(spark, sf_dir)[0]}/state.json")["outputs"][KEY]["path"])


def newest(spark: SparkSession, root: str) -> list[str]:
    return [f"{root}/{p}" for p in files.list_files(spark, root) if not p.rsplit("/", 1)[-1].startswith(("_", "."))]


COUNTS = "count(*) + count(*) FILTER (o_orderkey % 10 = 0) AS rows_input, count(*) AS rows_output, count(*) FILTER (o_orderkey % 10 = 0) AS rows_quarantined"
JUDGED = """, c AS (SELECT *, amount <= 0 OR amount > 500000 OR transaction_date > '2000-01-01' AS bad FROM i)"""


@query("run_clean_table", with_input("orders", "SELECT id, amount::DOUBLE AS amount, priority, 'transactions' AS _table_name FROM i"))
def run_clean_table(spark, sf_dir):
    return cleaned(spark, sf_dir).select("id", F.col("amount").cast("double").alias("amount"), "priority", "_table_name")


@query("run_clean_report", f"SELECT {COUNTS}, 'bigint' AS id_type FROM orders")
def run_clean_report(spark, sf_dir):
    report = spark.read.json(newest(spark, f"{runs(spark, sf_dir)[0]}/reports"))
    return report.select("rows_input", "rows_output", "rows_quarantined", F.col("types.id").alias("id_type"))


@query("run_clean_quarantine", "SELECT o_orderkey AS id, 'duplicate' AS _reason FROM orders WHERE o_orderkey % 10 = 0")
def run_clean_quarantine(spark, sf_dir):
    root = f"{runs(spark, sf_dir)[0]}/quarantine/{KEY}/*"
    return spark.read.schema("id bigint").option("basePath", f"{runs(spark, sf_dir)[0]}/quarantine").json(root).select("id", F.regexp_extract("_metadata.file_path", "_reason=([a-z_]+)", 1).alias("_reason"))


@query("run_clean_events", f"SELECT 'transactions' AS table_name, true AS success, {COUNTS} FROM orders")
def run_clean_events(spark, sf_dir):
    return exports.metric_events(spark.read.text(f"{runs(spark, sf_dir)[0]}/logs")).select("table_name", "success", "rows_input", "rows_output", "rows_quarantined")


@query("run_clean_gauges", f"""WITH n AS (SELECT {COUNTS} FROM orders) SELECT 'clean_rows_input_total' AS name, rows_input::DOUBLE AS metric FROM n UNION ALL SELECT 'clean_rows_output_total', rows_output FROM n
    UNION ALL SELECT 'clean_rows_quarantined_total', rows_quarantined FROM n UNION ALL SELECT 'clean_success', 1""")
def run_clean_gauges(spark, sf_dir):
    """Four of a group's six gauges; the other two are times."""
    lines = exports.parsed_prometheus(spark.read.text(f"{runs(spark, sf_dir)[0]}/metrics/*"))
    return lines.where(~F.col("name").rlike("seconds")).select("name", "metric")


@query("run_again", f"SELECT '{KEY}' AS key, 0::BIGINT AS cleaned_again, 0::BIGINT AS validated_again, count(*) > 0 AS any_rows FROM orders")
def run_again(spark, sf_dir):
    """The states of both runs, and how much a second run does: nothing has changed."""
    clean, gold, again, more = runs(spark, sf_dir)
    keys = {*sinks.load_state(spark, f"{clean}/state.json")["hashes"]} & {*sinks.load_state(spark, f"{gold}/state.json")}
    return spark.createDataFrame([(k, len(again), len(more)) for k in keys], "key string, cleaned_again bigint, validated_again bigint").crossJoin(cleaned(spark, sf_dir).agg((F.count("*") > 0).alias("any_rows")))


@query("run_validate_table", with_input("orders", "SELECT id FROM c WHERE NOT bad", JUDGED))
def run_validate_table(spark, sf_dir):
    return spark.read.parquet(f"{runs(spark, sf_dir)[1]}/validated/{KEY}/*").select("id")


@query("run_validate_quarantine", with_input("orders", "SELECT id FROM c WHERE bad", JUDGED))
def run_validate_quarantine(spark, sf_dir):
    return spark.read.parquet(f"{runs(spark, sf_dir)[1]}/quarantine/{KEY}/*").select("id")


@query("run_validate_report", with_input("orders", """SELECT count(*) AS total, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (bad) AS quarantined, count(*) FILTER (amount <= 0) AS bnk003, count(*) FILTER (amount > 500000) AS bnk010,
    count(*) FILTER (transaction_date > '2000-01-01') AS gen009, count(*) FILTER (priority LIKE '1%' AND amount > 400000) AS own1, 'OWN-2' AS wrong FROM c""", JUDGED))
def run_validate_report(spark, sf_dir):
    rules_ = "rules struct<`BNK-003`:bigint,`BNK-010`:bigint,`GEN-009`:bigint,`OWN-1`:bigint>, rule_errors array<struct<rule_id:string,error:string>>"
    report = spark.read.schema(f"total bigint, valid bigint, quarantined bigint, {rules_}").json(f"{runs(spark, sf_dir)[1]}/reports/tables/*")
    n = lambda r: F.coalesce(F.col(f"rules.`{r}`"), F.lit(0))
    return report.select("total", "valid", "quarantined", n("BNK-003").alias("bnk003"), n("BNK-010").alias("bnk010"), n("GEN-009").alias("gen009"), n("OWN-1").alias("own1"), F.col("rule_errors")[0]["rule_id"].alias("wrong"))


@query("run_validate_global", with_input("orders", "SELECT 1::BIGINT AS tables, count(*) AS total_rows, count(*) FILTER (NOT bad) AS valid_rows, count(*) FILTER (bad) AS quarantined_rows FROM c", JUDGED))
def run_validate_global(spark, sf_dir):
    root = f"{runs(spark, sf_dir)[1]}/reports"
    return spark.read.json([p for p in newest(spark, root) if p.startswith(f"{root}/global_")]).select("tables", "total_rows", "valid_rows", "quarantined_rows")


EXPORTED = """SELECT '{0}_total' AS name, count(*)::DOUBLE AS metric FROM c UNION ALL SELECT '{0}_valid', count(*) FILTER (NOT bad) FROM c UNION ALL SELECT '{0}_quarantined', count(*) FILTER (bad) FROM c"""


@query("run_validate_gauges", with_input("orders", EXPORTED.format("validated"), JUDGED))
def run_validate_gauges(spark, sf_dir):
    lines = exports.parsed_prometheus(spark.read.text(f"{runs(spark, sf_dir)[1]}/metrics/*"))
    return lines.where(F.col("name").isin("validated_total", "validated_valid", "validated_quarantined")).select("name", "metric")


@query("exporter_gauges", with_input("orders", EXPORTED.format("validated_last") + " UNION ALL SELECT 'clean_last_rows_out', count(*) FROM c", JUDGED))
def exporter_gauges(spark, sf_dir):
    """Gauges of the newest reports and the last run's event lines."""
    lines = exports.gauges(spark, *runs(spark, sf_dir)[:2]).withColumnRenamed("line", "value")
    return exports.parsed_prometheus(lines).where(F.col("name").isin("validated_last_total", "validated_last_valid", "validated_last_quarantined", "clean_last_rows_out")).select("name", "metric")


@query("ground_truth_column", "SELECT doc_id, n_chars > 100 AS _ground_truth FROM documents")
def ground_truth_column(spark, sf_dir):
    return rules.ground_truth(table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 100).alias("Ground_Truth")))


# --- profiles and streams ---------------------------------------------------------------------------------------------
@query("merged_profiles", " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count({c}) AS filled, {lo} AS min, {hi} AS max, max(length({c}::VARCHAR))::BIGINT AS max_length FROM orders" for c, t, lo, hi in (("o_orderkey", "bigint", "min(o_orderkey)::DOUBLE", "max(o_orderkey)::DOUBLE"), ("o_custkey", "bigint", "min(o_custkey)::DOUBLE", "max(o_custkey)::DOUBLE"), ("o_orderstatus", "string", "NULL::DOUBLE", "NULL::DOUBLE"))))
def merged_profiles(spark, sf_dir):
    """The exact parts of profiles of two runs, stored and merged without reading rows again."""
    df, root = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), scratch_folder(spark)
    for run in (0, 1):
        sketches.column_sketches(df.where(F.col("o_orderkey") % 2 == run), f"run{run}").write.parquet(f"{root}/{run}")
    both = sketches.merged(spark.read.parquet(f"{root}/*"))
    return both.select("column_name", F.array_join("data_types", ",").alias("data_type"), "rows", "filled", "min", "max", "max_length")


@query("stream_polled", with_input("orders", "SELECT id, bad AS quarantined FROM c", JUDGED))
def stream_polled(spark, sf_dir):
    """Files validated as they come, polled three times: what was seen is not read again."""
    root = scratch_folder(spark)
    rows = dirty(spark, sf_dir, "orders")

    def each(batch: DataFrame, _: int) -> None:
        done = incremental.stream_validated(batch, "transactions", {"BNK-003", "BNK-010", "GEN-009"}, AS_OF)
        done.select("id", F.col("_is_quarantined").alias("quarantined")).write.mode("append").parquet(f"{root}/out")

    for part in (0, 1, None):
        if part is not None:
            rows.where(F.col("id") % 2 == part).write.mode("append").parquet(f"{root}/in")
        incremental.follow(spark, rows.schema, f"{root}/in", f"{root}/state", each).awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("live_totals", with_input("orders", "SELECT count(*) AS total, count(*) FILTER (bad) AS quarantined, count(*) FILTER (bad AND NOT coalesce(amount <= 0, false)) AS major, count(*) FILTER (amount <= 0) AS critical FROM c", JUDGED))
def live_totals(spark, sf_dir):
    """Counts that come with the write of a validated table, without a job of their own."""
    checked = rules.validated(dirty(spark, sf_dir, "orders"), "transactions", {"BNK-003", "BNK-010", "GEN-009"}, AS_OF)
    counted, seen = live.observed(checked)
    counted.select("id", "_is_quarantined").write.parquet(scratch_folder(spark))
    return spark.createDataFrame([tuple(seen.get[c] for c in ("total", "quarantined", "major", "critical"))], "total bigint, quarantined bigint, major bigint, critical bigint")


QUERIES, ORACLE_SQL = registry.QUERIES, registry.ORACLE_SQL
