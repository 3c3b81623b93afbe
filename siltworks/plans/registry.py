"""Named queries over the driver's tables, and the SQL that gives the same rows.

The tables are clean, so most queries first derive dirty text from keys, by SQL that Spark and other engines read alike
(INPUTS), and apply an operator of this library to it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.functions import fixed, names
from siltworks.operators import changes, cleaning, dedup, metrics, profile, rules, schema
from siltworks.sources import exports

AS_OF = date(2000, 1, 1)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


PHONES = ["'+216 20 123 456'", "'00216-31.234.567'", "'21650123456'", "'0 50 123 456'", "'(55) 123/456'", "'ABCDEFGH'", "'2012345'", "'00000000'", "'81234567'", "NULL", "'98 765 432'"]
NUMBERS = ["'$1,061.50'", "'2350.25€'", "' 86 832.16 '", "'221135 TND'", "'61,011'", "'-3.5'", "'.5'", "'1e3'", "'5d'", "'14.0'", "'ZERO'", "''"]
DATES = ["'1999-03-14'", "'14/03/1999'", "'08/12/89'", "'08/12/21'", "'31-01-2001'", "'12/25/1998'", "'1987'", "'19990314'", "'1999/03/14'", "'1995-05'", "'August 3, 1996'", "'99-1-1'", "'31/02/2001'", "'?'"]
NULLS = ["' N/A '", "'null'", "'-'", "'Unknown'", "'#NA'", "'ok'", "'  '", "'Not Available'", "'nd'", "'0'", "'none of it'"]
STATUS = ["'Actif'", "' CLOTURE '", "'remboursé'", "'1'", "'closed'", "'en_cours'", "NULL"]

#: Inputs by name: a table and a query that gives dirty text. {t} is the table.
INPUTS = {
    "customers": ("customer", f"""SELECT c_custkey AS id, {cases('c_custkey', NULLS)} AS note, {cases('c_custkey', PHONES)} AS phone, {cases('c_custkey', NUMBERS)} AS amount_text, {cases('c_custkey', DATES)} AS born_text,
        {cases('c_custkey', ["'1975-05-01'", "'1990-06-15'", "'1880-01-01'", "'2010-12-31'", "'19800229'", "'x'", "NULL"])} AS date_of_birth,
        {cases('c_custkey', ["'a.b@example.com'", "'é@example.com'", "'no at'", "' x@y.tn '", "'x@y'", "NULL"])} AS email, {cases('c_custkey', ["'Homme'", "'F'", "'féminin'", "'male'", "'1'", "'0'", "'?'", "NULL"])} AS gender,
        {cases('c_custkey', ["'tn'", "' FR '", "'XX'", "'usa'", "NULL"])} AS nationality, {cases('c_custkey', ["'Ali Ben'", "'Sara'", "'  '", "NULL", "'A B C'"])} AS full_name,
        {cases('c_custkey', ["'TN5910006035183598478831'", "'TN59 1000 6035 1835 9847 8831'", "'FR5910006035183598478831'", "'TN59'", "NULL"])} AS iban, {cases('c_custkey', STATUS)} AS kyc_status,
        {cases('c_custkey', ["'1999-12-31'", "'2001-01-01'", "'bad'", "NULL"])} AS created_at, CAST(c_acctbal AS VARCHAR(40)) AS account_balance, c_mktsegment AS segment, c_acctbal AS capacity FROM {{t}}"""),
    "orders": ("orders", """SELECT o_orderkey AS id, CONCAT('R', CAST(o_orderkey % 5000 AS VARCHAR(20)), CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END) AS reference, CASE WHEN o_orderkey % 50 = 0 THEN -1.0 WHEN o_orderkey % 51 = 0 THEN 600000.0 ELSE o_totalprice END AS amount,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS status_code, CASE WHEN o_orderkey % 13 = 0 THEN '2001-05-05' ELSE '1999-01-01' END AS transaction_date, o_orderpriority AS priority FROM {t}"""),
    "credits": ("orders", f"""SELECT o_orderkey AS id, {cases('o_orderkey', ["'1.5'", "'-0.5'", "'25'", "'0'", "'18.0'", "'x'", "NULL"])} AS interest_rate, {cases('o_orderkey', ["'Murabaha'", "' ijara '", "'auto'", "'salam'", "NULL"])} AS product_type,
        {cases('o_orderkey', ["'mudaraba'", "'savings'", "' WADIAH '"])} AS account_type, {cases('o_orderkey', ["'12'", "'0.5'", "'360.9'", "'361'", "'-23'", "'abc'", "NULL"])} AS duration_months,
        {cases('o_orderkey', ["'1999-01-01'", "'2000-05-05'", "'bad'", "NULL"])} AS start_date, {cases('o_orderkey', ["'1999-06-01'", "'20000101'", "'1999-06-01'"])} AS end_date,
        {cases('o_orderkey', ["'-5'", "'0'", "'7'", "NULL"])} AS plafond_virement, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END AS amount, CASE WHEN o_orderkey % 7 = 0 THEN 20000000.0 ELSE 5.0 END AS balance FROM {{t}}"""),
    "clicks": ("events", "SELECT event_id AS id, event_type, CAST(CASE WHEN event_id % 2 = 0 THEN 1700000000 + event_id ELSE 1700000000000 + event_id * 1000 END AS VARCHAR(30)) AS at_text, value, props FROM {t}"),
    "truth": ("documents", "SELECT d.doc_id, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'VALID' WHEN l.toxic = 1 THEN 'INVALID: toxic' WHEN d.doc_id % 5 = 0 THEN NULL ELSE 'INVALID: quality' END AS ground_truth, d.n_chars < 600 AS predicted FROM {t} d JOIN {labels} l ON d.doc_id = l.doc_id"),
}


def dirty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, sql = INPUTS[name]
    more = {"labels": table(spark, sf_dir, "labels")} if "{labels}" in sql else {}
    return spark.sql(sql, t=table(spark, sf_dir, base), **more)


def with_input(name: str, select: str, rest: str = "") -> str:
    base, sql = INPUTS[name]
    return f"WITH i AS ({sql.replace('{t}', base).replace('{labels}', 'labels')}){rest} {select}"


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def projection(name: str, source: str, build: Callable[[], dict], sql: str) -> None:
    """A query of columns by id; sql: the same columns."""
    QUERIES[name] = lambda spark, sf_dir: dirty(spark, sf_dir, source).select("id", *(c.alias(n) for n, c in build().items()))
    ORACLE_SQL[name] = with_input(source, f"SELECT id, {sql} FROM i")


SQL_LIST = lambda values: ", ".join("'" + v.replace("'", "''") + "'" for v in values)
SQL_TRIM = lambda c: f"trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
SQL_NUMBER = lambda c: f"CASE WHEN regexp_full_match({SQL_TRIM(c)}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast({SQL_TRIM(c)} AS DOUBLE) END"
SQL_CLEAN = lambda c: SQL_NUMBER(f"regexp_replace({c}, '[,\\s$€£¥]', '', 'g')")
SQL_ISO = lambda c: f"coalesce(CASE WHEN regexp_full_match({c}[1:10], '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast({c}[1:10] AS DATE) END, CASE WHEN regexp_full_match({c}[1:10], '\\d{{8}}') THEN try_strptime({c}[1:10], '%Y%m%d')::DATE END)"


def sql_phone(c: str, strip: str) -> str:
    a = f"regexp_replace({c}, '[{strip}]', '', 'g')"
    b = f"CASE WHEN {a} LIKE '+216%' THEN {a}[5:] WHEN {a} LIKE '00216%' THEN {a}[6:] WHEN {a} LIKE '216%' AND length({a}) = 11 THEN {a}[4:] ELSE {a} END"
    return f"CASE WHEN regexp_full_match(regexp_replace({b}, '^0(.{{8}})$', '\\1'), '[234579][0-9]{{7}}') THEN regexp_replace({b}, '^0(.{{8}})$', '\\1') END"


def sql_date(c: str) -> str:
    """The formats in their order, by pattern and strptime."""
    forms = [("\\d{4}-\\d{2}-\\d{2}", "%Y-%m-%d"), ("\\d{2}/\\d{2}/\\d{4}", "%d/%m/%Y"), ("\\d{2}/\\d{2}/\\d{2}", None), ("\\d{2}-\\d{2}-\\d{4}", "%d-%m-%Y"), ("\\d{2}/\\d{2}/\\d{4}", "%m/%d/%Y"), ("\\d{4}", "%Y"), ("\\d{8}", "%Y%m%d"), ("\\d{4}/\\d{2}/\\d{2}", "%Y/%m/%d"), ("\\d{4}-\\d{2}", "%Y-%m"), ("[A-Za-z]+ \\d{1,2}, \\d{4}", "%B %d, %Y")]
    short = f"try_cast((CASE WHEN {c}[7:8] >= '70' THEN '19' ELSE '20' END) || {c}[7:8] || '-' || {c}[4:5] || '-' || {c}[1:2] AS DATE)"
    return "coalesce(" + ", ".join(f"CASE WHEN regexp_full_match({c}, '{p}') THEN {f"try_strptime({c}, '{f}')::DATE" if f else short} END" for p, f in forms) + ")"


# --- values -----------------------------------------------------------------------------------------------------------
projection("null_standardize", "customers", lambda: {"note": fn.null_if_token(F.col("note"))}, f"CASE WHEN lower({SQL_TRIM('note')}) NOT IN ({SQL_LIST(fixed.NULL_TOKENS)}) THEN note END AS note")
projection("phone_normalize", "customers", lambda: {"phone": fn.phone(F.col("phone"))}, sql_phone("phone", "\\s\\-.()/") + " AS phone")
projection("email_check", "customers", lambda: {"ok": fn.is_email(F.col("email"))}, f"regexp_full_match({SQL_TRIM('email')}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}') AS ok")
projection("iban_check", "customers", lambda: {"ok": fn.is_iban(F.col("iban"))}, "regexp_full_match(upper(replace(iban, ' ', '')), 'TN[0-9]{22}') AS ok")
projection("numeric_clean", "customers", lambda: {"amount": fn.clean_number(F.col("amount_text"))}, SQL_CLEAN("amount_text") + " AS amount")
projection("integer_clean", "customers", lambda: {"amount": fn.clean_integer(F.col("amount_text"))}, f"CASE WHEN {SQL_CLEAN('amount_text')} = floor({SQL_CLEAN('amount_text')}) THEN ({SQL_CLEAN('amount_text')})::INTEGER END AS amount")
projection("numeric_coerce", "customers", lambda: {"amount": fn.number(F.col("amount_text"))}, SQL_NUMBER("amount_text") + " AS amount")
projection("fill_null", "customers", lambda: {"nationality": F.coalesce("nationality", F.lit("none"))}, "coalesce(nationality, 'none') AS nationality")
projection("case_normalize", "customers", lambda: {"low": fn.cased(F.col("kyc_status"), "lower"), "high": fn.cased(F.col("kyc_status"), "upper"), "title": fn.cased(F.col("segment"), "title")}, f"lower({SQL_TRIM('kyc_status')}) AS low, upper({SQL_TRIM('kyc_status')}) AS high, upper(segment[1:1]) || lower(segment[2:]) AS title")
projection("date_multi_parse", "customers", lambda: {"born": F.date_format(fn.parsed_date(F.col("born_text")), "yyyy-MM-dd")}, f"strftime({sql_date(SQL_TRIM('born_text'))}, '%Y-%m-%d') AS born")
projection("unix_ts_convert", "clicks", lambda: {"at": fn.epoch_text(F.col("at_text"))}, "strftime(make_timestamp((CASE WHEN at_text::DOUBLE > 1e10 THEN at_text::DOUBLE / 1000 ELSE at_text::DOUBLE END)::BIGINT * 1000000), '%Y-%m-%d %H:%M:%S') AS at")
projection("word_count", "customers", lambda: {"words": fn.word_count(F.col("full_name")).cast("bigint")}, f"CASE WHEN full_name IS NOT NULL THEN len(list_filter(regexp_split_to_array({SQL_TRIM('full_name')}, '\\s+'), lambda w: w <> '')) END::BIGINT AS words")
projection("gender_repair", "customers", lambda: {"gender": fn.repaired_gender(F.col("gender"))}, f"CASE WHEN lower(gender) IN ({SQL_LIST(fixed.GENDERS)}) THEN lower(gender) WHEN lower(gender) IN ({SQL_LIST(fixed.MALE_WORDS)}) THEN 'm' WHEN lower(gender) IN ({SQL_LIST(fixed.FEMALE_WORDS)}) THEN 'f' END AS gender")
projection("full_name_repair", "customers", lambda: {"full_name": fn.full_name_from_email(F.col("full_name"), F.col("email"))}, f"CASE WHEN len(list_filter(regexp_split_to_array({SQL_TRIM('full_name')}, '\\s+'), lambda w: w <> '')) = 1 AND regexp_matches(email, '^[A-Za-z]+[._][A-Za-z]+@') THEN 'A B' ELSE full_name END AS full_name")
projection("age_in_days", "customers", lambda: {"days": F.date_diff(F.lit(AS_OF), fn.iso_date(F.col("date_of_birth"))).cast("bigint")}, f"date_diff('day', {SQL_ISO('date_of_birth')}, DATE '2000-01-01') AS days")
projection("metric_name", "orders", lambda: {"metric": fn.metric_name(F.col("priority"))}, "regexp_replace(priority, '[^a-zA-Z0-9_]', '_', 'g') AS metric")
projection("json_props_extract", "clicks", lambda: {"k": F.get_json_object("props", "$.k").cast("bigint")}, "(props->>'$.k')::BIGINT AS k")


@query("phone_quarantine", with_input("customers", f"SELECT id, phone, 'invalid_phone' AS _reason FROM i WHERE phone IS NOT NULL AND ({sql_phone('phone', chr(92) + 's' + chr(92) + '-.()/')}) IS NULL"))
def phone_quarantine(spark, sf_dir):
    done = cleaning.normal_phones(dirty(spark, sf_dir, "customers").select("id", "phone"), ["phone"])
    return done.where(F.size("_bad_phones") > 0).select("id", F.col("_raw_phone").alias("phone"), F.lit("invalid_phone").alias("_reason"))


@query("clean_by_rules", with_input("customers", f"SELECT id, {SQL_CLEAN('amount_text')} AS amount_text, strftime({sql_date(SQL_TRIM('born_text'))}, '%Y-%m-%d') AS born_text, coalesce(nationality, 'none') AS nationality, lower({SQL_TRIM('kyc_status')}) AS kyc_status FROM i"))
def clean_by_rules(spark, sf_dir):
    said = {"columns": [{"name": "amount_text", "expected_type": "double"}, {"name": "born_text", "expected_type": "date"}, {"name": "nationality", "fill_null_with": "none"}, {"name": "kyc_status", "normalize_case": "lower"}]}
    df = dirty(spark, sf_dir, "customers").select("id", "amount_text", "born_text", "nationality", "kyc_status")
    return cleaning.apply_rules(df, cleaning.CleaningRules.from_document(said))


# --- names and shapes -------------------------------------------------------------------------------------------------
@query("snake_rename", "SELECT c_custkey AS customer_id, c_name AS gender, c_mktsegment AS my_column, c_acctbal AS account_balance FROM customer")
def snake_rename(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CustGender"), F.col("c_mktsegment").alias("my Column"), F.col("c_acctbal").alias("CUST_ACCOUNT_BALANCE"))
    return schema.canonical_names(schema.snake_names(raw))


@query("canonical_rename", "SELECT c_custkey AS customer_id, c_name AS date_of_birth, c_mktsegment AS seg FROM customer")
def canonical_rename(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("DOB"), "c_mktsegment")
    return schema.renamed(schema.canonical_names(raw), {"c_mktsegment": "seg", "DOB": "x"})


@query("flatten_struct", "SELECT o_orderkey AS id, o_orderstatus AS head_status, o_totalprice AS head_inner_price, o_orderpriority AS head_inner_priority FROM orders")
def flatten_struct(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")).alias("inner")).alias("head"))
    return schema.flattened(nested)


@query("flatten_array", "SELECT vec_id, label, unnest(embedding)::DOUBLE AS embedding FROM embeddings")
def flatten_array(spark, sf_dir):
    return schema.flattened(table(spark, sf_dir, "embeddings")).select("vec_id", "label", F.col("embedding").cast("double"))


@query("flatten_array_of_structs", "SELECT o_orderkey AS id, l_linenumber AS lines_number, l_quantity AS lines_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def flatten_array_of_structs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").alias("quantity"))).alias("lines"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return schema.flattened(orders.join(lines, F.col("id") == F.col("l_orderkey"), "left").select("id", "lines"))


@query("map_to_json", "SELECT event_id AS id, (props->>'$.k')::BIGINT AS k FROM events")
def map_to_json(spark, sf_dir):
    mapped = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.from_json("props", "map<string,bigint>").alias("props"))
    return schema.flattened(mapped).select("id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("union_by_name", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return schema.union_by_name([a, b])


@query("metadata_columns", "SELECT n_nationkey, n_name, 'db_rows' AS _source_type, 'nations' AS _source_name, 'nation' AS _table_name, '20000101' AS _processed_at, 'core' AS _db_name FROM nation")
def metadata_columns(spark, sf_dir):
    return schema.with_source(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "db_rows", "nations", "nation", "core", "20000101")


@query("domain_detect", "SELECT * FROM (VALUES ('customer', 'generic'), ('documents', 'generic'), ('events', 'event_log'), ('lineitem', 'market_data'), ('orders', 'market_data'), ('part', 'market_data')) AS t(table_name, domain)")
def domain_detect(spark, sf_dir):
    found = [(n, names.domain(n, table(spark, sf_dir, n).columns)) for n in ("customer", "documents", "events", "lineitem", "orders", "part")]
    return spark.createDataFrame(found, "table_name string, domain string")


# --- duplicates -------------------------------------------------------------------------------------------------------
@query("dedup_all_columns", "SELECT DISTINCT text, lang FROM documents")
def dedup_all_columns(spark, sf_dir):
    return dedup.without_copies(table(spark, sf_dir, "documents").select("text", "lang"))


@query("dedup_key_keep_first", "SELECT text, doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_key_keep_first(spark, sf_dir):
    return dedup.without_copies(table(spark, sf_dir, "documents").select("text", "doc_id", "source"), ["text"], ["doc_id"])


@query("dedup_quarantine", "SELECT doc_id, 'duplicate' AS _reason FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1")
def dedup_quarantine(spark, sf_dir):
    return dedup.copies(table(spark, sf_dir, "documents").select("text", "doc_id"), ["text"], ["doc_id"]).select("doc_id", "_reason")


@query("duplicate_reference", with_input("orders", f"SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY {SQL_TRIM('reference')} ORDER BY id) AS n FROM i) WHERE n > 1"))
def duplicate_reference(spark, sf_dir):
    checked = rules.validated(dirty(spark, sf_dir, "orders").select("id", "reference"), "orders", {"BNK-012"}, AS_OF, order=["id"])
    return checked.where("_is_quarantined").select("id")


# --- business rules ---------------------------------------------------------------------------------------------------
def rule_query(name: str, source: str, active: dict[str, str], table_name: str = "") -> None:
    """A query of the ids and rules violated; active: rule to its SQL condition."""

    def run(spark, sf_dir):
        checked = rules.validated(dirty(spark, sf_dir, source), table_name, {*active}, AS_OF, order=["id"])
        return checked.select("id", F.explode("_violations").alias("v")).select("id", "v.rule_id").where(F.col("rule_id").isin([*active]))

    QUERIES[name] = run
    ORACLE_SQL[name] = with_input(source, " UNION ALL ".join(f"SELECT id, '{r}' AS rule_id FROM i WHERE {c}" for r, c in active.items()))


BORN, STARTS, ENDS = SQL_ISO("date_of_birth"), SQL_ISO("start_date"), SQL_ISO("end_date")
RATE, MONTHS, BALANCE = SQL_NUMBER("interest_rate"), SQL_NUMBER("duration_months"), SQL_NUMBER("balance::VARCHAR")
RULE_SQL = {
    "GEN-001": f"email IS NOT NULL AND NOT regexp_full_match({SQL_TRIM('email')}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')",
    "GEN-002": f"phone IS NOT NULL AND ({sql_phone('phone', chr(92) + 's' + chr(92) + '-.()')}) IS NULL",
    "GEN-003": f"{BORN} <= DATE '2000-01-01' AND date_diff('day', {BORN}, DATE '2000-01-01') / 365.25 < 18",
    "GEN-004": f"date_diff('day', {BORN}, DATE '2000-01-01') / 365.25 > 110",
    "GEN-005": f"{BORN} > DATE '2000-01-01'",
    "GEN-006": f"gender IS NOT NULL AND lower(gender) NOT IN ({SQL_LIST(fixed.GENDERS + fixed.MALE_WORDS + fixed.FEMALE_WORDS)})",
    "GEN-007": f"upper({SQL_TRIM('nationality')}) NOT IN ({SQL_LIST(fixed.COUNTRY_CODES)})",
    "GEN-008": f"full_name IS NULL OR {SQL_TRIM('full_name')} = ''",
    "GEN-009": f"{SQL_ISO('created_at')} > DATE '2000-01-01'",
    "GEN-010": f"full_name IS NOT NULL AND len(list_filter(regexp_split_to_array({SQL_TRIM('full_name')}, '\\s+'), lambda w: w <> '')) < 2",
    "BNK-001": "iban IS NOT NULL AND NOT regexp_full_match(upper(replace(iban, ' ', '')), 'TN[0-9]{22}')",
    "BNK-004": f"{RATE} < 0",
    "BNK-005": f"{RATE} > 18",
    "BNK-007": f"trunc({MONTHS}) NOT BETWEEN 1 AND 360",
    "BNK-008": f"start_date IS NOT NULL AND end_date IS NOT NULL AND NOT coalesce({STARTS} < {ENDS}, false)",
    "BNK-011": f"lower({SQL_TRIM('kyc_status')}) NOT IN ({SQL_LIST(fixed.STATUSES)})",
    "BNK-013": "plafond_virement::DOUBLE < 0",
    "ISL-001": f"lower({SQL_TRIM('account_type')}) IN ({SQL_LIST(fixed.ISLAMIC_ACCOUNTS)}) AND {RATE} <> 0",
    "ISL-002": f"lower({SQL_TRIM('product_type')}) IN ({SQL_LIST(fixed.ISLAMIC_CREDITS)}) AND {RATE} <> 0",
}
for _name, _source, _rules in (
    ("rule_gen_001_002", "customers", ["GEN-001", "GEN-002"]), ("rule_gen_003_004_005", "customers", ["GEN-003", "GEN-004", "GEN-005"]), ("rule_gen_006", "customers", ["GEN-006"]), ("rule_gen_007", "customers", ["GEN-007"]),
    ("rule_gen_008_010", "customers", ["GEN-008", "GEN-010"]), ("rule_gen_009", "customers", ["GEN-009"]), ("rule_bnk_001", "customers", ["BNK-001"]), ("rule_bnk_004_005", "credits", ["BNK-004", "BNK-005"]),
    ("rule_bnk_007", "credits", ["BNK-007"]), ("rule_bnk_008", "credits", ["BNK-008"]), ("rule_bnk_011", "customers", ["BNK-011"]), ("rule_bnk_013", "credits", ["BNK-013"]), ("rule_isl_001", "credits", ["ISL-001"]), ("rule_isl_002", "credits", ["ISL-002"]),
):
    rule_query(_name, _source, {r: RULE_SQL[r] for r in _rules})
rule_query("rule_bnk_002", "customers", {"BNK-002": "account_balance::DOUBLE < 0"})
rule_query("rule_bnk_003_010", "orders", {"BNK-003": "amount <= 0", "BNK-010": "amount > 500000"}, "transactions")
rule_query("rule_bnk_006", "credits", {"BNK-006": "amount <= 0"}, "credits")
rule_query("rule_bnk_009", "credits", {"BNK-009": "balance > 10000000"})
rule_query("rule_bnk_014", "customers", {"BNK-014": "capacity <= 0"})


@query("custom_rules", "SELECT o_orderkey AS id, 'big' AS rule_id FROM orders WHERE o_totalprice > 200000")
def custom_rules(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return rules.validated(df, "x", set(), AS_OF, custom={"big": "o_totalprice > 200000"}).where("_violation_count > 0").select("id", F.col("_violations")[0]["rule_id"].alias("rule_id"))


# --- validation and its metrics ---------------------------------------------------------------------------------------
ACTIVE = {"BNK-003", "BNK-010", "GEN-009", "BNK-012"}
CHECKED = f""",
    n AS (SELECT *, row_number() OVER (PARTITION BY {SQL_TRIM('reference')} ORDER BY id) AS nth FROM i),
    c AS (SELECT *, amount <= 0 AS b3, amount > 500000 AS b10, transaction_date > '2000-01-01' AS g9, nth > 1 AS b12 FROM n),
    v AS (SELECT *, b3::INT + b10::INT + g9::INT + b12::INT AS k FROM c)"""
LONG = CHECKED + """,
    r AS (SELECT id, k, 'BNK-003' AS rule_id, 'CRITICAL' AS severity, 'banking' AS domain FROM v WHERE b3 UNION ALL SELECT id, k, 'BNK-010', 'MAJOR', 'banking' FROM v WHERE b10
          UNION ALL SELECT id, k, 'GEN-009', 'MAJOR', 'general' FROM v WHERE g9 UNION ALL SELECT id, k, 'BNK-012', 'CRITICAL', 'banking' FROM v WHERE b12)"""


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validated(dirty(spark, sf_dir, "orders"), "transactions", ACTIVE, AS_OF, order=["id"])


@query("validate_rows", with_input("orders", """SELECT id, k::INT AS n, CASE WHEN b3 OR b12 THEN 'CRITICAL' WHEN k > 0 THEN 'MAJOR' ELSE 'NONE' END AS severity, k > 0 AS quarantined,
    nullif(concat_ws(' | ', CASE WHEN g9 THEN '[GEN-009] transaction_date' END, CASE WHEN b3 THEN '[BNK-003] amount' END, CASE WHEN b10 THEN '[BNK-010] amount' END, CASE WHEN b12 THEN '[BNK-012] reference' END), '') AS reason FROM v""", CHECKED))
def validate_rows(spark, sf_dir):
    return checked(spark, sf_dir).select("id", F.col("_violation_count").alias("n"), F.col("_max_severity").alias("severity"), F.col("_is_quarantined").alias("quarantined"), F.col("_quarantine_reason").alias("reason"))


@query("valid_split", with_input("orders", "SELECT id, reference, amount, status_code, transaction_date, priority FROM v WHERE k = 0", CHECKED))
def valid_split(spark, sf_dir):
    return rules.split(checked(spark, sf_dir))[0]


@query("quarantine_split", with_input("orders", "SELECT id, reference FROM v WHERE k > 0", CHECKED))
def quarantine_split(spark, sf_dir):
    return rules.split(checked(spark, sf_dir))[1].select("id", "reference")


@query("violations_by_rule", with_input("orders", "SELECT rule_id, count(*) AS n FROM r GROUP BY 1", LONG))
def violations_by_rule(spark, sf_dir):
    return metrics.by_rule(checked(spark, sf_dir))


@query("quarantine_by_rule", with_input("orders", "SELECT rule_id, count(*) AS n FROM r WHERE k > 0 GROUP BY 1", LONG))
def quarantine_by_rule(spark, sf_dir):
    return metrics.by_rule(checked(spark, sf_dir), quarantined_only=True)


@query("violations_by_domain", with_input("orders", "SELECT domain, count(*) AS n FROM r GROUP BY 1", LONG))
def violations_by_domain(spark, sf_dir):
    return metrics.by_domain(checked(spark, sf_dir))


@query("violations_by_severity", with_input("orders", "SELECT count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'MAJOR') AS major, 0::BIGINT AS warning FROM r", LONG))
def violations_by_severity(spark, sf_dir):
    return metrics.by_severity(checked(spark, sf_dir))


@query("top_violations", with_input("orders", "SELECT rule_id, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, rule_id LIMIT 2", LONG))
def top_violations(spark, sf_dir):
    return metrics.top_rules(checked(spark, sf_dir), 2)


@query("quality_rows", with_input("orders", "SELECT count(*) AS total, count(*) FILTER (k = 0) AS valid, count(*) FILTER (k > 0) AS quarantined, round(100.0 * count(*) FILTER (k = 0) / count(*), 2)::DOUBLE AS validity_rate, round(100.0 * count(*) FILTER (k > 0) / count(*), 2)::DOUBLE AS quarantine_rate FROM v", CHECKED))
def quality_rows(spark, sf_dir):
    return metrics.row_counts(checked(spark, sf_dir))


FILLED = [("id", "id"), ("reference", "reference"), ("amount", "amount"), ("status_code", "status_code"), ("transaction_date", "transaction_date"), ("priority", "priority")]


@query("completeness", with_input("orders", " UNION ALL ".join(f"SELECT '{n}' AS column_name, round(100.0 * count({c}) / count(*), 2)::DOUBLE AS complete FROM i" for n, c in FILLED)))
def completeness(spark, sf_dir):
    return metrics.completeness(dirty(spark, sf_dir, "orders"))


@query("completeness_average", with_input("orders", "SELECT round(avg(c), 2) AS average FROM (" + " UNION ALL ".join(f"SELECT round(100.0 * count({c}) / count(*), 2)::DOUBLE AS c FROM i" for _, c in FILLED) + ")"))
def completeness_average(spark, sf_dir):
    return metrics.average_completeness(dirty(spark, sf_dir, "orders"))


@query("alerts", with_input("orders", """SELECT concat_ws(',', CASE WHEN q > 30 THEN 'CRITICAL quarantine' WHEN q > 10 THEN 'WARNING quarantine' END, CASE WHEN 50 < 70 THEN 'WARNING completeness' END, 'CRITICAL recall') AS alerts
    FROM (SELECT 100.0 * count(*) FILTER (k > 0) / count(*) AS q FROM v)""", CHECKED))
def alerts(spark, sf_dir):
    rates = metrics.row_counts(checked(spark, sf_dir)).select("quarantine_rate", F.lit(50.0).alias("completeness"), F.lit(10.0).alias("recall"))
    return metrics.alerts(rates).select(F.array_join("alerts", ",").alias("alerts"))


BAD = "(ground_truth IS NULL OR NOT starts_with(ground_truth, 'VALID'))"
COUNTS = f"SELECT count(*) FILTER ({BAD} AND predicted) AS tp, count(*) FILTER (NOT {BAD} AND predicted) AS fp, count(*) FILTER ({BAD} AND NOT predicted) AS fn, count(*) FILTER (NOT {BAD} AND NOT predicted) AS tn FROM i"


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rules.ground_truth(dirty(spark, sf_dir, "truth"))
    return metrics.confusion(df, F.col("_ground_truth"), F.col("predicted"))


@query("confusion_matrix", with_input("truth", COUNTS))
def confusion_matrix(spark, sf_dir):
    return confusion_counts(spark, sf_dir)


@query("precision_recall", with_input("truth", """SELECT tp, fp, fn, tn, precision, recall, accuracy, f1,
        CASE WHEN recall >= 95 AND precision >= 85 AND f1 >= 90 THEN 'A' WHEN recall >= 85 AND precision >= 75 AND f1 >= 80 THEN 'B' WHEN recall >= 75 AND precision >= 65 AND f1 >= 70 THEN 'C' WHEN recall >= 60 AND f1 >= 55 THEN 'D' ELSE 'F' END AS grade
    FROM (SELECT *, round(2 * precision * recall / greatest(precision + recall, 1), 2) AS f1 FROM (SELECT *, round(100.0 * tp / greatest(tp + fp, 1), 2)::DOUBLE AS precision, round(100.0 * tp / greatest(tp + fn, 1), 2)::DOUBLE AS recall,
        round(100.0 * (tp + tn) / greatest(tp + tn + fp + fn, 1), 2)::DOUBLE AS accuracy FROM (""" + COUNTS + ")))"))
def precision_recall(spark, sf_dir):
    return metrics.precision_recall(confusion_counts(spark, sf_dir))


@query("error_types", with_input("truth", f"SELECT coalesce(replace(ground_truth, 'INVALID: ', ''), 'None') AS error_type, count(*) FILTER (predicted) AS detected, count(*) FILTER (NOT predicted) AS missed FROM i WHERE {BAD} GROUP BY 1"))
def error_types(spark, sf_dir):
    return metrics.error_types(rules.ground_truth(dirty(spark, sf_dir, "truth")), F.col("_ground_truth"), F.col("predicted"))


@query("global_report", """WITH t AS (SELECT count(*) AS total, count(*) FILTER (c_acctbal >= 0) AS valid, 90.0 AS precision, 80.5 AS recall, NULL::DOUBLE AS f1 FROM customer UNION ALL SELECT count(*), count(*) FILTER (s_acctbal >= 0), 70.0, 60.0, 50.0 FROM supplier)
    SELECT count(*) AS tables, sum(total)::BIGINT AS total_rows, sum(valid)::BIGINT AS valid_rows, sum(total - valid)::BIGINT AS quarantined_rows, round(100.0 * sum(valid) / sum(total), 2)::DOUBLE AS validity_rate,
        round(avg(precision), 2)::DOUBLE AS avg_precision, round(avg(recall), 2)::DOUBLE AS avg_recall, round(avg(f1), 2)::DOUBLE AS avg_f1 FROM t""")
def global_report(spark, sf_dir):
    parts = []
    for name, column, p, r, f in (("customer", "c_acctbal", 90.0, 80.5, None), ("supplier", "s_acctbal", 70.0, 60.0, 50.0)):
        done = rules.validated(table(spark, sf_dir, name).select(F.col(column).alias("balance")), name, {"BNK-002"}, AS_OF)
        parts.append(metrics.row_counts(done).withColumns({"precision": F.lit(p), "recall": F.lit(r), "f1": F.lit(f).cast("double")}))
    return metrics.global_report(schema.union_by_name(parts))


# --- profiles and samples ---------------------------------------------------------------------------------------------
@query("profile_columns", """SELECT column_name, 0.0 AS null_percent, is_number AS "numeric", lo AS "min", hi AS "max", mean, false AS likely_epoch, false AS is_date, round(d * 1.0 / n, 3) AS unique_rate, len AS max_length, NOT is_number AND d * 1.0 / n < 0.1 AND d <= 20 AS categorical FROM (
        SELECT 'p_partkey' AS column_name, true AS is_number, min(p_partkey)::DOUBLE AS lo, max(p_partkey)::DOUBLE AS hi, round(avg(p_partkey), 4) AS mean, count(DISTINCT p_partkey) AS d, count(*) AS n, max(length(p_partkey::VARCHAR)) AS len FROM part
        UNION ALL SELECT 'p_brand', false, NULL, NULL, NULL, count(DISTINCT p_brand), count(*), max(length(p_brand)) FROM part
        UNION ALL SELECT 'p_size', true, min(p_size)::DOUBLE, max(p_size)::DOUBLE, round(avg(p_size), 4), count(DISTINCT p_size), count(*), max(length(p_size::VARCHAR)) FROM part
        UNION ALL SELECT 'p_type', false, NULL, NULL, NULL, count(DISTINCT p_type), count(*), max(length(p_type)) FROM part)""")
def profile_columns(spark, sf_dir):
    return profile.column_profiles(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type"), distinct_exact=True)


@query("categorical_detect", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def categorical_detect(spark, sf_dir):
    return profile.categories(table(spark, sf_dir, "events"), "event_type")


@query("sample_deterministic", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey LIMIT 100")
def sample_deterministic(spark, sf_dir):
    return profile.sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


# --- changes between runs ---------------------------------------------------------------------------------------------
@query("change_detect", "SELECT n_name AS group_key, CASE WHEN n_nationkey >= 20 THEN 'NEW' WHEN n_nationkey < 3 THEN 'REMOVED' WHEN n_nationkey % 4 = 0 THEN 'MODIFIED' ELSE 'UNCHANGED' END AS status FROM nation")
def change_detect(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    now = nation.where("n_nationkey >= 3").select(F.col("n_name").alias("group_key"), F.col("n_nationkey").cast("string").alias("hash"))
    before = nation.where("n_nationkey < 20").select(F.col("n_name").alias("group_key"), F.expr("cast(case when n_nationkey % 4 = 0 then -1 else n_nationkey end as string)").alias("hash"))
    return changes.changes(now, before)


@query("gold_incremental", "SELECT n_name AS name, 'run' || n_nationkey AS path, CASE WHEN n_nationkey >= 10 THEN 'NEW' ELSE 'UPDATED' END AS status FROM nation WHERE n_nationkey >= 10 OR n_nationkey % 3 = 0")
def gold_incremental(spark, sf_dir):
    latest = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.concat(F.lit("run"), "n_nationkey").alias("path"), "n_nationkey")
    done = latest.where("n_nationkey < 10").select("name", F.when(F.col("n_nationkey") % 3 == 0, "old").otherwise(F.col("path")).alias("path"))
    return changes.to_process(latest.drop("n_nationkey"), done, ["name"])


@query("latest_run", "SELECT o_custkey AS custkey, max_by(o_orderkey, o_orderdate) AS path, strftime(max(o_orderdate), '%Y-%m-%d') AS run_at FROM (SELECT * FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1) GROUP BY 1")
def latest_run(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    single = orders.join(orders.groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("n")).where("n = 1"), ["o_custkey", "o_orderdate"])
    runs = single.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("path"), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("run_at"))
    return changes.latest_runs(runs, ["custkey"])


@query("iso_epoch", "SELECT o_orderkey, epoch(o_orderdate::DATE + INTERVAL 45296 SECOND)::BIGINT AS seconds FROM orders")
def iso_epoch(spark, sf_dir):
    said = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:34:56Z"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.iso_epoch(said).alias("seconds"))


@query("most_frequent_values", """SELECT column_name, value, n FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS nth FROM (
    SELECT column_name, value, count(*) AS n FROM (SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS column_name, unnest([o_orderstatus::VARCHAR, o_orderpriority::VARCHAR]) AS value FROM orders) GROUP BY 1, 2)) WHERE nth <= 3""")
def most_frequent_values(spark, sf_dir):
    return profile.values(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority"), 3)


@query("group_hash", """WITH f AS (SELECT lang, doc_id::VARCHAR AS path, doc_id::VARCHAR || ':' || md5(text) || ':' || octet_length(encode(text))::VARCHAR || ';' AS line FROM documents),
    p AS (SELECT lang, md5(path)[1:3] AS part, md5(string_agg(line, '' ORDER BY path)) AS hash FROM f GROUP BY 1, 2)
    SELECT lang AS group_key, md5(string_agg(hash, '' ORDER BY part)) AS hash FROM p GROUP BY 1""")
def group_hash(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("lang").alias("group_key"), F.col("doc_id").cast("string").alias("path"), F.encode("text", "utf-8").alias("content"))
    return changes.group_hashes(files)


# --- metrics as text --------------------------------------------------------------------------------------------------
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).withColumn("name", F.lit("events.seen-total"))


@query("prom_format", """SELECT 'events_seen_total{event_type="' || event_type || '"} ' || count(*) AS line FROM events GROUP BY event_type""")
def prom_format(spark, sf_dir):
    return exports.prometheus_lines(event_counts(spark, sf_dir), "name", "n", ["event_type"])


@query("prom_parse", "SELECT 'events_seen_total' AS name, event_type, count(*)::DOUBLE AS metric FROM events GROUP BY event_type")
def prom_parse(spark, sf_dir):
    lines = exports.prometheus_lines(event_counts(spark, sf_dir), "name", "n", ["event_type"]).withColumnRenamed("line", "value")
    lines = lines.unionByName(spark.createDataFrame([("# TYPE x gauge",), ("broken",)], "value string"))
    return exports.parsed_prometheus(lines).select("name", F.col("labels")["event_type"].alias("event_type"), "metric")


EVENT_SQL = "SELECT event_type AS table_name, count(*) AS rows_input, count(*) FILTER (value >= 0) AS rows_output, count(*) FILTER (value < 0) AS rows_quarantined FROM events GROUP BY 1"


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("table_name")).agg(F.count("*").alias("rows_input"), F.count_if(F.col("value") >= 0).alias("rows_output"), F.count_if(F.col("value") < 0).alias("rows_quarantined"))
    said = F.to_json(F.struct(F.lit("clean").alias("event"), "table_name", "rows_input", "rows_output", "rows_quarantined", F.lit(True).alias("success")))
    lines = counts.select(F.concat(F.lit("2026-01-01 10:00:00  INFO      METRICS: "), said).alias("value"))
    return lines.unionByName(spark.createDataFrame([("2026-01-01 INFO start",), ("METRICS: {broken",), ("Temps total d'exécution : 76.9 s",), ("RÉSULTATS : 6 OK / 1 ÉCHEC",)], "value string"))


@query("log_metrics_parse", EVENT_SQL)
def log_metrics_parse(spark, sf_dir):
    return exports.metric_events(event_log(spark, sf_dir)).select("table_name", "rows_input", "rows_output", "rows_quarantined")


@query("log_summary", "SELECT 76.9::DOUBLE AS total_seconds, 6::BIGINT AS ok, 1::BIGINT AS failed")
def log_summary(spark, sf_dir):
    return exports.log_summary(event_log(spark, sf_dir))


@query("run_totals", f"SELECT count(*) AS tables, sum(rows_input)::BIGINT AS rows_in, sum(rows_output)::BIGINT AS rows_out, sum(rows_quarantined)::BIGINT AS rows_quarantined, count(*) AS ok, round(100.0 * sum(rows_quarantined) / sum(rows_input), 2)::DOUBLE AS quarantine_rate FROM ({EVENT_SQL})")
def run_totals(spark, sf_dir):
    return exports.run_totals(exports.metric_events(event_log(spark, sf_dir)))
