from datetime import date

import pytest
from pyspark.sql import functions as F

from siltworks.operators import metrics, rules

NOW = date(2026, 4, 15)


def broken(spark, column, value, table="t", others="", more=()):
    df = spark.createDataFrame([(value, *more)], f"{column} string{others}")
    return {v["rule_id"] for v in rules.validated(df, table, as_of=NOW).first()["_violations"]}


@pytest.mark.parametrize(
    ("rule", "column", "bad", "good", "table"),
    [
        ("GEN-001", "email", "x@y", "a@b.tn", "t"), ("GEN-002", "phone", "123", "+216 20123456", "t"), ("GEN-003", "date_of_birth", "2015-01-01", "1990-01-01", "t"), ("GEN-004", "dob", "1880-01-01", "1990-01-01", "t"),
        ("GEN-005", "dob", "2030-01-01", "1990-01-01", "t"), ("GEN-006", "gender", "?", "homme", "t"), ("GEN-007", "nationality", "XX", " tn ", "t"), ("GEN-008", "nom", "  ", "Ali", "t"), ("GEN-009", "created_at", "2027-01-01", "2020-01-01", "t"),
        ("GEN-010", "full_name", "Ali", "Ali Ben", "t"), ("BNK-001", "IBAN", "FR1", "TN5910006035183598478831", "t"), ("BNK-002", "balance", "-1", "0", "t"), ("BNK-003", "amount", "0", "1", "transactions"), ("BNK-004", "interest_rate", "-1", "1", "t"),
        ("BNK-005", "taux_interet", "18.1", "18", "t"), ("BNK-006", "montant", "0", "1", "credits"), ("BNK-007", "duration_months", "361", "360.9", "t"), ("BNK-009", "solde", "10000001", "10000000", "t"), ("BNK-010", "amount", "500001", "500000", "transaction"),
        ("BNK-011", "status", "closed", " Actif", "t"), ("BNK-013", "plafond_virement", "-1", "0", "t"), ("BNK-014", "capacity", "0", "1", "t"),
    ],
)
def test_rule(spark, rule, column, bad, good, table):
    assert rule in broken(spark, column, bad, table)
    assert rule not in broken(spark, column, good, table)
    assert (rule in broken(spark, column, None, table)) == (rule == "GEN-008")


def test_rules_on_several_columns(spark):
    dates = lambda a, b: broken(spark, "start_date", a, others=", end_date string", more=(b,))
    assert "BNK-008" in dates("2020-01-02", "2020-01-01") and "BNK-008" in dates("bad", "2020-01-01") and "BNK-008" not in dates("2020-01-01", "2020-01-02") and "BNK-008" not in dates(None, "x")
    assert "ISL-001" in broken(spark, "account_type", " Wadiah", others=", interest_rate string", more=("1",))
    assert "ISL-002" not in broken(spark, "product_type", "ijara", others=", interest_rate string", more=("0.0",))


def test_row_outputs_split_and_reference(spark):
    df = spark.createDataFrame([(1, "R1", "-5", "x"), (2, " R1 ", "3", "x"), (3, None, "3", "homme"), (4, None, "3", "f")], "id int, reference string, balance string, gender string")
    done = rules.validated(df, "t", as_of=NOW, order=["id"])
    rows = {r["id"]: r for r in done.collect()}
    assert [rows[i]["_max_severity"] for i in (1, 2, 3, 4)] == ["CRITICAL", "CRITICAL", "NONE", "NONE"]
    assert rows[1]["_quarantine_reason"] == "[BNK-002] balance" and rows[2]["_quarantine_reason"] == "[BNK-012] reference" and rows[3]["_quarantine_reason"] is None
    good, bad = rules.split(done)
    assert good.count() + bad.count() == 4 and good.columns == df.columns
    assert metrics.by_severity(done).first().asDict() == {"critical": 2, "major": 0, "warning": 2}
    assert rules.validated(df, "t", set(), NOW, custom={"c": "id = 3"}).where("_violation_count > 0").count() == 1


def test_plans_have_no_python(spark):
    df = spark.createDataFrame([("a", "1", "x")], "email string, balance string, full_name string")
    plan = rules.validated(df, "t", as_of=NOW)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_metrics(spark):
    df = spark.createDataFrame([("VALID", True), ("VALID x", False), ("INVALID: a", True), ("INVALID: a", False), (None, True)], "t string, p boolean")
    counts = metrics.confusion(df, F.col("t"), F.col("p"))
    assert counts.first().asDict() == {"tp": 2, "fp": 1, "fn": 1, "tn": 1}
    r = metrics.precision_recall(counts).first()
    assert (r["precision"], r["recall"], r["f1"], r["grade"]) == (66.67, 66.67, 66.67, "D")
    kinds = {r["error_type"]: (r["detected"], r["missed"]) for r in metrics.error_types(df, F.col("t"), F.col("p")).collect()}
    assert kinds == {"a": (1, 1), "None": (1, 0)}
