import json

import pytest

from siltworks.operators import rules
from siltworks.operators.conditions import Condition, resolved
from siltworks.plans.pipeline import run_clean, run_validate
from siltworks.plans.providers import DocumentRules
from siltworks.sources import sinks


def test_each_condition_is_resolved_alone(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, "500"), (4, None)], "id int, amount string")
    said = [
        Condition("C1", "amount > 100", "CRITICAL", "amount"), Condition("C2", "no_such_column > 1"), Condition("C3", "amount >"), Condition("C4", "id + 1"), Condition("C5", "sum(id) > 3"), Condition("C6", ""),
        Condition("C7", "id = 2", "WARNING"), Condition("C8", "row_number() over (order by id) > 1"), Condition("C9", "id in (select 1)"), Condition("C10", "id = 1", "FATAL"), Condition("C11", "explode(array(id)) > 1"),
    ]
    _, good, bad = resolved(df, said)
    assert [c.rule_id for c, _ in good] == ["C1", "C7"] and [b["rule_id"] for b in bad] == ["C2", "C3", "C4", "C5", "C6", "C8", "C9", "C10", "C11"]
    assert all(b["error"] for b in bad) and spark.conf.get("spark.sql.ansi.enabled") == "true"
    # text that is no number ends no job
    checked = {r["id"]: r for r in rules.validated(df, "t", set(), custom=said).collect()}
    assert [(i, [v["rule_id"] for v in r["_violations"]], r["_is_quarantined"]) for i, r in sorted(checked.items())] == [(1, [], False), (2, ["C7"], False), (3, ["C1"], True), (4, [], False)]
    assert checked[3]["_quarantine_reason"] == "[C1] amount" and not [c for c in checked[3].asDict() if c.startswith("_condition")]
    with pytest.raises(ValueError, match="C2"):
        rules.validated(df, "t", set(), custom={"C2": "no_such_column > 1"})


def test_rule_document_with_a_good_and_a_bad_condition(spark, tmp_path):
    (tmp_path / "raw" / "source_file").mkdir(parents=True)
    (tmp_path / "raw" / "source_file" / "sales.csv").write_text("id,amount\n1,5\n2,900\n3,oops\n")
    said = {"sales": {"business": {"custom_rules": [{"rule_id": "S-1", "condition": "amount > 100", "severity": "critical", "column": "amount"}, {"rule_id": "S-2", "condition": "missing IS NULL"}, {"rule_id": "S-3", "condition": "id = 1", "applies": False}]}}}
    provider = DocumentRules(json.dumps(said))
    run_clean(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), provider)
    (done,) = run_validate(spark, str(tmp_path / "clean"), str(tmp_path / "gold"), provider)
    assert done["total"] == 3 and done["quarantined"] == 1 and done["rules"] == {"S-1": 1}
    assert [e["rule_id"] for e in done["rule_errors"]] == ["S-2"] and "missing" in done["rule_errors"][0]["error"]
    report = spark.read.json(f"{tmp_path}/gold/reports/tables/*").first()
    assert report["rule_errors"][0]["rule_id"] == "S-2" and sinks.load_state(spark, f"{tmp_path}/gold/state.json")
