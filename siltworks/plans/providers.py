"""Where cleaning rules and the choice of business rules come from. None needs a network."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import DataFrame

from siltworks.functions import names
from siltworks.operators.cleaning import CleaningRules, ColumnRule
from siltworks.operators.conditions import Condition
from siltworks.operators.profile import column_profiles
from siltworks.operators.rules import ALL_RULES, BY_ID, MAJOR


class RuleProvider(Protocol):
    def cleaning(self, table: str, df: DataFrame) -> CleaningRules: ...

    def business(self, table: str, df: DataFrame) -> tuple[set[str], dict[str, str]]: ...

    # conditions(table) is optional: further rules of a table


class NoRules:
    """Only what needs no rules: nulls, phones and duplicates; the interest rules."""

    def cleaning(self, table: str, df: DataFrame) -> CleaningRules:
        return CleaningRules()

    def business(self, table: str, df: DataFrame) -> tuple[set[str], dict[str, str]]:
        return set(), {}


class HeuristicRules:
    """From the columns' profiles and names; a business rule applies where one of its columns is."""

    def cleaning(self, table: str, df: DataFrame) -> CleaningRules:
        rules, epochs = [], []
        for p in column_profiles(df, distinct_exact=False).collect():
            c = p["column_name"]
            if p["likely_epoch"] and p["numeric"]:
                epochs.append(c)
            elif names.is_gender(c):
                rules.append(ColumnRule(c, "string", "lower"))
            elif p["is_date"]:
                rules.append(ColumnRule(c, "date"))
            elif p["numeric"] and names.is_financial(c):
                rules.append(ColumnRule(c, "double"))
        return CleaningRules(rules, epochs=epochs)

    def business(self, table: str, df: DataFrame) -> tuple[set[str], dict[str, str]]:
        at = names.Resolver(df.columns)
        return {r for r in ALL_RULES if r not in BY_ID or at.every(list(BY_ID[r].columns)) or r == "GEN-010"}, {}


class DocumentRules:
    """From JSON documents: by table, ``cleaning`` and ``business`` (applicable_rules with rule_id, column_mapping, applies)."""

    def __init__(self, documents: dict | str):
        self.documents = json.loads(repaired_json(documents)) if isinstance(documents, str) else documents

    def cleaning(self, table: str, df: DataFrame) -> CleaningRules:
        return CleaningRules.from_document(self.documents.get(table, {}).get("cleaning", {}))

    def business(self, table: str, df: DataFrame) -> tuple[set[str], dict[str, str]]:
        chosen = [r for r in self.documents.get(table, {}).get("business", {}).get("applicable_rules", []) if r.get("applies", True)]
        mapping = {}
        for r in chosen:
            m = r.get("column_mapping")
            mapping[r["rule_id"]] = next(iter(m.values()), "") if isinstance(m, dict) else m or ""
        return {r["rule_id"] for r in chosen}, mapping

    def conditions(self, table: str) -> list[Condition]:
        """A table's own rules, ``custom_rules`` beside applicable_rules: rule_id, condition (SQL, true for a violation), severity and column."""
        said = self.documents.get(table, {}).get("business", {}).get("custom_rules", [])
        return [Condition(str(r.get("rule_id", f"CUSTOM-{i}")), str(r.get("condition") or ""), str(r.get("severity", MAJOR)).upper(), str(r.get("column") or "")) for i, r in enumerate(said) if r.get("applies", True)]


def repaired_json(said: str) -> str:
    """The document in an answer that may stand between fences or words."""
    starts = [i for i in (said.find("{"), said.find("[")) if i >= 0]
    return said[min(starts) : max(said.rfind("}"), said.rfind("]")) + 1] if starts else "{}"
