"""Cleaning by rules; each step is one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siltworks.functions import columns as fn
from siltworks.functions import names
from siltworks.operators.schema import quoted


@dataclass
class ColumnRule:
    """How one column is cleaned."""

    name: str
    type: str = "string"
    case: str = ""
    formats: list[str] = field(default_factory=list)
    fill: str | float | None = None


@dataclass
class CleaningRules:
    columns: list[ColumnRule] = field(default_factory=list)
    renames: dict[str, str] = field(default_factory=dict)
    phones: list[str] = field(default_factory=list)
    epochs: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)

    @classmethod
    def from_document(cls, d: dict) -> CleaningRules:
        """From a JSON document; an epoch column that is financial, and a gender column that isn't lower-case text, are put right."""
        rules = []
        for c in d.get("columns", []):
            name = c.get("name") or c.get("original_name", "")
            gender = names.is_gender(name)
            rules.append(ColumnRule(name, "string" if gender else c.get("expected_type", "string"), "lower" if gender else c.get("normalize_case") or "", c.get("date_formats_to_try") or [], c.get("fill_null_with")))
        epochs = [c for c in d.get("unix_timestamp_columns", []) if not names.is_financial(c)]
        return cls(rules, d.get("column_renames") or {}, d.get("phone_column_names") or [], epochs, d.get("drop_duplicates_on") or [])


def standard_nulls(df: DataFrame) -> DataFrame:
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*(fn.null_if_token(quoted(c)).alias(c) if c in text else quoted(c) for c in df.columns))


def cleaned(c: Column, rule: ColumnRule) -> Column:
    kind = "double" if rule.type in ("integer", "long") and names.is_financial(rule.name) else rule.type
    if kind == "integer":
        c = fn.clean_integer(c.cast("string"))
    elif kind == "long":
        c = fn.clean_number(c.cast("string")).try_cast("long")
    elif kind == "double":
        c = fn.clean_number(c.cast("string"))
    elif kind == "unix_timestamp":
        c = fn.epoch_text(c)
    elif names.is_date(rule.name, rule.type) and kind in ("date", "string"):
        c = F.date_format(fn.parsed_date(c.cast("string"), rule.formats or None), "yyyy-MM-dd")
    elif rule.case and kind == "string":
        c = fn.cased(c, rule.case)
    return F.coalesce(c, F.lit(rule.fill)) if rule.fill is not None else c


def apply_rules(df: DataFrame, rules: CleaningRules) -> DataFrame:
    by_name = {r.name: r for r in rules.columns}
    skip = {*rules.phones, *rules.epochs}
    return df.select(*(cleaned(quoted(c), by_name[c]).alias(c) if c in by_name and c not in skip else quoted(c) for c in df.columns))


def normal_phones(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each phone column normalised; _bad_phones lists the columns whose value was none."""
    bad = F.array_compact(F.array(*(F.when(quoted(c).isNotNull() & fn.phone(quoted(c)).isNull(), c) for c in columns))) if columns else F.expr("cast(array() as array<string>)")
    return df.select(*(fn.phone(quoted(c)).alias(c) if c in columns else quoted(c) for c in df.columns), bad.alias("_bad_phones"), *(quoted(c).alias(f"_raw_{c}") for c in columns))


def epoch_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: fn.epoch_text(quoted(c)) for c in columns}) if columns else df
