"""The business rules and their evaluation: one projection gives every row its violations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.functions import fixed, names
from siltworks.operators.conditions import PREFIX, Condition, resolved
from siltworks.operators.dedup import with_repeats
from siltworks.operators.schema import quoted

CRITICAL, MAJOR, WARNING = "CRITICAL", "MAJOR", "WARNING"
SEVERITIES = [WARNING, MAJOR, CRITICAL]
VIOLATION = "struct<rule_id:string,severity:string,domain:string,column:string>"


@dataclass(frozen=True)
class Rule:
    """broken: from a column and the time of reference to the condition of a violation. table: a word that the table's name must hold."""

    id: str
    severity: str
    columns: tuple[str, ...]
    broken: Callable[[Column, Column], Column]
    table: str = ""
    each: bool = False
    always: bool = False

    @property
    def domain(self) -> str:
        return {"GEN": "general", "BNK": "banking", "ISL": "islamic"}[self.id[:3]]


def text(c: Column) -> Column:
    return c.cast("string")


def value(c: Column) -> Column:
    return fn.number(text(c))


BALANCES = ("balance", "solde", "account_balance", "cust_account_balance")
AMOUNTS = ("amount", "montant", "transaction_amount")
RATES = ("interest_rate", "taux_interet")
BIRTHS = ("date_of_birth", "dob", "customerdob")

#: Names of columns that hold what repaired() replaced.
BEFORE = "_before_"
#: Name of the column that says whether a row's reference came before.
REPEATED = "_repeated_reference"

RULES = [
    Rule("GEN-001", MAJOR, ("email",), lambda c, _: c.isNotNull() & ~fn.is_email(text(c))),
    Rule("GEN-002", MAJOR, ("phone", "telephone", "phone_contact", "telephone_agence"), lambda c, _: c.isNotNull() & fn.phone(text(c), slash=False).isNull()),
    Rule("GEN-003", CRITICAL, BIRTHS, lambda c, now: (fn.iso_date(c) <= now) & (fn.age(c, now) < fixed.MIN_AGE)),
    Rule("GEN-004", MAJOR, BIRTHS, lambda c, now: fn.age(c, now) > fixed.MAX_AGE),
    Rule("GEN-005", CRITICAL, BIRTHS, lambda c, now: fn.iso_date(c) > now),
    Rule("GEN-006", WARNING, ("gender",), lambda c, _: c.isNotNull() & fn.repaired_gender(text(c)).isNull()),
    Rule("GEN-007", MAJOR, ("country_code", "nationality"), lambda c, _: ~F.upper(fn.trimmed(text(c))).isin(fixed.COUNTRY_CODES)),
    Rule("GEN-008", CRITICAL, ("full_name", "nom", "customer_name"), lambda c, _: c.isNull() | (fn.trimmed(text(c)) == ""), each=True),
    Rule("GEN-009", MAJOR, ("created_at", "transaction_date", "open_date", "opened_date", "start_date"), lambda c, now: fn.iso_date(c) > now),
    Rule("GEN-010", MAJOR, (), lambda c, _: c.isNotNull() & (fn.word_count(text(c)) < 2), each=True),
    Rule("BNK-001", MAJOR, ("iban",), lambda c, _: c.isNotNull() & ~fn.is_iban(text(c))),
    Rule("BNK-002", CRITICAL, BALANCES, lambda c, _: value(c) < 0),
    Rule("BNK-003", CRITICAL, AMOUNTS, lambda c, _: value(c) <= 0, table="transaction"),
    Rule("BNK-004", CRITICAL, RATES, lambda c, _: value(c) < 0),
    Rule("BNK-005", CRITICAL, RATES, lambda c, _: value(c) > fixed.MAX_RATE),
    Rule("BNK-006", CRITICAL, AMOUNTS, lambda c, _: value(c) <= 0, table="credit"),
    Rule("BNK-007", MAJOR, ("duration_months",), lambda c, _: ~F.when(value(c) < 0, F.ceil(value(c))).otherwise(F.floor(value(c))).between(fixed.MIN_MONTHS, fixed.MAX_MONTHS)),
    Rule("BNK-009", MAJOR, BALANCES, lambda c, _: value(c) > fixed.MAX_BALANCE),
    Rule("BNK-010", MAJOR, AMOUNTS, lambda c, _: value(c) > fixed.MAX_AMOUNT, table="transaction"),
    Rule("BNK-011", MAJOR, ("account_status", "kyc_status", "credit_status", "status"), lambda c, _: ~F.lower(fn.trimmed(text(c))).isin(fixed.STATUSES), each=True),
    Rule("BNK-013", MAJOR, ("plafond_virement",), lambda c, _: value(c) < 0),
    Rule("BNK-014", WARNING, ("capacity",), lambda c, _: value(c) <= 0),
]
BY_ID = {r.id: r for r in RULES}
#: Rules on several columns or rows, evaluated below.
OTHERS = {"BNK-008": CRITICAL, "BNK-012": CRITICAL, "ISL-001": CRITICAL, "ISL-002": CRITICAL}
ALWAYS = {"ISL-001", "ISL-002"}
ALL_RULES = sorted([*BY_ID, *OTHERS])


def conditions(df: DataFrame, table: str, active: set[str], as_of: Column, resolver: names.Resolver) -> list[tuple[str, str, str, Column]]:
    """(rule, severity, column, condition) of what applies to the table. Repeats of the reference are to stand in REPEATED."""
    found = []
    for r in RULES:
        if r.id not in active or r.table not in table.lower():
            continue
        if r.id == "GEN-010":
            columns = [c for c in df.columns if names.is_full_name(c)]
        elif r.each:
            columns = list(dict.fromkeys(resolver.every(list(r.columns), r.id)))
        else:
            columns = [c for c in [resolver.first(list(r.columns), r.id)] if c]
        # what repaired() replaced is judged as it was
        before = lambda c: f"{BEFORE}{c}" if r.id == "GEN-006" and f"{BEFORE}{c}" in df.columns else c  # noqa: B023, E731
        found += [(r.id, r.severity, c, r.broken(quoted(before(c)), as_of)) for c in columns]
    start, end = resolver.first(["start_date"]), resolver.first(["end_date"])
    if "BNK-008" in active and start and end:
        a, b = fn.iso_date(quoted(start)), fn.iso_date(quoted(end))
        found.append(("BNK-008", CRITICAL, end, quoted(start).isNotNull() & quoted(end).isNotNull() & ~F.coalesce(a < b, F.lit(False))))
    reference = resolver.first(fixed.REFERENCE_COLUMNS)
    if "BNK-012" in active and reference:
        found.append(("BNK-012", CRITICAL, reference, F.col(REPEATED)))
    rate = resolver.first(list(RATES))
    for rule, column, kinds in (("ISL-001", resolver.first(["account_type"]), fixed.ISLAMIC_ACCOUNTS), ("ISL-002", resolver.first(["product_type", "credit_type"]), fixed.ISLAMIC_CREDITS)):
        if rule in active | ALWAYS and rate and column:
            found.append((rule, CRITICAL, column, F.lower(fn.trimmed(text(quoted(column)))).isin(kinds) & (value(quoted(rate)) != 0)))
    return found


def validated(df: DataFrame, table: str, active: set[str] | None = None, as_of: date | None = None, mapping: dict[str, str] | None = None, order: list | None = None, custom: dict[str, str] | list[Condition] | None = None) -> DataFrame:
    """df with _violations, _violation_count, _max_severity, _is_quarantined and _quarantine_reason.

    active: rule ids (all by default); the two interest rules apply always. as_of: the day that counts as today. custom: further rules, id to a
    SQL condition of a violation, which has to resolve; or conditions with severity and column, of which those that don't resolve are
    left out (conditions.resolved() tells which). order: columns that order rows (for repeated references), all columns by default.
    """
    now = F.lit(as_of) if as_of else F.current_date()
    resolver = names.Resolver(df.columns, mapping)
    active = {*ALL_RULES} if active is None else {*active}
    reference = resolver.first(fixed.REFERENCE_COLUMNS)
    if "BNK-012" in active and reference and REPEATED not in df.columns:
        df = with_repeats(df, text(quoted(reference)), order or [quoted(c) for c in df.columns], REPEATED)
    checks = conditions(df, table, active, now, resolver)
    made = [F.when(broken, F.struct(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(rule_domain(rule)).alias("domain"), F.lit(column).alias("column"))) for rule, severity, column, broken in checks]
    said = [Condition(r, c) for r, c in custom.items()] if isinstance(custom, dict) else custom or []
    df, own, wrong = resolved(df, said)
    if wrong and isinstance(custom, dict):
        raise ValueError(f"conditions that don't resolve: {wrong}")
    made += [F.when(broken, F.struct(F.lit(c.rule_id).alias("rule_id"), F.lit(c.severity).alias("severity"), F.lit("custom").alias("domain"), F.lit(c.column).alias("column"))) for c, broken in own]
    # small arrays, so that each stays within what is compiled
    parts = [F.array_compact(F.array(*made[i : i + 8])) for i in range(0, len(made), 8)]
    violations = F.concat(*parts) if parts else F.expr(f"cast(array() as array<{VIOLATION}>)")
    rank = F.array_max(F.transform("_violations", lambda v: F.array_position(F.array(*map(F.lit, SEVERITIES)), v["severity"])))
    blocking = F.filter("_violations", lambda v: v["severity"] != WARNING)
    return (
        df.withColumn("_violations", violations).drop(REPEATED, *(c for c in df.columns if c.startswith((BEFORE, PREFIX))))
        .withColumns({"_violation_count": F.size("_violations"), "_max_severity": F.coalesce(F.get(F.array(*map(F.lit, SEVERITIES)), (rank - 1).cast("int")), F.lit("NONE"))})
        .withColumns({"_is_quarantined": F.col("_max_severity").isin(MAJOR, CRITICAL), "_quarantine_reason": F.nullif(F.array_join(F.transform(F.slice(blocking, 1, 3), lambda v: F.concat(F.lit("["), v["rule_id"], F.lit("] "), v["column"])), " | "), F.lit(""))})
    )


def rule_domain(rule: str) -> str:
    return {"GEN": "general", "BNK": "banking", "ISL": "islamic"}.get(rule[:3], "custom")


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the technical columns, and quarantined rows."""
    technical = [c for c in checked.columns if c in ("_violations", "_violation_count", "_max_severity", "_is_quarantined", "_quarantine_reason", "_ground_truth")]
    return checked.where("not _is_quarantined").drop(*technical), checked.where("_is_quarantined")


def repaired(df: DataFrame) -> DataFrame:
    """Genders by the dictionary (what they were stays beside them, for the rules), and names of one word by the e-mail address; applied before the rules."""
    resolver = names.Resolver(df.columns)
    genders = resolver.every(["gender"])
    new = {c: fn.repaired_gender(text(quoted(c))) for c in genders} | {f"{BEFORE}{c}": quoted(c) for c in genders}
    if email := resolver.first(["email"]):
        new |= {c: fn.full_name_from_email(text(quoted(c)), text(quoted(email))) for c in df.columns if names.is_full_name(c)}
    return df.withColumns(new) if new else df


def ground_truth(df: DataFrame) -> DataFrame:
    """The column of that name in any case, with or without the underscore, as _ground_truth."""
    found = next((c for c in df.columns if c.lower() in ("_ground_truth", "ground_truth")), None)
    return df.withColumnRenamed(found, "_ground_truth") if found else df
