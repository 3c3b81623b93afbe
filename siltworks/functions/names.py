"""What names of columns and tables tell; plain functions for the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable

from siltworks.functions import fixed


def snake(name: str) -> str:
    name = re.sub(r"(?<=[A-Z])(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[\s.-]+", "_", name).lower().strip("_")


def contains(name: str, words: Iterable[str]) -> bool:
    return any(w in name.lower() for w in words)


def is_financial(name: str, whole_words: bool = False) -> bool:
    """whole_words: ``account`` is then no ``count``."""
    return bool({*re.split("[^a-z]+", name.lower())} & {*fixed.FINANCIAL_WORDS}) if whole_words else contains(name, fixed.FINANCIAL_WORDS)


def is_gender(name: str) -> bool:
    return contains(name, fixed.GENDER_WORDS)


def is_date(name: str, declared: str = "") -> bool:
    return declared == "date" or not is_gender(name) and (contains(name, fixed.DATE_SUBSTRINGS) or bool({*name.lower().split("_")} & {*fixed.DATE_TOKENS}))


def is_full_name(name: str) -> bool:
    return contains(name, fixed.FULL_NAME_WORDS)


def phone_columns(columns: list[str], named: Iterable[str] = ()) -> list[str]:
    return [c for c in named if c in columns] or [c for c in columns if contains(c, fixed.PHONE_WORDS)]


def epoch_columns(columns: list[str], named: Iterable[str] = ()) -> list[str]:
    return [c for c in named if c in columns and not is_financial(c)]


def domain(table: str, columns: list[str]) -> str:
    names = " ".join(columns)
    for at, known in ((names, fixed.COLUMN_DOMAINS), (table, fixed.TABLE_DOMAINS)):
        for found, words in known:
            if contains(at, words):
                return found
    return "generic"


class Resolver:
    """Finds a table's column by name, in any case; a mapping by rule goes first where it names a column that exists."""

    def __init__(self, columns: list[str], mapping: dict[str, str] | None = None):
        self.by_lower = {c.lower(): c for c in columns}
        self.mapping = {r: self.by_lower[c.lower()] for r, c in (mapping or {}).items() if c and c.lower() in self.by_lower}

    def first(self, names: list[str], rule: str = "") -> str | None:
        return self.mapping.get(rule) or next((self.by_lower[n] for n in names if n in self.by_lower), None)

    def every(self, names: list[str], rule: str = "") -> list[str]:
        return [self.mapping[rule]] if rule in self.mapping else [self.by_lower[n] for n in names if n in self.by_lower]
