"""Value functions: Column to Column, all inside Catalyst."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions import fixed

SPACES = " \t\n\r\f\x0b"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
TOKENS = {"yyyy": "([0-9]{4})", "MMMM": "([A-Za-z]+)", "MM": "([0-9]{2})", "dd": "([0-9]{2})", "d": "([0-9]{1,2})"}
#: Forms whose parts stand at fixed places: digits and separators decide, without a regular expression.
FIXED_WIDTH = re.compile("(?:yyyy|yy|MM|dd|[-/])+")
WEEK = r"^([0-9]{4})(-?)W([0-9]{2})(?:\2([0-9]))?$"


def trimmed(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.btrim(c, F.lit(SPACES))


def null_if_token(c: Column) -> Column:
    """NULL where the value is one of the strings that mean "no value"."""
    return F.when(~F.lower(trimmed(c)).isin(fixed.NULL_TOKENS), c)


def number(c: Column) -> Column:
    """A plain number as double, else NULL; no suffixes such as ``5d``."""
    t = trimmed(c)
    return F.when(t.rlike(NUMBER), t).try_cast("double")


def clean_number(c: Column) -> Column:
    """A number without thousands separators and currency signs."""
    return number(F.regexp_replace(c, r"[,\s$€£¥]", ""))


def clean_integer(c: Column) -> Column:
    """A whole number as int; a fraction gives NULL."""
    n = clean_number(c)
    return F.when((n == F.floor(n)) & (F.abs(n) < 2.0**31), n).try_cast("int")


def date_of(c: Column, form: str) -> Column:
    """The date that has exactly this form. Two-digit years from 70 on are 19xx."""
    t = trimmed(c)
    if FIXED_WIDTH.fullmatch(form):
        fits = F.translate(t, "012345678", "999999999") == re.sub("[yMd]", "9", form)
        part = {token: F.substring(t, form.index(token) + 1, len(token)) for token in re.findall("y+|M+|d+", form)}
    else:
        pattern, order = "", []
        for piece in re.findall(r"yyyy|MMMM|MM|dd|d|.", form):
            order += [piece] if piece in TOKENS else []
            pattern += TOKENS.get(piece, piece)
        fits = t.rlike(f"^{pattern}$")
        part = {token: F.regexp_extract(t, f"^{pattern}$", i + 1) for i, token in enumerate(order)}
    year = part["yyyy"] if "yyyy" in part else F.concat(F.when(part["yy"] >= "70", "19").otherwise("20"), part["yy"])
    month = part.get("MM", F.lit("01"))
    if "MMMM" in part:
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(part["MMMM"])).cast("string")
    return F.when(fits, F.concat_ws("-", year, month, part.get("dd", part.get("d", F.lit("01"))))).try_cast("date")


def parsed_date(c: Column, formats: list[str] | None = None) -> Column:
    """The first format that fits decides."""
    return F.coalesce(*(date_of(c, f) for f in formats or fixed.DATE_FORMATS + fixed.MORE_DATE_FORMATS))


def week_date(c: Column) -> Column:
    """The date of an ISO week, with or without its day: ``2024-W05-3``, ``2024W053``, ``2024-W05`` (its Monday)."""
    year, week, day = F.regexp_extract(c, WEEK, 1).try_cast("int"), F.regexp_extract(c, WEEK, 3).try_cast("int"), F.regexp_extract(c, WEEK, 4)
    day = F.when(day == "", 1).otherwise(day.try_cast("int"))
    # the fourth of January is always in week 1
    fourth = F.make_date(F.when(year > 0, year), F.lit(1), F.lit(4))
    monday = F.date_add(fourth, 7 * (week - 1) - F.weekday(fourth))
    return F.when((F.weekofyear(monday) == week) & day.between(1, 7), F.date_add(monday, day - 1))


def iso_date(c: Column) -> Column:
    """The date that the first ten characters hold as yyyy-MM-dd, yyyyMMdd or an ISO week."""
    head = F.substring(c.cast("string"), 1, 10)
    return F.coalesce(date_of(head, "yyyy-MM-dd"), date_of(head, "yyyyMMdd"), week_date(head))


def epoch_text(c: Column) -> Column:
    """Seconds or (over 1e10) milliseconds since 1970 as ``yyyy-MM-dd HH:mm:ss``, UTC."""
    n = number(c.cast("string"))
    seconds = F.floor(F.when(n > 1e10, n / 1000).otherwise(n))
    return F.date_format(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")), "yyyy-MM-dd HH:mm:ss")


def cased(c: Column, how: str) -> Column:
    return {"lower": F.lower, "upper": F.upper, "title": F.initcap}[how](trimmed(c))


def phone(c: Column, slash: bool = True) -> Column:
    """A Tunisian number as its eight digits, else NULL."""
    t = F.regexp_replace(c, r"[\s\-.()/]" if slash else r"[\s\-.()]", "")
    t = F.when(t.startswith("+216"), F.substring(t, 5, 40)).when(t.startswith("00216"), F.substring(t, 6, 40)).when(t.startswith("216") & (F.length(t) == 11), F.substring(t, 4, 40)).otherwise(t)
    t = F.when(t.startswith("0") & (F.length(t) == 9), F.substring(t, 2, 40)).otherwise(t)
    return F.when(t.rlike(r"^[234579][0-9]{7}$"), t)


def is_email(c: Column) -> Column:
    return trimmed(c).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$")


def is_iban(c: Column) -> Column:
    return F.upper(F.replace(c, F.lit(" "), F.lit(""))).rlike(r"^TN[0-9]{22}$")


def age(c: Column, as_of: Column) -> Column:
    return F.date_diff(as_of, iso_date(c)) / 365.25


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(trimmed(c), r"\s+"), lambda w: w != ""))


def repaired_gender(c: Column) -> Column:
    """m, f or the value itself if it is valid; NULL where the dictionary does not know it."""
    t = F.lower(trimmed(c))
    return F.when(t.isin(fixed.GENDERS), t).when(t.isin(fixed.MALE_WORDS), "m").when(t.isin(fixed.FEMALE_WORDS), "f")


def full_name_from_email(name: Column, email: Column) -> Column:
    """A name of one word is replaced by the words of the address's local part, if there are two."""
    words = F.split(F.regexp_extract(email, r"^([A-Za-z]+[._][A-Za-z]+)@", 1), "[._]")
    return F.when((word_count(name) == 1) & (F.size(words) == 2), F.initcap(F.array_join(words, " "))).otherwise(name)


def iso_epoch(c: Column) -> Column:
    """Seconds since 1970 of an ISO timestamp, in UTC where it names no zone; NULL if it is none."""
    return F.unix_timestamp(F.regexp_replace(c, r"Z$", "+00:00").try_cast("timestamp"))


def metric_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9_]", "_")


def labels(c: Column) -> Column:
    """``a="b",c="d"`` as a map."""
    return F.transform_values(F.str_to_map(c, F.lit(","), F.lit("=")), lambda _, v: F.btrim(v, F.lit('"')))
