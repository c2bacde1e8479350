"""Readers of posted quotes. Each feed has its own grammar, and none reads another's cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.functions.text import SPACE, SPACES

_TICK_MARK = "['\\u2019-]"


def round_half_up(x: Column) -> Column:
    """To the nearest integer, halves toward plus infinity."""
    return F.floor(x + F.lit(0.5))


def round_to(x: Column, places: int) -> Column:
    return round_half_up(x * 10**places) / F.lit(float(10**places))


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def parse_num(text: Column) -> Column:
    """The number a cell starts with; `$`, commas and spaces dropped, parentheses negative."""
    t = _trimmed(text)
    wrapped = t.startswith("(") & t.rlike(r"^\(.*\)$")
    bare = F.translate(F.when(wrapped, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t), "$," + SPACES, "")
    value = F.nullif(F.regexp_extract(bare, r"^[+-]?([0-9]*\.?[0-9]+)", 1), F.lit("")).try_cast("double")
    return F.when(wrapped | bare.startswith("-"), -value).otherwise(value)


def parse_ticks(text: Column) -> Column:
    """`459-4` and `478'6` are whole cents and eighths; a tick shape that does not read is null."""
    t = _trimmed(text)
    # One match puts sign, whole cents and eighths apart; what begins as ticks and does not read to its end stays as it is and has no parts.
    parts = F.split(F.regexp_replace(t, rf"^([+-]?)([0-9]+){_TICK_MARK}([0-9]+)[a-zA-Z]*$", "$1 $2 $3"), " ")
    read = lambda p: F.when(p[2].try_cast("int") <= 7, F.when(p[0] == "-", -1.0).otherwise(1.0) * (p[1].try_cast("double") + p[2].try_cast("int") / 8))
    ticks = F.get(F.transform(F.array(parts), lambda p: F.when(F.size(p) == 3, read(p))), F.lit(0))
    return F.when(t.rlike(rf"^[+-]?[0-9]+{_TICK_MARK}[0-9]"), ticks).otherwise(parse_num(t))


def parse_eighths(text: Column) -> Column:
    """The grid feed's own reader: one digit of eighths, not checked, and no sign."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]*>", " "), "&nbsp;", " ")
    t = F.trim(F.regexp_replace(F.trim(F.regexp_replace(t, SPACE + "+", " ")), "s$", ""))
    whole, part = (F.regexp_extract(t, r"^([0-9]+)'([0-9])$", k).try_cast("double") for k in (1, 2))
    plain = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)$", 1).try_cast("double")
    return F.when(t.rlike(r"^[0-9]+'[0-9]$"), whole + part / 8).when(t.rlike("^[0-9]+'"), F.lit(None)).otherwise(plain)


def tick_flag(text: Column) -> Column:
    """The letters after a quote, in lower case."""
    return F.nullif(F.lower(F.regexp_extract(_trimmed(text), rf"^[+-]?[0-9]+(?:{_TICK_MARK}[0-9]+|\.[0-9]+)?([a-zA-Z]+)$", 1)), F.lit(""))


def basis_to_cents(value: Column, raw: Column | None = None) -> Column:
    """Basis in cents: the text's decimal point says dollars; without a text, below 3 is dollars."""
    dollars, cents = round_half_up(value * 100).cast("int"), round_half_up(value).cast("int")
    by_size = F.when(F.abs(value) < 3, dollars).otherwise(cents)
    if raw is None:
        return by_size
    t = F.coalesce(_trimmed(raw), F.lit(""))
    return F.when(t.rlike(r"\.[0-9]"), dollars).when(t != "", cents).otherwise(by_size)


def strict_decimal(text: Column) -> Column:
    """A whole cell that is a plain decimal number, else null."""
    return F.regexp_extract(F.trim(text), r"^([+-]?[0-9]+(?:\.[0-9]+)?)$", 1).try_cast("double")


def strict_money(text: Column) -> Column:
    """`strict_decimal` after a leading `$` and commas are dropped."""
    return strict_decimal(F.regexp_replace(F.regexp_replace(F.trim(text), r"^\$", ""), ",", ""))


def loose_number(text: Column) -> Column:
    """What a script's Number() reads of a trimmed text; empty is null."""
    t = F.trim(text)
    decimal = F.when(t.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), t.try_cast("double"))
    hexadecimal = F.when(t.rlike("^0[xX][0-9a-fA-F]{1,15}$"), F.conv(F.substring(t, 3, 20), 16, 10).try_cast("double"))
    return F.coalesce(decimal, hexadecimal)


# Cents in one unit of a futures quote.
FUTURES_UNITS = {"cents": 1, "ticks": 1, "dollars": 100}


def futures_scale(unit: Column) -> Column:
    """Null for a unit that is not known, which refuses the source."""
    name = F.lower(F.coalesce(unit, F.lit("cents")))
    return F.element_at(F.create_map(*(F.lit(x) for pair in FUTURES_UNITS.items() for x in pair)), name)


def rounding_explains(mode: Column, signed: Column) -> Column:
    """Whether a declared way of rounding cash accounts for quote minus derived cents; null if none is declared."""
    return (
        F.when(mode == "floor-cent", (signed >= 0) & (signed < 1))
        .when(mode == "round-cent", (signed >= -0.5) & (signed < 0.5))
    )


def decimals(value: Column) -> Column:
    """Digits after the point of a number's shortest text; none for a whole number."""
    part = F.coalesce(F.get(F.split(value.cast("string"), r"\."), F.lit(1)), F.lit(""))
    return F.when(part == "0", F.lit(0)).otherwise(F.length(part))
