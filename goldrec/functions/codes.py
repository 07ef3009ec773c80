"""Code, number and date expressions with dictionary look-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions.text import strip


def code_text(c: Column) -> Column:
    """Canonical text of an integer code: '5458', '5458.0' and 5458 agree (NUM-01).

    Text that is not a number gives null.
    """
    number = c.cast("string").try_cast("double")
    in_range = number.between(-2147483648.0, 2147483647.0)
    return F.when(in_range, number).cast("int").cast("string")


def literal_map(mapping: dict[str, str]) -> Column:
    """A small fixed dictionary as one constant of the plan."""
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def literal_list(values: list[str]) -> Column:
    """A small fixed list as one constant of the plan."""
    return F.array(*[F.lit(v) for v in values])


def lookup(mapping: dict[str, str], c: Column) -> Column:
    """Dictionary value of a code, null when the code is unknown (JOIN-05).

    Only for the small fixed vocabularies; larger dictionaries are joined.
    """
    return F.try_element_at(literal_map(mapping), c)


def member(c: Column, codes: list[str]) -> Column:
    """Code is in the list; null gives false (FLT-01, DRV-01)."""
    return F.coalesce(c.isin(codes), F.lit(False))


def active_status(c: Column) -> Column:
    """'A' is true, 'C' is false, anything else unknown (DRV-05)."""
    s = strip(c)
    return F.when(s == "A", True).when(s == "C", False)


def positive_flag(c: Column) -> Column:
    """'O' is true, anything else unknown (DRV-06)."""
    return F.when(strip(c) == "O", True)


def truthy(c: Column) -> Column:
    """A survey flag does not say no: only 0 and False fail, null passes (FLT-04)."""
    text = F.lower(strip(c.cast("string")))
    not_zero = F.coalesce(text.try_cast("double") != 0, F.lit(True))
    return F.coalesce((text != "false") & not_zero, F.lit(True))


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Banker's rounding (NUM-02)."""
    return F.bround(c, digits)


def filled_count(columns: list[Column]) -> Column:
    """Number of non-null fields of a row (NUM-03)."""
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total


def lenient_timestamp(c: Column) -> Column:
    """Timestamp of a text, null when it cannot be read (DAT-01)."""
    return F.try_to_timestamp(c.cast("string"))


def iso_date(c: Column) -> Column:
    """Date as ISO text (DAT-02)."""
    return F.date_format(c, "yyyy-MM-dd")
