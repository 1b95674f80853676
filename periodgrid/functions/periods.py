"""The grammar of period labels (``Ene``, ``Ene.1``, ``Ene - mar.2``) as column expressions.

The expressions are pure, so on a literal label Catalyst folds them to constants: the wide
path pays for them once per column, never per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Month abbreviations, in calendar order, as the sheets spell them.
MONTHS_ES = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")

# First and last first-of-month that a nanosecond timestamp can hold; beyond them the
# series carries no date.
FIRST_DATE, LAST_DATE = "1677-10-01", "2262-04-01"


@dataclass(frozen=True)
class PeriodGrammar:
    """How labels are read. ``max_suffix`` bounds monthly labels only, never moving quarters.

    ``fix_star_suffix`` reads the suffix after dropping stars, so that ``Abr.1*`` is one year
    after ``Abr``; the default keeps the suffix of the raw label, which gives 0 there.
    """

    base_year: int = 2021
    max_suffix: int = 4
    months: tuple[str, ...] = MONTHS_ES
    fix_star_suffix: bool = False

    @property
    def month_start(self) -> str:
        return "^(" + "|".join(self.months) + ")"


DEFAULT_GRAMMAR = PeriodGrammar()


def without_stars(label: Column) -> Column:
    return F.replace(label, F.lit("*"), F.lit(""))


def period_is_valid(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """Does a column with this label hold one period?"""
    clean = without_stars(label)
    rest = F.regexp_replace(clean, grammar.month_start, "")
    digits = F.regexp_extract(rest, r"^\.(\d+)$", 1)
    bounded = (digits != "") & (digits.try_cast("int") <= grammar.max_suffix)
    shape = (rest == "") | F.coalesce(bounded, F.lit(False)) | rest.rlike("^ - [a-zA-Z]+")
    return F.coalesce(clean.rlike(grammar.month_start) & shape, F.lit(False))


def period_month(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """Month abbreviation a label starts with (of a moving quarter: its first month)."""
    found = F.regexp_extract(without_stars(label), grammar.month_start, 1)
    return F.when(found != "", found)


def period_suffix(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """Trailing ``.<digits>`` as INT, 0 without one, NULL beyond the INT range."""
    source = without_stars(label) if grammar.fix_star_suffix else label
    digits = F.regexp_extract(source, r"\.(\d+)$", 1)
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))


def month_number(month: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """1-12 for a known abbreviation, else NULL."""
    names = F.array(*[F.lit(name) for name in grammar.months])
    position = F.array_position(names, month).cast("int")
    return F.when(position > 0, position)


def period_year(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    return F.try_add(F.lit(grammar.base_year), period_suffix(label, grammar))


def first_of_month(year: Column, month: Column) -> Column:
    """The date of a month's first day, NULL when there is none."""
    sound = month.between(1, 12) & year.between(1, 9999)
    return F.when(sound, F.make_date(year, month, F.lit(1)))


def period_date(year: Column, month: Column) -> Column:
    day = first_of_month(year, month)
    return F.when(day.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), day)


def period_columns(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> dict[str, Column]:
    """``anio, mes, mes_num, fecha, periodo`` of one label, in the order of the long table."""
    month = period_month(label, grammar)
    number = month_number(month, grammar)
    year = period_year(label, grammar)
    return {
        "anio": year,
        "mes": month,
        "mes_num": number,
        "fecha": period_date(year, number),
        "periodo": label,
    }


def period_struct(label: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """The period of a valid label as a struct, NULL for any other label."""
    parts = [col.alias(name) for name, col in period_columns(label, grammar).items()]
    return F.when(period_is_valid(label, grammar), F.struct(*parts))
