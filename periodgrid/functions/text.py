"""Text and cell normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cell texts that a spreadsheet reader takes for "no value".
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A number as a tolerant reader accepts it. The guard keeps out forms that a plain cast
# would take (``1.0d``, ``1f``, hexadecimal floats) and spares the cast its failure path.
NUMBER_TEXT = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
INFINITY_TEXT = r"^\s*[+-]?[iI][nN][fF](?:[iI][nN][iI][tT][yY])?\s*$"


def strip_ws(text: Column) -> Column:
    """Drop all leading and trailing white space, not only blanks as SQL ``trim`` does."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TEXTS), text)


def tolerant_number(text: Column) -> Column:
    """Text to DOUBLE; what is not a number becomes NULL, infinity is kept."""
    readable = text.rlike(NUMBER_TEXT) | text.rlike(INFINITY_TEXT)
    return F.when(readable, text.try_cast("double"))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def plain_text(number: Column) -> Column:
    """A DOUBLE as people write it: Spark's text of it has an exponent from ten million on.

    Beyond 20 digits before the point the exponent stays.
    """
    text = number.cast("string")
    digits = F.regexp_replace(number.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(number) >= 1e7, F.coalesce(digits, text)).otherwise(text)


def metric_key(label: Column) -> Column:
    """A label as part of a metric name: blanks to ``_``, parentheses dropped."""
    return F.translate(label, " ()", "_")


def once(value: Column) -> Column:
    """``value`` as a one-element generator, so that it is computed once per row.

    A filter on a computed column is otherwise pushed below it and computes it a second time;
    worth it for regular expressions on every cell.
    """
    return F.explode(F.array(value))
