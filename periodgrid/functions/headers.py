"""Header rows: names for blank and repeated labels, as array expressions over one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .periods import DEFAULT_GRAMMAR, PeriodGrammar, period_struct
from .text import once, strip_ws


def fill_blank_labels(header: Column) -> Column:
    """A blank header cell at position ``i`` (from 0) is named ``Unnamed: i``."""
    return F.transform(
        header,
        lambda label, i: F.when(
            F.coalesce(label, F.lit("")) == "", F.concat(F.lit("Unnamed: "), i.cast("string"))
        ).otherwise(label),
    )


def number_repeats(header: Column) -> Column:
    """The k-th repeat of a label gets the k-th free suffix ``.1``, ``.2``, ...

    A suffix is not free when the sheet already spells it out: ``Ene, Ene.1, Ene`` ends as
    ``Ene, Ene.1, Ene.2``.
    """

    def rename(label: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(header, F.lit(1), i), lambda other: other == label))
        spelled = F.filter(
            F.transform(
                F.filter(header, lambda other: other.startswith(F.concat(label, F.lit(".")))),
                lambda other: F.substring(other, F.length(label) + 2, F.length(other)),
            ),
            lambda tail: tail.rlike("^[1-9][0-9]{0,8}$"),
        )
        taken = F.array_sort(F.array_distinct(F.transform(spelled, lambda tail: tail.cast("int"))))
        suffix = F.aggregate(taken, earlier, lambda k, used: F.when(used <= k, k + 1).otherwise(k))
        return F.when(earlier == 0, label).otherwise(
            F.concat(label, F.lit("."), suffix.cast("string"))
        )

    return F.transform(header, rename)


def header_periods(labels: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR) -> Column:
    """Per column the period it holds, NULL for the concept column and for other columns."""
    return F.transform(
        labels, lambda label, i: F.when(i > 0, period_struct(label, grammar))
    )


def promote_header(
    rows: DataFrame, header: Column, grammar: PeriodGrammar = DEFAULT_GRAMMAR
) -> DataFrame:
    """Add ``etiquetas`` and ``periodos`` from a raw header: fill, number, then trim.

    The filled header is pinned to a column of its own: numbering looks at all labels for each
    label, and must not work the header out anew every time.
    """
    filled = rows.select("*", once(fill_blank_labels(header)).alias("_filled"))
    labelled = filled.withColumn(
        "etiquetas", F.transform(number_repeats(F.col("_filled")), strip_ws)
    ).drop("_filled")
    return labelled.withColumn("periodos", header_periods(F.col("etiquetas"), grammar))
