"""Threshold bands and ordered first-match rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import plain_text
from ..session import local_rows

# Labels of the severity classes and of the recommended instruments.
HIGH, MEDIUM, LOW = "ALTA", "MEDIA", "BAJA"
MIXED = "INTERVENCIÓN MIXTA (Formación + Subsidio)"
TRAINING = "FORMACIÓN TÉCNICA"
SUBSIDY = "SUBSIDIO A CONTRATACIÓN"
MONITORING = "MONITOREO"

# The parts of the written reason, in order.
REASON_TEXT = (
    "Ciudad con ",
    " severidad (",
    " mil informales). Índice vulnerabilidad educativa: ",
    ". Indica que la población con baja educación tiene ",
    "% más informalidad que universitarios.",
)

PRIORITY_ORDER = (HIGH, MEDIUM, LOW)


@dataclass(frozen=True)
class Thresholds:
    """Bands in thousands of people, and the index from which training pays."""

    high: float = 1000.0
    medium: float = 400.0
    index: float = 0.65


@dataclass(frozen=True)
class Rule:
    """A label for rows of one severity whose index reaches ``min_index`` (if there is one)."""

    severity: str
    label: str
    min_index: float | None = None


def default_rules(thresholds: Thresholds = Thresholds()) -> tuple[Rule, ...]:
    return (
        Rule(HIGH, MIXED, thresholds.index),
        Rule(MEDIUM, TRAINING, thresholds.index),
        Rule(LOW, SUBSIDY),
    )


def severity_band(value: Column, thresholds: Thresholds = Thresholds()) -> Column:
    """ALTA above the high threshold, MEDIA above the medium one, BAJA for the rest and NULL."""
    return (
        F.when(value > thresholds.high, HIGH)
        .when(value > thresholds.medium, MEDIUM)
        .otherwise(LOW)
    )


def priority(severity: Column) -> Column:
    return F.when(severity.isin(HIGH, MEDIUM), severity).otherwise(LOW)


def priority_rank(label: Column) -> Column:
    """1 for the most urgent label; the labels themselves sort alphabetically, not by urgency."""
    chain = F.when(label == PRIORITY_ORDER[0], 1)
    for position, name in enumerate(PRIORITY_ORDER[1:], 2):
        chain = chain.when(label == name, position)
    return chain.otherwise(len(PRIORITY_ORDER) + 1)


def first_match(
    severity: Column, index: Column, rules: Sequence[Rule], default: str = MONITORING
) -> Column:
    """Label of the first rule that holds; a rule with a bound never holds for a NULL index."""
    chain = None
    for rule in rules:
        holds = severity == rule.severity
        if rule.min_index is not None:
            holds = holds & (index >= rule.min_index)
        chain = F.when(holds, rule.label) if chain is None else chain.when(holds, rule.label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(i, r.severity, r.min_index, r.label) for i, r in enumerate(rules, 1)]
    named = local_rows(spark, ("regla", "severidad", "minimo", "etiqueta"), rows)
    return named.withColumn("minimo", F.col("minimo").cast("double"))


def first_match_by_table(
    rows: DataFrame,
    rules: DataFrame,
    severity: str = "severidad_informalidad",
    index: str = "indice_vulnerabilidad_educativa",
    name: str = "instrumento_recomendado",
    default: str = MONITORING,
) -> DataFrame:
    """The same decision with the rules as data.

    The table folds into one row that every task holds; rows are neither multiplied by the
    rules nor grouped again.
    """
    packed = rules.agg(
        F.array_sort(
            F.collect_list(F.struct("regla", "severidad", "minimo", "etiqueta"))
        ).alias("_rules")
    )
    held = F.filter(
        F.col("_rules"),
        lambda rule: (rule["severidad"] == F.col(severity))
        & (rule["minimo"].isNull() | F.coalesce(F.col(index) >= rule["minimo"], F.lit(False))),
    )
    label = F.coalesce(F.get(held, F.lit(0))["etiqueta"], F.lit(default))
    joined = rows.crossJoin(F.broadcast(packed))
    return joined.select(*rows.columns, label.alias(name))


def reason(severity: Column, value: Column, index: Column) -> Column:
    """The written reason; NULL when any part is missing."""
    start, after_severity, after_value, after_index, end = (F.lit(t) for t in REASON_TEXT)
    gap = F.round((index - 1) * 100, 0)
    return F.concat(
        start,
        F.lower(severity),
        after_severity,
        plain_text(F.round(value, 0)),
        after_value,
        plain_text(index),
        after_index,
        plain_text(gap),
        end,
    )


def recommend(features: DataFrame, rules: Sequence[Rule] = default_rules()) -> DataFrame:
    """Features plus instrument, priority and reason, in one projection."""
    severity = F.col("severidad_informalidad")
    index = F.col("indice_vulnerabilidad_educativa")
    value = F.col("tasa_informalidad_promedio_miles")
    return features.select(
        "*",
        first_match(severity, index, rules).alias("instrumento_recomendado"),
        priority(severity).alias("prioridad"),
        reason(severity, value, index).alias("justificacion"),
    )
