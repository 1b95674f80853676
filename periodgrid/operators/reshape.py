"""Wide period sheets to one row per (concept, period).

Two inputs, one result. A wide table (one column per period) goes through ``to_long``; rows
of sheets with differing headers (``sources`` yields them as ``headed rows``) go through
``headed_rows_to_long``. Neither shuffles: a row of the sheet becomes its long rows in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..functions.periods import (
    DEFAULT_GRAMMAR,
    PeriodGrammar,
    period_columns,
    period_is_valid,
)
from ..functions.text import na_to_null, nan_to_null, once, tolerant_number
from ..session import local_rows, sql_literal

PERIOD_TYPES = {
    "anio": "int", "mes": "string", "mes_num": "int", "fecha": "date", "periodo": "string",
}
LONG_COLUMNS = (*PERIOD_TYPES, "valor")


def label_frame(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """Column names as rows ``(posicion, etiqueta)``, for expressions over metadata."""
    if not labels:
        return spark.createDataFrame([], "posicion int, etiqueta string")
    return local_rows(spark, ("posicion", "etiqueta"), list(enumerate(labels)))


def read_labels(
    spark: SparkSession, labels: Sequence[str], grammar: PeriodGrammar = DEFAULT_GRAMMAR
) -> list[Row]:
    """``posicion`` and period of each label that is one.

    Evaluated on a local relation of column names: no job, no data read.
    """
    label = F.col("etiqueta")
    parts = [col.alias(name) for name, col in period_columns(label, grammar).items()]
    frame = label_frame(spark, labels).where(period_is_valid(label, grammar))
    return sorted(frame.select("posicion", *parts).collect(), key=lambda row: row.posicion)


def spread(rows: DataFrame, concept: str, label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """One row per concept, one column per label, from rows that are one per concept and label.

    The cells of a concept travel as a list of those it has, told by their place among the labels.
    A pivot keeps a whole wide row for each concept it has met, and before the shuffle by concept
    that is one for nearly each cell; lists are sorted by concept and held for one at a time.
    Other labels are left out, their concepts are not.
    """
    place = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col(label))
    cell = F.when(place > 0, F.struct(place.cast("int").alias("place"), F.col(value).alias("value")))
    lists = rows.select(concept, cell.alias("_cell")).repartition(concept)
    cells = lists.groupBy(concept).agg(F.collect_list("_cell").alias("_cells"))
    # The places without a cell are added, so that each label is read by its position.
    free = F.array_except(F.array(*[F.lit(i) for i in range(1, len(labels) + 1)]), F.col("_cells.place"))
    empty = F.lit(None).cast(rows.schema[value].dataType)
    blank = F.transform(free, lambda place: F.struct(place.alias("place"), empty.alias("value")))
    row = cells.select(concept, F.sort_array(F.concat("_cells", blank))["value"].alias("_row"))
    return row.select(concept, *[F.get("_row", F.lit(i)).alias(name) for i, name in enumerate(labels)])


def column_accounting(
    sheets: DataFrame, labels: str, grammar: PeriodGrammar = DEFAULT_GRAMMAR, by: Sequence[str] = ()
) -> DataFrame:
    """Per group: columns in all, kept as periods, filtered out (the first column not counted)."""
    tail = F.slice(F.col(labels), 2, F.greatest(F.size(labels) - 1, F.lit(0)))
    one = sheets.select(*by, F.explode(tail).alias("_label"))
    kept = F.count_if(period_is_valid(F.col("_label"), grammar))
    total = F.count(F.lit(1))
    return one.groupBy(*by).agg(
        total.alias("columnas"), kept.alias("validas"), (total - kept).alias("filtradas")
    )


def _typed_literal(value, kind: str) -> str:
    return f"CAST(NULL AS {kind})" if value is None else sql_literal(value)


def _with_number(
    rows: DataFrame, column: str, kind: T.DataType, error: str | None = None
) -> DataFrame:
    """``column`` as DOUBLE ``valor`` in last place; rows without a number or error dropped."""
    others = [name for name in rows.columns if name != column]
    if isinstance(kind, T.StringType):
        number = once(tolerant_number(F.col(column)))
    else:
        number = nan_to_null(F.col(column).cast("double"))
    kept = F.col("valor").isNotNull()
    if error is not None:
        kept = kept | F.col(error).isNotNull()
    return rows.select(*others, number.alias("valor")).where(kept)


def to_long(
    wide: DataFrame,
    concept: str = "indicador",
    grammar: PeriodGrammar = DEFAULT_GRAMMAR,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``concept, anio, mes, mes_num, fecha, periodo, valor`` from a wide table.

    The first column becomes the concept; ``keep`` names further columns to carry along.
    Columns that are no period are never read. Everything about a period is a constant of its
    column, so the only work per cell is the numeric parse.
    """
    names = wide.columns
    periods = {row.posicion + 1: row for row in read_labels(wide.sparkSession, names[1:], grammar)}
    chosen = list(periods)
    slots = [f"_c{i}" for i in range(len(names))]
    kinds = [field.dataType for field in wide.schema.fields]
    uniform = len({kinds[i].simpleString() for i in chosen}) == 1
    kind = kinds[chosen[0]] if uniform else T.StringType()

    carried = [f"{slots[names.index(name)]} AS `{name}`" for name in keep]
    identity = f"CAST(_c0 AS STRING) AS `{concept}`"
    base = wide.toDF(*slots)
    if not chosen:
        types = {**PERIOD_TYPES, "valor": "double"}
        columns = [f"CAST(NULL AS {t}) AS {name}" for name, t in types.items()]
        return base.where(F.lit(False)).selectExpr(identity, *carried, *columns)

    cells = [slots[i] if uniform else f"CAST({slots[i]} AS STRING)" for i in chosen]
    exploded = f"posexplode(array({', '.join(cells)})) AS (_at, _cell)"
    rows = base.selectExpr(identity, *carried, exploded).where(F.col("_cell").isNotNull())
    parsed = _with_number(rows, "_cell", kind)
    # The period of a cell is looked up by position, and only for cells that hold a number.
    known = [
        f"array({', '.join(_typed_literal(periods[i][name], t) for i in chosen)})[_at] AS {name}"
        for name, t in PERIOD_TYPES.items()
    ]
    return parsed.selectExpr(f"`{concept}`", *[f"`{name}`" for name in keep], *known, "valor")


def headed_rows_to_long(
    rows: DataFrame, keep: Sequence[str] = (), error: str | None = None
) -> DataFrame:
    """``concepto`` plus the long columns from rows that carry the periods of their header.

    ``periodos`` (see ``promote_header``) is paired with ``celdas`` before the explode, so that
    the header itself is not copied into the long rows. Rows with something in the ``error``
    column pass through without a value.
    """
    pairs = F.arrays_zip(F.col("periodos").alias("p"), F.col("celdas").alias("c"))
    kept = F.col("_pair.p").isNotNull() & F.col("_pair.c").isNotNull()
    if error is not None:
        pairs = F.when(F.col(error).isNull(), pairs).otherwise(F.array(F.lit(None)))
        kept = kept | F.col(error).isNotNull()
    long = rows.select(
        *keep,
        na_to_null(F.get(F.col("celdas"), F.lit(0))).alias("concepto"),
        F.explode(pairs).alias("_pair"),
    ).where(kept)
    flat = long.select(
        *keep,
        "concepto",
        *[F.col(f"_pair.p.{name}").alias(name) for name in LONG_COLUMNS[:-1]],
        F.col("_pair.c").alias("_cell"),
    )
    return _with_number(flat, "_cell", T.StringType(), error)


def explode_cells(rows: DataFrame, cells: str = "celdas") -> DataFrame:
    """The cell grid ``(..., col_idx, cell)`` of a row grid; empty cells are not emitted."""
    others = [name for name in rows.columns if name != cells]
    return rows.select(*others, F.posexplode(cells).alias("col_idx", "cell")).where(
        na_to_null(F.col("cell")).isNotNull()
    )

