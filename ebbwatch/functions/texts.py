"""Text built from rows, and tokens built from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions.scalar import as_column, band


def yes_no(flag: str) -> Column:
    return F.when(F.col(flag) != 0, F.lit("si")).otherwise(F.lit("no"))


def balance_level(balance: Column | str) -> Column:
    """Balance band with its own name for exactly zero."""
    balance = as_column(balance)
    return F.when(balance == 0, F.lit("nulo")).otherwise(band(balance, K.BALANCE_CUTS, K.LEVEL_LABELS))


def salary_level(salary: Column | str) -> Column:
    return band(salary, K.SALARY_CUTS, K.LEVEL_LABELS)


def credit_level(score: Column | str) -> Column:
    return band(score, K.CREDIT_CUTS, K.CREDIT_LABELS)


def labelled_row_text() -> Column:
    """Demographic row as twelve ``name: value`` pairs."""
    complaints = F.col("quejas_recibidas")
    values = (
        F.col("edad").cast("string"),
        F.col("genero"),
        F.col("pais"),
        F.concat(F.col("antiguedad_años").cast("string"), F.lit(" años")),
        balance_level("saldo"),
        F.col("num_productos").cast("string"),
        yes_no("tiene_tarjeta"),
        yes_no("miembro_activo"),
        salary_level("salario_estimado"),
        F.when(complaints == 0, F.lit("ninguna")).otherwise(complaints.cast("string")),
        yes_no("uso_app_movil"),
        credit_level("score_credito"),
    )
    pairs = [F.concat(F.lit(f"{name}: "), value) for name, value in zip(K.ROW_TEXT_NAMES, values)]
    return F.concat_ws(", ", *pairs)


def sentence(number: str, cases, otherwise: str | None) -> Column:
    """The first sentence whose predicate holds, with the number filled in; null when none does."""

    def fill(template: str) -> Column:
        return F.format_string(template, F.expr(number))

    result = F.lit(None).cast("string") if otherwise is None else fill(otherwise)
    for predicate, template in reversed(cases):
        result = F.when(F.expr(predicate), fill(template)).otherwise(result)
    return result


def narrative() -> Column:
    """Behaviour row as up to seven sentences; the last two are dropped in their middle bands."""
    return F.concat_ws(" ", *[sentence(*parts) for parts in K.NARRATIVE_SENTENCES])


def words(text: Column | str) -> Column:
    """Lower-case tokens of letters and digits, empty tokens removed."""
    parts = F.split(F.lower(as_column(text)), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: F.length(w) > 0)
