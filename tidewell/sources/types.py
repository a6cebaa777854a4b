"""Column types from text: bigint, double, boolean, string, in this order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Texts of the two booleans.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

WHOLE = r"^\s*[+-]?\d+\s*$"
REAL = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def nulls_out(col: Column) -> Column:
    return F.when(~col.isin(list(NULL_TOKENS)), col)


def _number(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"(?i)\binf\b", "Infinity"))


def typed(col: Column, kind: str) -> Column:
    """Text as `kind`. Text that does not fit fails the job, it is not dropped."""
    if kind == "boolean":
        return F.when(col.isin(list(TRUE_TOKENS)), True).when(col.isin(list(FALSE_TOKENS)), False).when(
            col.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), col)).cast("boolean"))
    if kind in ("bigint", "double"):
        number = (F.trim(col) if kind == "bigint" else _number(col)).try_cast(kind)
        wrong = F.raise_error(F.concat(F.lit(f"not a {kind}: "), col)).cast(kind)
        return F.coalesce(number, F.when(col.isNotNull(), wrong))
    return col


def type_checks(names: Sequence[str]) -> list[Column]:
    """Aggregates per text column: whether all its values are whole, real, or boolean."""
    checks = []
    for i, name in enumerate(names):
        col = nulls_out(F.col(f"`{name}`"))
        whole = F.when(col.isNotNull(), col.rlike(WHOLE) & F.trim(col).try_cast("bigint").isNotNull())
        checks += [
            F.bool_and(whole).alias(f"w{i}"),
            F.bool_and(col.rlike(REAL)).alias(f"r{i}"),
            F.bool_and(col.isin([*TRUE_TOKENS, *FALSE_TOKENS])).alias(f"b{i}"),
        ]
    return checks


def checked_type(i: int) -> Column:
    """The first type of the ladder that fits, out of the aggregates of column i."""
    real = F.col(f"r{i}") | F.col(f"r{i}").isNull()
    return F.when(F.col(f"w{i}"), "bigint").when(real, "double").when(F.col(f"b{i}"), "boolean").otherwise("string")


def infer_types(df: DataFrame) -> dict[str, str]:
    """The first type of the ladder that fits every value of each text column, in one pass."""
    if not df.columns:
        return {}
    kinds = [checked_type(i).alias(f"k{i}") for i in range(len(df.columns))]
    return dict(zip(df.columns, df.agg(*type_checks(df.columns)).select(*kinds).first(), strict=True))


def apply_types(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(*[typed(nulls_out(F.col(f"`{c}`")), kinds[c]).alias(c) for c in df.columns])
