"""Table contracts and the guards that enforce them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

WEIGHTS = {
    "contig": T.StringType(),
    "position": T.IntegerType(),
    "effect_allele": T.StringType(),
    "weight": T.DoubleType(),
}
VARIANTS = {
    "variant_id": T.LongType(),
    "contig": T.StringType(),
    "position": T.IntegerType(),
    "alleles": T.ArrayType(T.StringType()),
}
SAMPLES = {"s": T.StringType()}
# A missing call has a1 NULL; a haploid call has only a2 NULL.
CALLS = {
    "variant_id": T.LongType(),
    "s": T.StringType(),
    "a1": T.IntegerType(),
    "a2": T.IntegerType(),
}
REFERENCE_BLOCKS = {
    "s": T.StringType(),
    "contig": T.StringType(),
    "start_pos": T.IntegerType(),
    "end_pos": T.IntegerType(),
}
SCORES = {
    "prs_id": T.StringType(),
    "s": T.StringType(),
    "total_score": T.DoubleType(),
    "variant_count": T.LongType(),
}


class SchemaError(ValueError):
    """A table lacks a column or holds it in another type."""


class EmptyInputError(ValueError):
    """A table that must hold rows is empty."""


def require_schema(df: DataFrame, expected: dict[str, T.DataType | None], what: str = "table") -> DataFrame:
    """Return ``df`` or raise with every missing or mistyped column listed.

    A type of ``None`` asks only that the column exists.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, wanted in expected.items():
        if name not in actual:
            problems.append(f"{name}: missing")
        elif wanted is not None and not _same_type(actual[name], wanted):
            problems.append(f"{name}: {actual[name].simpleString()}, expected {wanted.simpleString()}")
    if problems:
        raise SchemaError(f"{what}: " + "; ".join(problems))
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df


def _same_type(actual: T.DataType, wanted: T.DataType) -> bool:
    # Nullability inside arrays is not part of the contract.
    return actual.simpleString() == wanted.simpleString()
