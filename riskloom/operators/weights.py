"""From a raw scoring file to one clean weight per model and locus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import to_number
from riskloom.schema import SchemaError

# Accepted column headings of each field, the preferred one first.
HEADINGS = {
    "chr": ["hm_chr", "chr", "chromosome"],
    "bp": ["hm_pos", "pos", "base_pair_location", "position", "BP"],
    "effect_allele": ["effect_allele", "allele", "A1", "hm_effect_allele"],
    "other_allele": ["other_allele", "A2", "hm_other_allele", "reference_allele"],
    "weight": ["effect_weight", "beta", "OR", "effect", "hm_beta"],
}
ESSENTIAL = ["chr", "bp", "effect_allele", "weight"]

# Contigs a weight may lie on.
CONTIGS = [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY", "chrM"]

# Texts that mean "no value" in a scoring file.
NO_VALUE = ["", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "<NA>", "#N/A"]


def resolve_headings(columns: list[str]) -> dict[str, str]:
    """Field -> heading actually present; raises if an essential field has none."""
    found = {}
    for field, accepted in HEADINGS.items():
        present = [name for name in accepted if name in columns]
        if present:
            found[field] = present[0]
    missing = [field for field in ESSENTIAL if field not in found]
    if missing:
        raise SchemaError(f"scoring file lacks {missing}; it has {columns}")
    return found


def type_weights(raw: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Text columns under any accepted headings -> typed columns, NULL where invalid."""
    found = resolve_headings(raw.columns)
    without_fraction = F.regexp_replace(_value(raw[found["chr"]]), r"\.0$", "")
    # Through double, so that '1.0' is position 1.
    position = to_number(raw[found["bp"]].cast("string")).try_cast("int")
    columns = [
        F.regexp_replace(without_fraction, "^(?!chr)", "chr").alias("contig"),
        position.alias("position"),
        _value(raw[found["effect_allele"]]).alias("effect_allele"),
        to_number(raw[found["weight"]].cast("string")).alias("weight"),
    ]
    if "other_allele" in found:
        columns.append(_value(raw[found["other_allele"]]).alias("other_allele"))
    else:
        columns.append(F.lit(None).cast("string").alias("other_allele"))
    return raw.select(*(by or []), *columns)


def clean_weights(raw: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Typed weights with every essential field valid and on a known contig."""
    typed = type_weights(raw, by)
    return typed.where(F.col("contig").isin(CONTIGS) & _has_values(typed))


def cleaning_report(raw: DataFrame, by: list[str]) -> DataFrame:
    """Per model: rows read, dropped as incomplete, dropped for their contig, kept."""
    typed = type_weights(raw, by)
    complete = F.col("contig").isNotNull() & _has_values(typed)
    known = F.col("contig").isin(CONTIGS)
    return typed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(~complete).alias("n_incomplete"),
        F.count_if(complete & ~known).alias("n_unknown_contig"),
        F.count_if(complete & known).alias("n_kept"),
    )


def one_weight_per_locus(weights: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of several weights at a locus keep the least (weight, effect allele, other allele).

    A minimum combines on the map side; a row_number would sort every locus.
    """
    keys = [*(by or []), "contig", "position"]
    least = F.min(F.struct("weight", "effect_allele", "other_allele")).alias("_least")
    return weights.groupBy(*keys).agg(least).select(
        *keys,
        F.col("_least.effect_allele").alias("effect_allele"),
        F.col("_least.weight").alias("weight"),
        F.col("_least.other_allele").alias("other_allele"),
    )


def _value(text: Column) -> Column:
    text = text.cast("string")
    return F.when(~F.trim(text).isin(NO_VALUE), text)


def _has_values(typed: DataFrame) -> Column:
    return typed["position"].isNotNull() & typed["effect_allele"].isNotNull() & typed["weight"].isNotNull()
