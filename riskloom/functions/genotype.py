"""Call predicates and effect-allele dosage.

A call is two nullable allele indices (0 = reference allele).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(a1: Column, a2: Column) -> Column:
    return a1.isNull()


def is_diploid(a1: Column, a2: Column) -> Column:
    return a1.isNotNull() & a2.isNotNull()


def is_hom_ref(a1: Column, a2: Column) -> Column:
    return is_diploid(a1, a2) & (a1 == 0) & (a2 == 0)


def is_het(a1: Column, a2: Column) -> Column:
    return is_diploid(a1, a2) & (a1 != a2)


def is_hom_var(a1: Column, a2: Column) -> Column:
    return is_diploid(a1, a2) & (a1 == a2) & (a1 > 0)


def contains_allele(a1: Column, a2: Column, index: Column) -> Column:
    return F.coalesce(a1 == index, F.lit(False)) | F.coalesce(a2 == index, F.lit(False))


def ploidy(a1: Column, a2: Column) -> Column:
    return F.when(a1.isNull(), F.lit(None)).when(a2.isNull(), 1).otherwise(2).cast("int")


def effect_is_reference(alleles: Column, effect_allele: Column) -> Column:
    return F.coalesce(F.get(alleles, F.lit(0)) == effect_allele, F.lit(False))


def effect_alternate_index(alleles: Column, effect_allele: Column) -> Column:
    """Index of the first alternate equal to the effect allele, 0 if there is none."""
    alternates = F.slice(alleles, 2, F.greatest(F.size(alleles) - 1, F.lit(0)))
    return F.coalesce(F.array_position(alternates, effect_allele), F.lit(0)).cast("int")


def dosage(a1: Column, a2: Column, effect_is_ref: Column, alternate_index: Column) -> Column:
    """Copies of the effect allele in a call.

    Only diploid calls count. A heterozygote earns one copy for a reference
    effect allele whatever its other alleles are, so 1/2 with a reference
    effect allele is 1. A missing call stays NULL.
    """
    ref_copy = F.when(effect_is_ref, 1).otherwise(0)
    alt_called = (alternate_index > 0) & contains_allele(a1, a2, alternate_index)
    alt_copy = F.when(alt_called, 1).otherwise(0)
    return (
        F.when(is_missing(a1, a2), F.lit(None))
        .when(is_hom_ref(a1, a2), 2 * ref_copy)
        .when(is_het(a1, a2), ref_copy + alt_copy)
        .when(is_hom_var(a1, a2), 2 * alt_copy)
        .otherwise(0)
        .cast("int")
    )
