"""Completeness, record validation and flat serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.functions.codes import code_text, filled_count, literal_list, lookup, round_half_even
from goldrec.functions.text import is_digits
from goldrec.operators.joins import flag_listed


def completeness(
    df: DataFrame, fields: list[str] = vocab.SCORE_FIELDS, name: str = "score_enrichissement"
) -> DataFrame:
    """Share of the known fields that are filled, two decimals (QLT-01)."""
    present = [f for f in fields if f in df.columns]
    if not present:
        return df.withColumn(name, F.lit(None).cast("double"))
    share = filled_count([F.col(f) for f in present]) / F.lit(float(len(present)))
    return df.withColumn(name, round_half_even(share, 2))


def _unlisted_sources(c: Column) -> Column:
    """Whether a joined set holds a source outside the vocabulary."""
    return (c != "") & (F.size(F.array_except(F.split(c, "[|]"), literal_list(vocab.SOURCES))) > 0)


def violations(df: DataFrame) -> Column:
    """Names of the broken rules of a record (QLT-02). Absent columns break none."""

    def rule(column: str, label: str, broken) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("string")
        return F.when(F.coalesce(broken(F.col(column)), F.lit(False)), F.lit(label))

    return F.array_compact(
        F.array(
            rule("siren", "siren", lambda c: c.isNull() | ~is_digits(c, 9)),
            rule("siret_siege", "siret_siege", lambda c: (c != "") & ~is_digits(c, 14)),
            rule("rna", "rna", lambda c: (c != "") & ~c.rlike("^W[0-9]{9}$")),
            rule("sources", "sources", _unlisted_sources),
            rule("confiance_jointure", "confiance_jointure", lambda c: ~c.between(0.0, 1.0)),
        )
    )


def validate(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the broken rules of every record; strict mode fails on the first one (QLT-02)."""
    checked = df.withColumn("violations", violations(df))
    if not strict:
        return checked
    stop = F.raise_error(F.concat(F.lit("invalid record: "), F.to_json("violations")))
    return checked.withColumn(
        "violations", F.when(F.size("violations") == 0, F.col("violations")).otherwise(stop)
    )


def complete_record(df: DataFrame) -> DataFrame:
    """Family and digital tag of a typed record from its codes (DRV-01…03 for ``tags_numerique`` sets).

    A family that is given stays; the tag of a digital code joins the given tags.
    """
    tag = lookup(vocab.NAF_TAG, F.col("naf"))
    tags = F.coalesce(F.col("tags_numerique"), F.array().cast("array<string>"))
    return df.withColumns(
        {
            "famille_ess": F.coalesce(
                "famille_ess", lookup(vocab.LEGAL_FORM_FAMILY, code_text(F.col("categorie_juridique")))
            ),
            "naf_numerique": F.when(tag.isNotNull(), True).otherwise(F.col("naf_numerique")),
            "tags_numerique": add_element(tags, tag),
        }
    )


def add_element(elements: Column, value: Column) -> Column:
    """Set with one more element; null adds nothing (ARR-01)."""
    return F.array_union(elements, F.array_compact(F.array(value)))


def flatten_record(df: DataFrame) -> DataFrame:
    """Typed record as a flat row: sets sorted and joined, dates as ISO text (QLT-03).

    No tag gives null, no source gives ''.
    """

    def joined(column: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(column)), "|")

    flat = {
        "tags_numerique": F.nullif(joined("tags_numerique"), F.lit("")),
        "sources": F.coalesce(joined("sources"), F.lit("")),
        "date_creation": F.date_format("date_creation", "yyyy-MM-dd"),
        "date_integration": F.date_format("date_integration", "yyyy-MM-dd"),
    }
    return df.withColumns({name: c for name, c in flat.items() if name in df.columns})


def tag_listed(df: DataFrame, reviewed: DataFrame, key: str, flag: str = "tag_ngi") -> DataFrame:
    """Tag the rows whose key was entered in a reviewed list (QLT-04, FLT-09)."""
    entered = reviewed.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return flag_listed(df, entered, key, flag)
