"""Row filters and column projections."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.functions.codes import code_text, member, truthy
from goldrec.functions.text import canonical_key, is_digits


def in_codes(df: DataFrame, column: str, codes: list[str]) -> DataFrame:
    """Code-list filter that reaches the scan (FLT-01)."""
    return df.where(F.col(column).isin(codes))


def legal_form_in(column: str, codes: list[str]) -> Column:
    """Legal form is in the list, whether it is stored as text, int or float (FLT-01)."""
    return member(code_text(F.col(column)), codes)


def all_truthy(df: DataFrame, columns: list[str]) -> DataFrame:
    """No survey flag says no; unknown passes (FLT-04)."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & truthy(F.col(c))
    return df.where(keep)


def valid_keys(df: DataFrame, key: str, width: int = 9) -> DataFrame:
    """Rows whose key has exactly ``width`` digits (FLT-06)."""
    return df.where(is_digits(F.col(key), width))


def key_quality(df: DataFrame, key: str, width: int = 9) -> DataFrame:
    """How many rows the key filter keeps and drops (FLT-06)."""
    ok = F.coalesce(is_digits(F.col(key), width), F.lit(False))
    return df.agg(
        F.count_if(ok).alias("n_valid"),
        F.count_if(~ok).alias("n_dropped"),
    )


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist (PRJ-01)."""
    return df.withColumnsRenamed(names)


def add_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Constant columns for those that are missing (PRJ-02)."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def with_provenance(df: DataFrame, sources: list[str], method: str) -> DataFrame:
    """Constant sources and join method; a method already there stays (PRJ-03)."""
    known = F.col("methode_jointure") if "methode_jointure" in df.columns else F.lit(None)
    return df.withColumns(
        {
            "sources": F.lit("|".join(sources)),
            "methode_jointure": F.coalesce(known.cast("string"), F.lit(method)),
        }
    )


def provenance(always: list[str], conditional: dict[str, Column]) -> Column:
    """Sorted '|'-joined sources, some of them only when a condition holds (PRJ-04)."""
    parts = [F.lit(s) for s in always] + [F.when(on, F.lit(s)) for s, on in conditional.items()]
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*parts)))), "|")


def normalize_candidate(
    df: DataFrame,
    origin: str,
    renames: dict[str, str],
    defaults: dict | None = None,
    key: str = "siren",
    width: int = 9,
) -> DataFrame:
    """One candidate table in the shape the consolidation expects (PRJ-01, PRJ-02, PRJ-05, FLT-06)."""
    shaped = rename_present(add_defaults(df, defaults or {}), renames)
    tagged = shaped.withColumns(
        {key: canonical_key(F.col(key), width), "_origin": F.lit(origin)}
    )
    return valid_keys(tagged, key, width)


def select_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Allow-list in its own order; absent columns are skipped (PRJ-06)."""
    return df.select(*[c for c in columns if c in df.columns])


def review_table(df: DataFrame, columns: list[str | Column], entry: str = "siren") -> DataFrame:
    """Chosen columns and an empty one for manual entry (PRJ-07)."""
    return df.select(*columns, F.lit("").alias(entry))


def clean_column_name(name: str) -> str:
    """Lower-case ASCII identifier of a header (PRJ-08): its words, each without other characters, joined by '_'."""
    letters = unicodedata.normalize("NFKD", str(name).replace("->", " ")).encode("ascii", "ignore").decode()
    parts = ["".join(c for c in part if c.isalnum()) for part in letters.lower().replace("_", " ").split()]
    return "_".join(part for part in parts if part)


def number_repeats(names: list[str]) -> list[str]:
    """The second 'a' becomes 'a_1', the third 'a_2' (PRJ-09)."""
    return [n if not (k := names[:i].count(n)) else f"{n}_{k}" for i, n in enumerate(names)]


def clean_columns(df: DataFrame) -> DataFrame:
    """Readable, distinct column names; the data is not touched (PRJ-08, PRJ-09)."""
    return df.toDF(*number_repeats([clean_column_name(c) for c in df.columns]))


def plain_header(name: str) -> str:
    """Short header cleaning: no quotes, trimmed, lower case (PRJ-08)."""
    return name.replace('"', "").strip().lower()


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns such as 'attr__…' (STR-12)."""
    return [c for c in df.columns if c.startswith(prefix)]
