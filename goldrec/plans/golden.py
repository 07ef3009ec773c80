"""The chain from candidate tables to the export for human review."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldrec import vocab
from goldrec.operators.consolidate import consolidate, derive, union_all
from goldrec.operators.enrich import enrich
from goldrec.operators.filters import normalize_candidate, select_present
from goldrec.operators.quality import completeness
from goldrec.session import stage


def shape_candidates(
    candidates: dict[str, DataFrame], renames: dict[str, dict[str, str]] = vocab.ORIGIN_RENAMES
) -> dict[str, DataFrame]:
    """All candidate tables in one shape."""
    return {
        origin: normalize_candidate(df, origin, renames.get(origin, {})) for origin, df in candidates.items()
    }


def consolidate_candidates(
    candidates: dict[str, DataFrame],
    renames: dict[str, dict[str, str]] = vocab.ORIGIN_RENAMES,
    row_order: str | None = None,
    known_sources: list[str] | None = vocab.SOURCES,
) -> DataFrame:
    """One derived golden record per key (PIPE-05). The order of the dict is the input order.

    A source outside the vocabulary fails the query; pass None to take any.
    """
    shaped = shape_candidates(candidates, renames)
    records = consolidate(
        union_all(list(shaped.values())),
        origins=list(shaped),
        row_order=row_order,
        supplied={origin: df.columns for origin, df in shaped.items()},
        known_sources=known_sources,
    )
    return derive(records)


def enrich_records(
    consolidated: DataFrame,
    registry: DataFrame,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Golden records with their blanks filled from the registry (PIPE-06).

    The records are needed twice, for their keys and for the join, so they are
    written once instead of being consolidated twice.
    """
    return enrich(stage(consolidated, "consolidated"), registry, ties=ties)


def export_records(enriched: DataFrame) -> DataFrame:
    """Business columns with the completeness score (PIPE-07)."""
    return select_present(completeness(enriched), vocab.EXPORT_COLUMNS)
