"""Round trip of a list without ids: review table, manual entry, tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.text import contains_ignore_case, domain
from goldrec.operators.filters import review_table
from goldrec.operators.quality import tag_listed
from goldrec.sources.readers import read_delimited, read_with_preamble
from goldrec.sources.writers import write_delimited

LIST_COLUMNS = ["title", "website", "Category", "Project", "Country"]


def to_review(
    projects: DataFrame,
    country: str = "Country",
    wanted: str = "france",
    website: str = "website",
    before: tuple[str, ...] = ("title",),
    after: tuple[str, ...] = ("website", "Category", "Project"),
) -> DataFrame:
    """Projects of the wanted country with their domain and an empty key (PIPE-08)."""
    local = projects.where(contains_ignore_case(F.col(country), wanted))
    return review_table(local.withColumn("domaine", domain(F.col(website))), [*before, "domaine", *after])


def export_review(spark: SparkSession, source: str, target: str, columns: list[str] = LIST_COLUMNS) -> None:
    """Read the raw list with its preamble and write the review table as ';' text for manual entry (PIPE-08)."""
    write_delimited(to_review(read_with_preamble(spark, source, columns)), target, ";")


def import_review(spark: SparkSession, path: str, organisations: DataFrame, key: str = "siren") -> DataFrame:
    """Organisations tagged by the keys that were entered in the ';' file (PIPE-08)."""
    return from_review(organisations, read_delimited(spark, path, sep=";"), key)


def from_review(organisations: DataFrame, reviewed: DataFrame, key: str = "siren") -> DataFrame:
    """Organisations tagged when their key was entered in the review (PIPE-08)."""
    return tag_listed(organisations, reviewed, key)
