"""Candidate tables: four independent ways to find digital social organisations.

The registry arguments are frames with the registry's public column names. All
filters are plain expressions, so column pruning and pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.operators.consolidate import add_tiers
from goldrec.operators.filters import all_truthy, in_codes, legal_form_in, provenance, with_provenance
from goldrec.operators.joins import attach, flag_listed, keep_listed
from goldrec.operators.matching import build_name_index, resolve_by_name

ACTIVITY = "activitePrincipaleUniteLegale"
LEGAL_FORM = "categorieJuridiqueUniteLegale"
NAME = "denominationUniteLegale"
LAST_NAME = "nomUniteLegale"
STAFF = "trancheEffectifsUniteLegale"
SOCIAL_FLAG = "economieSocialeSolidaireUniteLegale"
ACRONYM = "sigleUniteLegale"
STATUS = "etatAdministratifUniteLegale"


def listed_with_digital_code(
    registry: DataFrame, listed: DataFrame, list_key: str = "SIREN"
) -> DataFrame:
    """Members of the reference list with a digital activity code (PIPE-01)."""
    digital = in_codes(registry.select("siren", NAME, ACTIVITY), ACTIVITY, vocab.DIGITAL_NAF)
    members = keep_listed(digital, listed, "siren", list_key)
    return with_provenance(members, ["ess_france", "sirene"], "siren_direct")


def social_form_or_approved(
    registry: DataFrame, approved: DataFrame, list_key: str = "key"
) -> DataFrame:
    """Digital code and either a social legal form or an approval (PIPE-02, FLT-03, SET-02)."""
    columns = ["siren", NAME, LAST_NAME, ACTIVITY, STAFF, LEGAL_FORM]
    digital = in_codes(registry.select(*columns), ACTIVITY, vocab.DIGITAL_NAF)
    flagged = flag_listed(digital, approved, "siren", "_approved", list_key)
    kept = flagged.where(legal_form_in(LEGAL_FORM, vocab.SOCIAL_LEGAL_FORMS) | F.col("_approved"))
    tiered = add_tiers(kept, LEGAL_FORM, ACTIVITY)
    return tiered.withColumns(
        {
            "sources": provenance(["sirene"], {"esus": F.col("_approved")}),
            "methode_jointure": F.lit("siren_direct"),
        }
    ).drop("_approved")


def surveyed_places(
    activities: DataFrame,
    identity: DataFrame,
    registry: DataFrame,
    flags: list[str] = vocab.DIGITAL_SURVEY_FLAGS,
    fuzzy: bool = True,
    order: str | None = None,
) -> DataFrame:
    """Surveyed places with every digital flag, resolved by name (PIPE-03).

    Of entities with one name the first in ``order``, a registry column such as the row number of the file, keeps it.
    """
    digital = all_truthy(activities, flags).select("ID_UNIQUE")
    columns = [c for c in vocab.SURVEY_IDENTITY_COLUMNS if c in identity.columns]
    places = attach(digital, identity, "ID_UNIQUE", columns)
    index = build_name_index(registry, "siren", [NAME, ACRONYM], F.col(STATUS) == "A", order)
    resolved = resolve_by_name(places, index, "NOM", "NOM_STRC_PORT", fuzzy)
    return with_provenance(resolved.drop("match_pass"), ["tiers_lieux"], "scoring")


def flagged_with_digital_code(registry: DataFrame) -> DataFrame:
    """Registry flag and digital activity code (PIPE-04, FLT-02)."""
    columns = ["siren", NAME, LAST_NAME, ACTIVITY, LEGAL_FORM, STAFF, SOCIAL_FLAG]
    flagged = registry.select(*columns).where(F.col(SOCIAL_FLAG) == "O")
    kept = in_codes(flagged, ACTIVITY, vocab.DIGITAL_NAF)
    return with_provenance(kept, ["sirene"], "siren_direct")
