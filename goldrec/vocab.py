"""Controlled vocabularies, code lists and stage column lists.

Every value below is a FIXED VALUE: it defines what the results must contain
(codes of the public company registry, output column names, output labels), so
it is stated plainly and must not be changed.
"""

from __future__ import annotations

# -- labels written to the output -------------------------------------------

FAMILIES = ["association", "cooperative", "mutuelle", "fondation", "entreprise_ess"]

JOIN_METHODS = ["siren_direct", "via_rna", "api_sirene", "scoring", "scraping", "manuel"]

DIGITAL_TAGS = [
    "dev_logiciel",
    "conseil_it",
    "hebergement",
    "portail_web",
    "edition_logiciel",
    "edition_jeux",
    "fablab",
    "mediation_numerique",
    "formation_numerique",
    "fai_associatif",
    "open_data",
]

SOURCES = [
    "sirene",
    "ess_france",
    "esus",
    "scop_scic",
    "tiers_lieux",
    "ffdn",
    "mednum",
    "opendatafrance",
    "label_inr",
    "label_bcorp",
    "label_lucie",
    "soga",
    "avise",
    "ngi",
]

ORIGINS = ["ess_x_naf", "cate_x_naf", "tiers_lieux", "ess_flag_insee"]

# -- activity code -> digital tag / tier --------------------------------------

NAF_TAG = {
    "62.01Z": "dev_logiciel",
    "62.02A": "conseil_it",
    "62.02B": "conseil_it",
    "62.03Z": "hebergement",
    "63.11Z": "hebergement",
    "63.12Z": "portail_web",
    "58.21Z": "edition_jeux",
    "58.29A": "edition_logiciel",
    "58.29B": "edition_logiciel",
    "58.29C": "edition_logiciel",
}

NAF_TIER = {
    "62.01Z": "group_naf_1",
    "58.29A": "group_naf_1",
    "58.29B": "group_naf_1",
    "58.29C": "group_naf_1",
    "63.11Z": "group_naf_1",
    "62.02A": "group_naf_2",
    "62.02B": "group_naf_2",
    "62.03Z": "group_naf_2",
    "63.12Z": "group_naf_2",
    "58.21Z": "group_naf_2",
}

# -- legal form -> family / tier ------------------------------------------------

LEGAL_FORM_FAMILY = {
    "9210": "association",
    "9220": "association",
    "9221": "association",
    "9222": "association",
    "9230": "association",
    "9240": "association",
    "9260": "association",
    "5458": "cooperative",
    "5547": "cooperative",
    "5558": "cooperative",
    "5560": "cooperative",
    "6316": "cooperative",
    "6317": "cooperative",
    "6318": "cooperative",
    "8210": "mutuelle",
    "8250": "mutuelle",
    "8290": "mutuelle",
    "9300": "fondation",
    "9310": "fondation",
    "9900": "fondation",
}

LEGAL_FORM_TIER_1 = ["9220", "6316", "6317", "6318", "9300"]
LEGAL_FORM_TIER = {
    "9210": "group_cate_2",
    "9220": "group_cate_1",
    "9221": "group_cate_2",
    "9222": "group_cate_2",
    "9230": "group_cate_2",
    "9240": "group_cate_2",
    "9260": "group_cate_2",
    "5458": "group_cate_2",
    "5547": "group_cate_2",
    "5558": "group_cate_2",
    "5560": "group_cate_2",
    "6316": "group_cate_1",
    "6317": "group_cate_1",
    "6318": "group_cate_1",
    "8210": "group_cate_2",
    "8250": "group_cate_2",
    "8290": "group_cate_2",
    "9300": "group_cate_1",
    "9310": "group_cate_2",
    "9900": "group_cate_2",
}

# -- code lists used by the candidate filters ------------------------------------

DIGITAL_NAF = list(NAF_TAG)
SOCIAL_LEGAL_FORMS = list(LEGAL_FORM_FAMILY)

# the narrow exploratory filter
NARROW_NAF = ["62.01Z", "58.29A", "58.29B", "58.29C", "63.11Z"]
NARROW_LEGAL_FORMS = LEGAL_FORM_TIER_1

# catch-all activity code
CATCH_ALL_NAF = "94.99Z"

# words that mark a digital activity inside a company name
DIGITAL_KEYWORDS = [
    "NUMERIQUE",
    "DIGITAL",
    "INFORMATIQUE",
    "LOGICIEL",
    "SOFTWARE",
    "WEB",
    "TECH",
    "DATA",
    "RESEAU",
    "SYSTEME",
    "PLATEFORME",
    "APPLICATION",
    "DEVELOPPEMENT",
    "CLOUD",
    "CYBER",
    "INTELLIGENCE ARTIFICIELLE",
]

# survey columns that must all hold for a digital third place
DIGITAL_SURVEY_FLAGS = [
    "TYPE_ACT_NUMER",
    "PROD_NUMER",
    "THEME_FORM_NUMER",
    "THEME_FORM_INFOR",
    "THEME_FORM_PROGRAM",
    "OFFRE_NUM_FABR",
    "OFFRE_NUM_INCLU",
    "OFFRE_NUM_MENUM",
    "EQPT_NUM",
]

SURVEY_IDENTITY_COLUMNS = [
    "ID_UNIQUE",
    "NOM",
    "Insee",
    "NOM_STRC_PORT",
    "ADRESSE",
    "CODPOST",
    "VILLE",
    "INTERNET",
]

# -- consolidation ----------------------------------------------------------------

MERGEABLE_ATTRIBUTES = [
    "denomination",
    "nom_usage",
    "naf",
    "code_postal",
    "commune",
    "site_web",
    "tranche_effectifs",
    "categorie_juridique",
]

PASSTHROUGH_COLUMNS = ["nom_structure_porteuse", "group_naf", "group_cate"]

REGISTRY_RENAMES = {
    "denominationUniteLegale": "denomination",
    "nomUniteLegale": "nom_usage",
    "activitePrincipaleUniteLegale": "naf",
    "trancheEffectifsUniteLegale": "tranche_effectifs",
    "categorieJuridiqueUniteLegale": "categorie_juridique",
}

SURVEY_RENAMES = {
    "NOM": "denomination",
    "NOM_STRC_PORT": "nom_structure_porteuse",
    "CODPOST": "code_postal",
    "VILLE": "commune",
    "INTERNET": "site_web",
}

# the first origin keeps only name and code; its other columns stay as they are
ORIGIN_RENAMES = {
    "ess_x_naf": {
        "denominationUniteLegale": "denomination",
        "activitePrincipaleUniteLegale": "naf",
    },
    "cate_x_naf": REGISTRY_RENAMES,
    "tiers_lieux": SURVEY_RENAMES,
    "ess_flag_insee": REGISTRY_RENAMES,
}

# -- enrichment: registry column -> (target column, transform) ---------------------

ENRICH_LABEL = "sirene"
ENRICH_METHOD = "siren_direct"

ENRICH_FIELDS = [
    ("activitePrincipaleUniteLegale", "naf", None),
    ("categorieJuridiqueUniteLegale", "categorie_juridique", None),
    ("trancheEffectifsUniteLegale", "tranche_effectifs", None),
    ("denominationUniteLegale", "denomination", None),
    ("nomUniteLegale", "nom_usage", None),
    ("sigleUniteLegale", "sigle", None),
    ("dateCreationUniteLegale", "date_creation", None),
    ("etatAdministratifUniteLegale", "est_active", "est_active"),
    ("identifiantAssociationUniteLegale", "rna", None),
    ("economieSocialeSolidaireUniteLegale", "flag_ess_sirene", "flag_ess"),
    ("caractereEmployeurUniteLegale", "caractere_employeur", None),
    ("categorieEntreprise", "categorie_entreprise", None),
    ("societeMissionUniteLegale", "societe_mission", None),
    ("anneeEffectifsUniteLegale", "annee_effectifs", None),
]

# -- export ------------------------------------------------------------------------

EXPORT_COLUMNS = [
    "siren",
    "siret_siege",
    "denomination",
    "nom_usage",
    "sigle",
    "naf",
    "naf_numerique",
    "tags_numerique",
    "categorie_juridique",
    "famille_ess",
    "flag_ess_sirene",
    "est_active",
    "date_creation",
    "tranche_effectifs",
    "annee_effectifs",
    "categorie_entreprise",
    "caractere_employeur",
    "societe_mission",
    "rna",
    "code_postal",
    "commune",
    "site_web",
    "nom_structure_porteuse",
    "sources",
    "origines",
    "methode_jointure",
    "confiance_jointure",
    "score_enrichissement",
]

SCORE_FIELDS = [
    "denomination",
    "naf",
    "categorie_juridique",
    "famille_ess",
    "siret_siege",
    "code_postal",
    "commune",
    "tranche_effectifs",
    "date_creation",
    "est_active",
    "site_web",
    "rna",
]

FILL_RATE_FIELDS = [
    "denomination",
    "naf",
    "categorie_juridique",
    "famille_ess",
    "tranche_effectifs",
    "code_postal",
    "commune",
    "site_web",
    "date_creation",
    "est_active",
    "siret_siege",
    "rna",
]
