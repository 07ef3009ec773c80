"""Gap filling from a registry, with a trace of every fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.functions.codes import active_status, code_text, lenient_timestamp, lookup, member, positive_flag
from goldrec.functions.text import is_blank, is_digits, strip
from goldrec.operators.joins import attach, broadcast_bytes, join_unique
from goldrec.operators.keyfilter import may_be_wanted

#: Bytes of a key in a broadcast table.
KEY_BYTES = 64

TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "est_active": active_status,
    "flag_ess": positive_flag,
}


def latest_per_key(df: DataFrame, key: str, when: Column, *ties: str | Column) -> DataFrame:
    """Most recent row of each key; unknown dates last, then the tie-breakers (WIN-01).

    Spark applies the rank limit inside each map task first, so at most one row
    per key and task is shuffled, however many rows a key has.
    """
    newest = W.partitionBy(key).orderBy(when.desc_nulls_last(), *ties)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def registry_for_keys(
    registry: DataFrame,
    keys: DataFrame,
    key: str,
    date: str,
    columns: list[str],
    *ties: str,
    broadcast: bool | None = None,
) -> DataFrame:
    """Latest registry row of each wanted key (ENR-03); null keys are not wanted.

    Rows of other keys are dropped in the scan, exactly by a broadcast semi-join if the counted keys are few, else by a
    filter of a few bits per key. Each map task then ships at most one row per key that is left.
    ``broadcast`` chooses the plan instead of the count.
    """
    names = list(dict.fromkeys([key, date, *columns, *ties]))
    registry = registry.select(*names)
    wanted = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("_wanted"))
    n = wanted.count()
    few = n * KEY_BYTES <= broadcast_bytes(registry.sparkSession) if broadcast is None else broadcast
    rows = join_unique(registry, F.broadcast(wanted), F.col(key), "_wanted", "left_semi") if few else may_be_wanted(registry, key, wanted, "_wanted", n)
    newest = latest_per_key(rows, key, lenient_timestamp(F.col(date)), *ties)
    return newest if few else join_unique(newest, wanted, F.col(key), "_wanted", "left_semi")


def trace_columns(target: str) -> tuple[str, str]:
    return f"{target}_enrich_source", f"{target}_enrich_method"


def _empty(c: Column, is_boolean: bool) -> Column:
    return c.isNull() if is_boolean else is_blank(c)


def fill_blank(
    df: DataFrame,
    fills: dict[str, Column],
    label: str = vocab.ENRICH_LABEL,
    method: str = vocab.ENRICH_METHOD,
    boolean_targets: tuple[str, ...] = ("est_active", "flag_ess_sirene"),
) -> DataFrame:
    """Fill empty fields, never overwrite, record source and method (ENR-01).

    ``fills`` maps a target column to the value offered for it. A target that
    does not exist is created; both trace columns exist afterwards in any case.
    All fields are done in one projection.
    """
    given = set(df.columns)
    out: dict[str, Column] = {}
    for target, offered in fills.items():
        boolean = target in boolean_targets
        kind = "boolean" if boolean else "string"
        current = F.col(target).cast(kind) if target in given else F.lit(None).cast(kind)
        take = _empty(current, boolean) & ~_empty(offered, boolean)
        out[target] = F.when(take, offered.cast(kind)).otherwise(current)
        for trace, value in zip(trace_columns(target), (label, method)):
            before = F.col(trace) if trace in given else F.lit(None).cast("string")
            out[trace] = F.when(take, F.lit(value)).otherwise(before)
    return df.withColumns(out)


def site_id(key: Column, part: Column) -> Column:
    """Key and 5-digit site number as a 14-digit id, null when invalid (DRV-07, STR-08)."""
    number = strip(part.cast("string"))
    whole = F.concat(key, number)
    return F.when(is_digits(number, 5) & is_digits(whole, 14), whole)


def rederive(df: DataFrame, label: str = vocab.ENRICH_LABEL) -> DataFrame:
    """Derived columns again, only where their code was just filled (ENR-02)."""
    given = set(df.columns)

    def old(name: str, kind: str) -> Column:
        return F.col(name) if name in given else F.lit(None).cast(kind)

    def filled(name: str) -> Column:
        trace = trace_columns(name)[0]
        return F.coalesce(F.col(trace) == label, F.lit(False)) if trace in given else F.lit(False)

    activity, legal_form = filled("naf"), filled("categorie_juridique")
    family = lookup(vocab.LEGAL_FORM_FAMILY, code_text(old("categorie_juridique", "string")))
    naf = old("naf", "string")
    return df.withColumns(
        {
            "famille_ess": F.when(legal_form, family).otherwise(old("famille_ess", "string")),
            "naf_numerique": F.when(activity, member(naf, vocab.DIGITAL_NAF)).otherwise(
                old("naf_numerique", "boolean")
            ),
            "tags_numerique": F.when(activity, lookup(vocab.NAF_TAG, naf)).otherwise(
                old("tags_numerique", "string")
            ),
        }
    )


def enrich(
    consolidated: DataFrame,
    registry: DataFrame,
    key: str = "siren",
    date: str = "dateDebut",
    site_number: str = "nicSiegeUniteLegale",
    fields: list[tuple[str, str, str | None]] = vocab.ENRICH_FIELDS,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Fill the blanks of the golden records from the registry (ENR-01, DRV-07, ENR-02).

    One join fetches all fields. Registry columns that do not exist offer nothing.
    """
    present = [c for c, _, _ in fields if c in registry.columns]
    wanted = list(dict.fromkeys(present + ([site_number] if site_number in registry.columns else [])))
    ties = ties or tuple(wanted)
    latest = registry_for_keys(registry, consolidated, key, date, wanted, *ties)
    renamed = latest.select(key, *[F.col(c).alias(f"_reg_{c}") for c in wanted])
    joined = attach(consolidated, renamed, key, [f"_reg_{c}" for c in wanted])

    def offered(column: str, transform: str | None) -> Column:
        if column not in wanted:
            return F.lit(None).cast("boolean" if transform else "string")
        value = F.col(f"_reg_{column}")
        return TRANSFORMS[transform](value) if transform else value.cast("string")

    fills = {target: offered(column, transform) for column, target, transform in fields}
    if site_number in wanted:
        fills["siret_siege"] = site_id(F.col(key), F.col(f"_reg_{site_number}"))
    else:
        fills["siret_siege"] = F.lit(None).cast("string")
    return rederive(fill_blank(joined, fills)).drop(*[f"_reg_{c}" for c in wanted])


def fill_counts(df: DataFrame, targets: list[str]) -> DataFrame:
    """Values filled per field, plus a TOTAL row (AGG-22)."""
    per_field = df.agg(*[F.count(trace_columns(t)[0]).alias(t) for t in targets])
    with_total = per_field.withColumn("TOTAL", sum((F.col(t) for t in targets), F.lit(0)))
    return with_total.unpivot([], [*targets, "TOTAL"], "field", "n_filled")
