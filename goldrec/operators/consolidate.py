"""Golden records: one row per key out of several candidate tables.

All of it is one ``groupBy(key)``. Every aggregate has a partial form, so a key
that holds a large share of the rows is reduced inside each map task before the
shuffle, and no aggregate keeps the rows of a group: what a group buffers is
bounded by the number of origins and of distinct source lists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.functions.codes import code_text, literal_list, lookup, member
from goldrec.functions.text import blank_to_null

ORIGIN = "_origin"
CONFLICTS = "conflicts"


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name, missing columns become null (SET-01)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def input_order(origins: list[str], row_order: Column) -> Column:
    """Sortable position of a row in the input: origin rank, then row order (WIN-02)."""
    position = F.array_position(literal_list(origins), F.col(ORIGIN))
    rank = F.when(position == 0, len(origins) + 1).otherwise(position).cast("int")
    return F.struct(rank.alias("rank"), row_order.alias("row"))


def agg_set_union(c: Column, sep: str = "|") -> Column:
    """Sorted union of joined sets over the group, '' when there is none (AGG-02)."""
    lists = F.collect_set(c)
    elements = F.flatten(F.transform(lists, lambda s: F.split(s, f"[{sep}]")))
    return F.array_join(F.array_sort(F.array_distinct(elements)), sep)


def agg_set(c: Column, sep: str = "|") -> Column:
    """Sorted distinct values of the group, joined (AGG-03)."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def agg_known_set(c: Column, known: list[str], sep: str = "|", name: str = "value") -> Column:
    """As agg_set_union over values of a known list of at most 63: a bit each, OR-ed and spelled out after the group.

    A value that is not listed fails the query, since it has no bit. The buffer is one number, so a task combines rows
    without keeping their texts.
    """
    parts = F.split(c, f"[{sep}]")
    bits = [F.when(F.array_contains(parts, k), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, k in enumerate(known)]
    unknown = F.array_except(parts, literal_list(known))
    fail = F.raise_error(F.concat(F.lit(f"unlisted {name} "), F.array_join(unknown, sep))).cast("bigint")
    mask = F.bit_or(F.when(F.size(unknown) > 0, fail).otherwise(reduce(Column.bitwiseOR, bits)))
    spelled = [F.when(F.getbit(mask, F.lit(i)) == 1, F.lit(k)) for k, i in sorted((k, i) for i, k in enumerate(known))]
    return F.array_join(F.array_compact(F.array(*spelled)), sep)


def agg_best(c: Column, priority: list[str], order: Column) -> Column:
    """Value that comes first in the priority list; unknown values last (AGG-04)."""
    position = F.array_position(literal_list(priority), c)
    rank = F.when(position == 0, 99).otherwise(position)
    return F.min(F.when(c.isNotNull(), F.struct(rank, order, c.alias("value"))))["value"]


def agg_first(c: Column, order: Column) -> Column:
    """First non-null value in input order (AGG-07)."""
    return F.min(F.when(c.isNotNull(), F.struct(order, c.alias("value"))))["value"]


def agg_confidence(confidence: Column, best_method: Column) -> Column:
    """Highest explicit confidence, else 1.0 for a direct key, else null (AGG-05)."""
    return F.coalesce(F.max(confidence), F.when(best_method == "siren_direct", F.lit(1.0)))


def agg_resolve(value: str, origins: list[str], order: str = "_order") -> Column:
    """Main value of an attribute column and its per-origin versions (AGG-06).

    ``main`` is the first non-null value in input order. ``versions`` is null
    unless the group holds several distinct values; then it maps every
    contributing origin to its last value. Values differ exactly when the
    smallest and the largest do, which needs no distinct count. Order and value
    travel in one struct, so every aggregate keeps a single buffer.
    """
    if not origins:
        return F.expr("struct(CAST(NULL AS STRING) AS main, CAST(NULL AS MAP<STRING, STRING>) AS versions)")
    v = F.col(value)

    def last(origin: str) -> Column:
        given = F.when(v.isNotNull() & (F.col(ORIGIN) == origin), F.struct(F.col(f"{order}.row"), v.alias("value")))
        return F.max(given)["value"]

    versions = F.create_map(*[part for o in origins for part in (F.lit(o), last(o))])
    differ = F.when(F.min(v) != F.max(v), F.map_filter(versions, lambda _, version: version.isNotNull()))
    return F.struct(agg_first(v, F.col(order)).alias("main"), differ.alias("versions"))


def consolidate(
    df: DataFrame,
    key: str = "siren",
    attributes: list[str] = vocab.MERGEABLE_ATTRIBUTES,
    passthrough: list[str] = vocab.PASSTHROUGH_COLUMNS,
    origins: list[str] = vocab.ORIGINS,
    row_order: str | None = None,
    supplied: dict[str, list[str]] | None = None,
    known_sources: list[str] | None = None,
) -> DataFrame:
    """One record per key with provenance, best values and conflicts (AGG-01).

    The output columns do not depend on the data: conflicts are held in one map
    ``attribute -> origin -> value`` (null when the key has none); see
    ``widen_conflicts``. Columns that no candidate has are null. Without a row
    order the rows of one origin are ordered by a hash of their content, so the
    result never depends on the partitioning. A row of an origin that is not
    listed fails the query: its values would have no place among the conflicts.

    ``supplied`` says which attributes each origin can have at all; the others
    need no aggregate. It changes the cost only. ``known_sources`` lists all sources that may occur; without it the sources
    of a group are collected as texts.
    """
    suppliers = {
        a: [o for o in origins if supplied is None or a in supplied[o]] if a in df.columns else []
        for a in attributes
    }
    given = set(df.columns)

    def column(name: str, kind: str = "string") -> Column:
        return F.col(name).cast(kind) if name in given else F.lit(None).cast(kind)

    row = F.col(row_order) if row_order else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    unknown = F.raise_error(F.concat(F.lit("unlisted origin "), F.col(ORIGIN))).cast("string")
    listed = F.col(ORIGIN).isNull() | F.col(ORIGIN).isin(origins)
    prepared = df.select(
        key,
        F.when(listed, F.col(ORIGIN)).otherwise(unknown).alias(ORIGIN),
        input_order(origins, row).alias("_order"),
        column("sources").alias("sources"),
        column("methode_jointure").alias("methode_jointure"),
        column("confiance_jointure", "double").alias("confiance_jointure"),
        *[blank_to_null(column(a)).alias(a) for a in attributes],
        *[column(c).alias(c) for c in passthrough],
    )
    order = F.col("_order")
    best_method = agg_best(F.col("methode_jointure"), vocab.JOIN_METHODS, order)
    grouped = prepared.groupBy(key).agg(
        (agg_known_set(F.col("sources"), known_sources, name="source") if known_sources else agg_set_union(F.col("sources"))).alias("sources"),
        agg_known_set(F.col(ORIGIN), origins, name="origin").alias("origines"),
        best_method.alias("methode_jointure"),
        agg_confidence(F.col("confiance_jointure"), best_method).alias("confiance_jointure"),
        *[agg_resolve(a, suppliers[a]).alias(f"_{a}") for a in attributes],
        *[agg_first(F.col(c), order).alias(c) for c in passthrough],
    )
    versions = F.create_map(*[part for a in attributes for part in (F.lit(a), F.col(f"_{a}.versions"))])
    conflicts = F.map_filter(versions, lambda _, v: v.isNotNull())
    return grouped.select(
        key,
        "sources",
        "origines",
        "methode_jointure",
        "confiance_jointure",
        *[F.col(f"_{a}.main").alias(a) for a in attributes],
        *passthrough,
        F.when(F.size(conflicts) > 0, conflicts).alias(CONFLICTS),
    )


def derive(df: DataFrame, legal_form: str = "categorie_juridique", activity: str = "naf") -> DataFrame:
    """Family, digital flag and tag from the codes (DRV-01, DRV-02, DRV-03)."""
    return df.withColumns(
        {
            "famille_ess": lookup(vocab.LEGAL_FORM_FAMILY, code_text(F.col(legal_form))),
            "naf_numerique": member(F.col(activity), vocab.DIGITAL_NAF),
            "tags_numerique": lookup(vocab.NAF_TAG, F.col(activity)),
        }
    )


def add_tiers(df: DataFrame, legal_form: str, activity: str) -> DataFrame:
    """Tier of the activity code and of the legal form (DRV-04)."""
    return df.withColumns(
        {
            "group_naf": lookup(vocab.NAF_TIER, F.col(activity)),
            "group_cate": lookup(vocab.LEGAL_FORM_TIER, code_text(F.col(legal_form))),
        }
    )


def widen_conflicts(
    df: DataFrame,
    attributes: list[str] = vocab.MERGEABLE_ATTRIBUTES,
    origins: list[str] = vocab.ORIGINS,
) -> DataFrame:
    """Conflict map as columns ``attribute__origin``, the same set for any data."""
    wide = {
        f"{a}__{o}": F.try_element_at(F.try_element_at(F.col(CONFLICTS), F.lit(a)), F.lit(o))
        for a in attributes
        for o in origins
    }
    return df.withColumns(wide).drop(CONFLICTS)


def conflict_counts(df: DataFrame, attributes: list[str] = vocab.MERGEABLE_ATTRIBUTES) -> DataFrame:
    """Number of keys in conflict per attribute, with their share of all keys (AGG-08)."""
    conflicted = [
        F.coalesce(F.map_contains_key(F.col(CONFLICTS), F.lit(a)), F.lit(False)) for a in attributes
    ]
    totals = df.agg(
        F.count(F.lit(1)).alias("n_keys"),
        *[F.count_if(c).alias(a) for a, c in zip(attributes, conflicted)],
    )
    long = totals.unpivot("n_keys", attributes, "attribute", "n_conflicts")
    share = F.when(F.col("n_keys") > 0, F.col("n_conflicts") * 100.0 / F.col("n_keys"))
    return long.select("attribute", "n_conflicts", F.bround(share, 1).alias("pct_of_keys"))
