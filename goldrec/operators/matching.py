"""Resolve rows that carry only a name to a registry key.

Three passes of falling confidence: exact main name (1.0), exact alternative
name (0.9), most similar name (score / 100). Only what a pass leaves unresolved
reaches the next one.

The similarity of two names is ``100 * 2 * LCS / (len a + len b)`` over the
names with their words in alphabetical order. The similar pairs are found by an
equi-join that provably loses none, not by comparing every name with every
other:

* A pair with ``LCS >= s/200 * L`` (score s, total length L) has at least
  ``c = 3 * LCS - L + 1`` two-letter grams in common, counted with repeats and
  with one mark at either end: removing or adding one letter replaces at most
  two grams by one.
* With all grams in one global order, two sets of m and n grams sharing c of
  them share two already among their first ``m - c + 2`` and ``n - c + 2`` grams.
  So every such name is listed under all pairs of its first grams, and names
  meet only when they share a pair.
* The order puts first what makes the fewest meetings: grams rare in both
  tables. Grams the queries never use come before all others and list nothing.
* A pair of names is kept only at the first gram pair they share, and only if
  its lengths, its letters and its common grams allow the score. That happens
  inside the join, cheapest test first, so nothing is emitted twice and only
  likely pairs reach the scorer. The letters are compared as sets of bits: the
  names may differ in ``L - 2 * LCS`` letters, and every bit in which the two
  sets differ stands for at least one such letter.

Names are compared once per distinct text: copies of a name, however many rows
they make up, collapse before the join.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.functions.text import normalize_name, sort_tokens
from goldrec.session import stage

# FIXED VALUES
FUZZY_THRESHOLD = 80
MAIN_CONFIDENCE = 1.0
ALTERNATIVE_CONFIDENCE = 0.9
METHOD = "scoring"

# what a normalised name can hold, and the mark put at both ends
_ALPHABET = "|abcdefghijklmnopqrstuvwxyz0123456789 "
_BASE = len(_ALPHABET)
N_GRAMS = _BASE * _BASE

# the queries are broadcast only when their gram pairs take less than this
BROADCAST_BYTES = 64 << 20


# -- index ---------------------------------------------------------------------------


def build_name_index(
    registry: DataFrame,
    key: str,
    name_columns: list[str],
    active: Column | None = None,
    order: str | None = None,
) -> DataFrame:
    """One row (norm, key, ord) per normalised name of the active entities (MATCH-01).

    The first entity in the given order keeps a name; within an entity the
    columns come in the listed order. The default order is the key itself.
    """
    entities = registry if active is None else registry.where(active)
    position = F.col(order or key)
    names = F.array(*[F.struct(normalize_name(F.col(c)).alias("norm"), F.lit(i).alias("i")) for i, c in enumerate(name_columns)])
    rows = entities.select(
        F.col(key).alias("key"), position.alias("position"), F.explode(names).alias("name")
    ).where("name.norm != ''")
    first = F.struct("position", F.col("name.i").alias("i"), "key")
    best = rows.groupBy(F.col("name.norm").alias("norm")).agg(F.min(first).alias("ord"))
    return best.select("norm", "ord.key", F.struct("ord.position", "ord.i").alias("ord"))


# -- scoring ---------------------------------------------------------------------------


def _scoring():
    """The scorer and its two column functions.

    They are local functions so that Spark sends them to the workers by value:
    the workers need no copy of this package.
    """

    def places(a: str) -> dict[str, int]:
        """Where each letter stands, as bits."""
        where: dict[str, int] = {}
        for i, ch in enumerate(a):
            where[ch] = where.get(ch, 0) | (1 << i)
        return where

    def similarity(a: str, b: str, where: dict[str, int] | None = None) -> float:
        """Score of two token-sorted names, 0 to 100.

        The longest common subsequence is found with one row of bits, a few
        machine operations per letter of ``b``.
        """
        total = len(a) + len(b)
        if not total:
            return 0.0
        where = places(a) if where is None else where
        full = (1 << len(a)) - 1
        row = full
        for ch in b:
            hits = row & where.get(ch, 0)
            row = ((row + hits) | (row - hits)) & full
        common = len(a) - row.bit_count()
        return (1.0 - (total - 2 * common) / total) * 100

    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        known = {a: places(a) for a in left.unique()}  # once per name of the batch
        return pd.Series([similarity(a, b, known[a]) for a, b in zip(left, right)], dtype="float64")

    def confidence(scores: pd.Series) -> pd.Series:
        return scores.map(lambda s: None if s != s else round(s / 100, 2)).astype("float64")

    double = T.DoubleType()
    return similarity, F.pandas_udf(score, double), F.pandas_udf(confidence, double)


# similarity_score compares two columns; score_to_confidence rounds to two
# decimals on the exact binary value, which no built-in function does
similarity, similarity_score, score_to_confidence = _scoring()


# -- candidate pairs ----------------------------------------------------------------------


def _letters(text: Column) -> Column:
    """Letters of a text as their places in the alphabet."""
    return F.transform(F.split(text, ""), lambda ch: F.instr(F.lit(_ALPHABET), ch) - 1)


def _codes(text: Column) -> Column:
    """Two-letter grams of a text with its end marks, as numbers below N_GRAMS."""
    letters = _letters(F.concat(F.lit("|"), text, F.lit("|")))
    following = F.slice(letters, F.lit(2), F.size(letters) - 1)
    leading = F.slice(letters, F.lit(1), F.size(letters) - 1)
    return F.zip_with(leading, following, lambda a, b: a * _BASE + b)


def _numbered(elements: Column, base: int) -> Column:
    """Elements of a sorted array made distinct: the k-th repeat of v becomes v + k * base."""
    return F.transform(
        elements, lambda v, i: v + (i + 1 - F.array_position(elements, v)).cast("int") * base
    )


def _letter_bits(places: Column, word: int) -> Column:
    """One of the two words of a letter set: a bit per letter and repeat, folded to 128 bits."""

    def flip(bits: Column, place: Column) -> Column:
        here = F.pmod(place, F.lit(128)) - word * 64
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), here)
        return F.when((here >= 0) & (here < 64), bits.bitwiseXOR(bit)).otherwise(bits)

    return F.aggregate(places, F.lit(0).cast("bigint"), flip)


def _gram_counts(df: DataFrame) -> dict[int, int]:
    """Uses of every gram; at most N_GRAMS rows reach the driver whatever the table holds."""
    plain = F.pmod("gram", F.lit(N_GRAMS)).alias("gram")
    grams = df.select(F.explode("codes").alias("gram")).groupBy(plain).count()
    return {row["gram"]: row["count"] for row in grams.collect()}


def index_ranks(names: DataFrame) -> list[int]:
    """Place of every gram in an order that puts first what the fewest indexed names use."""
    listed = _gram_counts(names)
    ranks = [0] * N_GRAMS
    for place, gram in enumerate(sorted(range(N_GRAMS), key=lambda g: (listed.get(g, 0), g))):
        ranks[gram] = place
    return ranks


def _gram_ranks(queries: DataFrame, index: DataFrame) -> tuple[list[int], int]:
    """Place of every gram in the global order, and how many the queries never use.

    Counted over distinct names.
    """

    asked, listed = _gram_counts(queries), _gram_counts(index)
    by_meetings = sorted(range(N_GRAMS), key=lambda g: (asked.get(g, 0) * listed.get(g, 0), g))
    ranks = [0] * N_GRAMS
    for place, gram in enumerate(by_meetings):
        ranks[gram] = place
    return ranks, sum(1 for g in by_meetings if not asked.get(g, 0) * listed.get(g, 0))


def ordered_grams(numbered: Column, ranks: list[int]) -> Column:
    """Grams of a name in the global order; a repeated gram counts as a rarer one."""
    table = F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")

    def place(gram: Column) -> Column:
        plain = F.pmod(gram, F.lit(N_GRAMS))
        return F.element_at(table, plain + 1) - (gram - plain)

    return F.sort_array(F.transform(numbered, place))


def _least_common(total: Column, score: float) -> Column:
    """Letters that two names of this total length must have in common, in order."""
    return F.ceil(total * (score / 200) - 1e-9)


def prefix_size(n: Column, score: float) -> Column:
    """How many first grams of a name of n letters to list, for any partner length the score allows."""
    shortest = F.ceil(n * (score / (200 - score)) - 1e-9)
    fewest = F.ceil((n + shortest) * (3 * score / 200 - 1) + 1 - 1e-9)
    return F.least(n + 1, n + 3 - fewest).cast("int")


def likely_similar(score: float) -> Column:
    """Whether lengths and letter bits of a query (q_) and an indexed name (x_) allow the score."""
    total = F.col("q_n") + F.col("x_n")
    least = _least_common(total, score)
    differing = F.bit_count(F.col("q_low").bitwiseXOR(F.col("x_low"))) + F.bit_count(
        F.col("q_high").bitwiseXOR(F.col("x_high"))
    )
    return (F.least("q_n", "x_n") >= least) & (differing <= total - least * 2)


def enough_common(score: float) -> Column:
    """Whether the grams of a query and an indexed name allow the score."""
    total = F.col("q_n") + F.col("x_n")
    return F.size(F.array_intersect("q_grams", "x_grams")) >= _least_common(total, score) * 3 - total + 1


def _pair_code(first: Column, second: Column) -> Column:
    return F.shiftleft(first.cast("bigint"), 32) + second.cast("bigint")


def gram_pairs(grams: Column) -> Column:
    """Every pair of the listed grams, in order, as one number each."""
    return F.flatten(
        F.transform(
            grams,
            lambda g, i: F.transform(
                F.slice(grams, i + 2, F.size(grams)), lambda h: _pair_code(g, h)
            ),
        )
    )


def listing_bytes(queries: DataFrame, score: float) -> tuple[int, int]:
    """Number of queries and an upper bound of the size of their gram pairs."""
    listed = prefix_size(F.col("n"), score)
    size = F.sum(listed * (listed - 1) / 2 * (F.col("n") * 12 + 100))
    count, total = queries.agg(F.count(F.lit(1)), size).first()
    return count, int(total or 0)


def similar_pairs(
    queries: DataFrame, index: DataFrame, ranks: list[int], unused: int, score: float, broadcast: bool
) -> DataFrame:
    """(text, sorted names, key, ord) of all pairs that may reach the score.

    When the queries are broadcast the whole test happens in the join. Otherwise
    only (pair, id, n, letter bits) is shuffled, repeats of a pair of ids
    collapse, and the texts and grams come back by an equi-join on the id.
    """

    def spelled(df: DataFrame, side: str) -> DataFrame:
        grams = F.col(f"{side}_grams")
        named = df.withColumn(f"{side}_grams", ordered_grams(F.col("codes"), ranks))
        first = F.slice(grams, F.lit(1), prefix_size(F.col("n"), score))
        can_meet = F.filter(first, lambda g: F.pmod(g, F.lit(N_GRAMS)) >= unused)
        own = [F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "codes"]
        return named.select(*own, grams, can_meet.alias(f"{side}_prefix"))

    def listed(df: DataFrame, side: str, *columns: str) -> DataFrame:
        pairs = F.explode(gram_pairs(F.col(f"{side}_prefix"))).alias("pair")
        return df.select(pairs, *(columns or df.columns))

    all_q, all_x = spelled(queries, "q"), spelled(index, "x")
    if broadcast:
        q, x = listed(all_q, "q"), listed(all_x, "x")
    else:
        q, x = (listed(d, s, *(f"{s}_{c}" for c in ("id", "n", "low", "high"))) for d, s in ((all_q, "q"), (all_x, "x")))
    likely = (q["pair"] == x["pair"]) & likely_similar(score)
    common = enough_common(score)
    if broadcast:
        shared = F.array_intersect("q_prefix", "x_prefix")
        first_shared = _pair_code(F.try_element_at(shared, F.lit(1)), F.try_element_at(shared, F.lit(2)))
        joined = x.join(F.broadcast(q), likely & (first_shared == q["pair"]) & common)
    else:
        met = x.join(q, likely).select("q_id", "x_id").distinct()
        joined = met.join(all_q, "q_id").join(all_x, "x_id").where(common)
    return joined.select("q_text", "q_sorted", "x_sorted", "x_key", "x_ord")


def best_match(candidates: DataFrame, score: float) -> DataFrame:
    """Highest score per query text, the first in index order among equals (MATCH-04, SRT-03)."""
    scored = candidates.withColumn("score", similarity_score("q_sorted", "x_sorted"))
    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("x_ord"), F.col("x_key")))
    top = scored.where(F.col("score") >= score).groupBy("q_text").agg(best.alias("best"))
    return top.select(
        F.col("q_text").alias("text"),
        (-F.col("best.minus")).alias("score"),
        F.col("best.x_key").alias("key"),
    )


def spelled_names(df: DataFrame, *columns: str) -> DataFrame:
    """Names (first column) with sorted words, length, gram codes, letter bits and an id; stage it, so that the ids stay."""
    ordered = df.withColumn("sorted", sort_tokens(F.col(columns[0])))
    spelled = ordered.select(
        *columns,
        "sorted",
        F.length("sorted").alias("n"),
        F.sort_array(_codes(F.col("sorted"))).alias("codes"),
        F.sort_array(_letters(F.col("sorted"))).alias("letters"),
    )
    numbered = spelled.withColumns(
        {"codes": _numbered(F.col("codes"), N_GRAMS), "letters": _numbered(F.col("letters"), _BASE)}
    )
    bits = {side: _letter_bits(F.col("letters"), word) for word, side in enumerate(("low", "high"))}
    return numbered.withColumns({**bits, "id": F.monotonically_increasing_id()}).drop("letters")


def fuzzy_lookup(
    texts: DataFrame, index: DataFrame, threshold: float = FUZZY_THRESHOLD, levels: tuple[float, ...] = (90,)
) -> DataFrame:
    """Best index entry (text, score, key) of each distinct normalised text, if any reaches the threshold.

    The search starts at high scores, where few names can meet, and goes on to
    the threshold only with the texts that found nothing: a best match above a
    level is the best match of all, so this changes the cost and not the result.
    """
    if not 67 <= threshold <= 100:
        raise ValueError("the gram bound needs a threshold of 67 to 100")

    names = stage(spelled_names(index, "norm", "key", "ord"), "index-names")
    open_texts = stage(spelled_names(texts, "text"), "query-names")

    # same words in another order: a plain join on the sorted words
    same = names.groupBy("sorted").agg(F.min(F.struct("ord", "key")).alias("first"))
    equal = open_texts.join(same, "sorted").select(
        "text", F.lit(100.0).alias("score"), F.col("first.key").alias("key")
    )
    found = [stage(equal, "matches")]
    ranks = None
    for level in [*[s for s in levels if s > threshold], threshold]:
        open_texts = stage(open_texts.join(found[-1].select("text"), "text", "left_anti"), "query-names")
        n_open, size = listing_bytes(open_texts, level)
        if not n_open:
            break
        if ranks is None:
            ranks, unused = _gram_ranks(open_texts, names)
        pairs = similar_pairs(open_texts, names, ranks, unused, level, size <= BROADCAST_BYTES)
        found.append(stage(best_match(pairs, level), "matches"))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


# -- resolution -------------------------------------------------------------------------------


def resolve_by_name(
    df: DataFrame,
    index: DataFrame,
    name: str = "NOM",
    alt_name: str | None = "NOM_STRC_PORT",
    fuzzy: bool = True,
    threshold: float = FUZZY_THRESHOLD,
    key: str = "siren",
    lookup: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows of ``df`` with key, confidence, method and the pass that resolved them (MATCH-02…05).

    Similar names come from ``lookup``, such as that of a stored index, or from a search in ``index`` itself.

    Unresolved rows keep nulls. The column ``match_pass`` holds 1, 2, 3 or null.
    """
    has_alt = bool(alt_name) and alt_name in df.columns
    alt = normalize_name(F.col(alt_name)) if has_alt else F.lit("")
    named = df.drop(key, "confiance_jointure", "methode_jointure").withColumns(
        {"_main": normalize_name(F.col(name)), "_alt": alt}
    )
    if fuzzy:
        named, index = stage(named, "named-rows"), stage(index, "name-index")

    # both exact passes and the fuzzy one look up distinct texts, so a text that
    # fills a third of the rows is looked up once
    texts = (
        named.select(F.explode(F.array("_main", "_alt")).alias("text")).where("text != ''").distinct()
    )
    exact = texts.join(index.select(F.col("norm").alias("text"), F.col("key")), "text")
    if fuzzy:
        exact = stage(exact, "exact-matches")
    rows = _attach_match(_attach_match(named, exact, "_main", "_k1"), exact, "_alt", "_k2")

    if fuzzy:
        missed = rows.where(F.coalesce("_k1", "_k2").isNull())
        asked = missed.select(F.explode(F.array("_main", "_alt")).alias("text")).where("text != ''")
        similar = lookup(asked.distinct()) if lookup else fuzzy_lookup(asked.distinct(), index, threshold)
        # rounded once per matched text, not per row
        similar = similar.withColumn("confidence", score_to_confidence("score"))
        rows = _attach_match(rows, similar, "_main", "_k3", _s3="score", _c3="confidence")
        rows = _attach_match(rows, similar, "_alt", "_k4", _s4="score", _c4="confidence")
    else:
        nothing = {c: F.lit(None).cast("string") for c in ("_k3", "_k4")}
        nothing |= {c: F.lit(None).cast("double") for c in ("_s3", "_s4", "_c3", "_c4")}
        rows = rows.withColumns(nothing)

    # the alternative name wins only with a strictly higher score
    alt_wins = F.coalesce(F.col("_s4") > F.col("_s3"), F.col("_s3").isNull())
    fuzzy_key = F.when(alt_wins, F.col("_k4")).otherwise(F.col("_k3"))
    fuzzy_confidence = F.when(alt_wins, F.col("_c4")).otherwise(F.col("_c3"))
    match_pass = (
        F.when(F.col("_k1").isNotNull(), 1)
        .when(F.col("_k2").isNotNull(), 2)
        .when(fuzzy_key.isNotNull(), 3)
    )
    rows = rows.withColumns({"match_pass": match_pass, "_confidence": fuzzy_confidence, "_fuzzy": fuzzy_key})
    confidence = F.when(F.col("match_pass") == 1, F.lit(MAIN_CONFIDENCE)).when(
        F.col("match_pass") == 2, F.lit(ALTERNATIVE_CONFIDENCE)
    )
    if fuzzy:
        confidence = confidence.when(F.col("match_pass") == 3, F.col("_confidence"))
    resolved = rows.withColumns(
        {
            key: F.coalesce("_k1", "_k2", "_fuzzy"),
            "confiance_jointure": confidence,
            "methode_jointure": F.when(F.col("match_pass").isNotNull(), F.lit(METHOD)),
        }
    )
    return resolved.drop("_main", "_alt", "_k1", "_k2", "_k3", "_k4", "_s3", "_s4", "_c3", "_c4", "_confidence", "_fuzzy")


def _attach_match(rows: DataFrame, matches: DataFrame, text: str, key: str, **more: str) -> DataFrame:
    """Left join with the matches of one name column; '' and null meet nothing.

    However many rows have no name, a shuffle deals them evenly: they join on a
    hash of the row behind a sign that no normalised name holds.
    """
    columns = [F.col("text").alias(f"_t{key}"), F.col("key").cast("string").alias(key)]
    right = matches.select(*columns, *[F.col(c).alias(name) for name, c in more.items()])
    spread = F.concat(F.lit("#"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("string"))
    keyed = rows.withColumn("_name", F.when(F.col(text) != "", F.col(text)).otherwise(spread))
    return keyed.join(right, keyed["_name"] == right[f"_t{key}"], "left").drop("_name", f"_t{key}")


def match_summary(resolved: DataFrame) -> DataFrame:
    """Rows per pass, 0 for unresolved (MATCH-06)."""
    passes = F.coalesce("match_pass", F.lit(0)).alias("match_pass")
    return resolved.groupBy(passes).agg(F.count(F.lit(1)).alias("n"))
