"""Language identification by interpolated Kneser-Ney character models.

A letter is predicted from up to three letters before it in its word (and the end of a word likewise). Four-letter
sequences are counted over all training texts; the lower orders count distinct continuations, as Kneser and Ney
have it. Probabilities are interpolated by joins on sequences, for all languages at once. The finished model has a row for
every sequence of every order, with its log probabilities per language. Up to BROADCAST_LIMIT bytes it is broadcast as
arrays sorted by sequence; a larger one stays in Spark and is joined with the sequences of the texts. The language with the lowest cross-entropy per symbol wins. A temperature fitted on all training texts turns
the differences into a score, and a bound on the cross-entropy learned per language marks texts that fit none. Both are
learned from cross-entropies under the half of the training texts that a text is not in: a model that keeps every
sequence knows its own texts better than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import BROADCAST_LIMIT, slices
from goldrec.session import stage

ORDER = 4
#: Bits of a symbol: 0 ends a word, 1-26 are a-z, other letters share what is left.
SYMBOL_BITS = 12
SYMBOLS = 1 << SYMBOL_BITS
DISCOUNT = 0.75
FLUSH = 1_500_000
TEMPERATURES = [0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0]
#: A text is rejected above mean + REJECT deviations of the cross-entropy of its language's training texts.
REJECT = 4.0
UNKNOWN = "und"

_symbols: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """Code point of the first plane -> symbol."""
    if not _symbols:
        table = np.zeros(1 << 16, np.int64)
        for c in range(1 << 16):
            ch = chr(c)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                table[c] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
        _symbols.append(table)
    return _symbols[0]


def symbols_of(data: np.ndarray, rows_off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, sequence of ORDER symbols, whether the row has a letter) for each predicted symbol of each row."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    table = symbol_table()
    high = points >= 1 << 16
    ids = table[np.where(high, 0, points)]
    for i in np.flatnonzero(high):
        if chr(points[i]).isalpha():
            ids[i] = 27 + int(points[i]) % (SYMBOLS - 27)
    off = at[rows_off]
    # a word end after each row
    a = np.insert(ids, off[1:], 0)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off) + 1)
    context, gram, shift = a, a.copy(), 0
    for k in range(1, ORDER):
        before = np.zeros_like(a)
        before[k:] = a[:-k] if k < len(a) else 0
        # nothing reaches back over a word end
        context = np.where(context == 0, 0, before) if k > 1 else before
        shift += SYMBOL_BITS
        gram |= context << shift
    letters = np.bincount(row[a > 0], minlength=len(off) - 1) > 0
    keep = gram > 0
    return row[keep], gram[keep], letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = 0

    def merged(parts):
        g = np.concatenate([p[0] for p in parts])
        c = np.concatenate([p[1] for p in parts])
        order = np.argsort(g, kind="stable")
        g, c = g[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        return g[first], np.add.reduceat(c, first)

    def flush():
        rows = [(lang, *merged(parts)) for lang, parts in held.items()]
        return pa.record_batch([
            pa.array(np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]).tolist(), pa.string()),
            np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]),
        ], ["lang", "gram", "c"])

    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for low, high, data, off in slices(batch.column(0)):
            row, gram, _ = symbols_of(data, off)
            own = langs[low:high][row]
            for lang in set(langs[low:high]):
                g, c = np.unique(gram[own == lang], return_counts=True)
                if len(g):
                    held.setdefault(lang, []).append((g, c))
                    size += len(g)
        if size > FLUSH:
            yield flush()
            held, size = {}, 0
    if size:
        yield flush()


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, c) over all training texts (text, lang)."""
    return training.select("text", "lang").mapInArrow(_count, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """languages; per order the log probabilities of sequences and the log weights of contexts, and how many sequences there are.

    A table has rows (gram, x), one for each sequence seen in any language; x holds a value per column. The columns are
    the languages, and after them, in a model with halves, the languages by the first half of the texts and by the second.
    """

    languages: list[str]
    width: int
    grams: dict[int, DataFrame]
    weights: dict[int, DataFrame]
    size: int = 0

    def row_bytes(self) -> int:
        return 8 + 4 * self.width

    def arrays(self) -> Arrays:
        """The tables on the driver: only for a model that may be broadcast."""
        return Arrays(self.width, *({k: self._sorted(t) for k, t in tables.items()} for tables in (self.grams, self.weights)))

    def _sorted(self, table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = table.toArrow()
        gram = np.asarray(found["gram"].combine_chunks())
        x = np.asarray(found["x"].combine_chunks().flatten()).reshape(-1, self.width)
        order = np.argsort(gram)
        return gram[order], x[order]


@dataclass
class Arrays:
    """Per order the sorted sequences and their rows of log probabilities, and the same for the weights of contexts."""

    width: int
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    weights: dict[int, tuple[np.ndarray, np.ndarray]]


def half_of(text: str):
    """0 or 1; copies of a text are in one half."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def train(training: DataFrame, halves: bool = False) -> Model:
    """Fit on rows (text, lang) with a language; rows with null text count nothing. With ``halves`` also on each half alone."""
    rows = training.where("lang IS NOT NULL AND text IS NOT NULL")
    tag = half_of("text").cast("string") if halves else F.lit("=")
    counts = stage(gram_counts(rows.select("text", F.concat(tag, "lang").alias("lang"))), "grams")
    names = sorted({r.lang[1:] for r in counts.select("lang").distinct().collect()})
    if not names:
        return Model([], 0, {}, {})
    languages = [t + x for t in ("=01" if halves else "=") for x in names]
    if halves:
        counts = counts.unionByName(counts.groupBy(F.concat(F.lit("="), F.expr("substring(lang, 2)")).alias("lang"), "gram").agg(F.sum("c").alias("c")))
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * k) - 1))
        tables[k] = tables[k + 1].groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    lower, grams, weights, size = None, {}, {}, 0
    for k in range(1, ORDER + 1):
        own = tables[k].withColumn("context", F.shiftright("gram", SYMBOL_BITS))
        context = own.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"))
        share = F.col("types") * DISCOUNT / F.col("total")
        # every sequence seen in any language, for each language
        all_rows = own.select("gram", "context").distinct().select("gram", "context", F.explode(F.array(*map(F.lit, languages))).alias("lang"))
        rows = all_rows.join(own.select("lang", "gram", "c"), ["lang", "gram"], "left").join(context, ["lang", "context"], "left")
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * (k - 1)) - 1))
            rows = rows.withColumn("suffix", suffix).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"], "left")
        p = F.coalesce(F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / F.col("total"), F.lit(0.0)) + F.coalesce(share, F.lit(1.0)) * F.coalesce("below", F.lit(1.0 / SYMBOLS))
        lower = stage(rows.select("lang", "gram", p.alias("p")), f"order{k}")
        grams[k] = _table(lower.select("lang", "gram", F.ln("p").alias("x")), languages)
        weights[k] = _table(context.select("lang", F.col("context").alias("gram"), F.ln(share).alias("x")), languages)
        size += lower.count() // len(languages)
    return Model(names, len(languages), grams, weights, size)


def _table(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(gram, x) with a value per language. A context that a language lacks has weight 1 there."""
    values = [F.coalesce(F.max(F.when(F.col("lang") == lang, F.col("x"))), F.lit(0.0)).cast("float") for lang in languages]
    return rows.groupBy("gram").agg(F.array(*values).alias("x"))


def _find(table: tuple[np.ndarray, np.ndarray], gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hit, row) of each sequence; only an equal sequence is a hit."""
    keys = table[0]
    if not len(keys):
        return np.zeros(len(gram), bool), np.zeros(len(gram), np.int64)
    at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
    return keys[at] == gram, at


def log_likelihood(model: Arrays, gram: np.ndarray) -> np.ndarray:
    """Rows of log probabilities per language; an unseen sequence falls back on shorter ones."""
    out = np.zeros((len(gram), model.width), np.float32)
    left = np.arange(len(gram))
    for k in range(ORDER, 0, -1):
        own = gram[left] & ((1 << SYMBOL_BITS * k) - 1)
        hit, at = _find(model.grams[k], own)
        out[left[hit]] += model.grams[k][1][at[hit]]
        left, own = left[~hit], own[~hit]
        if not len(left):
            return out
        known, at = _find(model.weights[k], own >> SYMBOL_BITS)
        out[left[known]] += model.weights[k][1][at[known]]
    out[left] += np.float32(-np.log(SYMBOLS))
    return out


def log_likelihoods(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, x) of distinct rows (gram), as log_likelihood has it, by joins with the tables of the model."""
    add = lambda a, b: F.zip_with(a, b, lambda x, y: (x + y).cast("float"))
    zero = F.array(*[F.lit(0.0).cast("float")] * model.width)
    rows = grams.select("gram", zero.alias("x"), F.lit(False).alias("found"))
    for k in range(ORDER, 0, -1):
        rows = rows.withColumn("own", F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * k) - 1))).withColumn("context", F.shiftright("own", SYMBOL_BITS))
        rows = rows.join(model.grams[k].select(F.col("gram").alias("own"), F.col("x").alias("p")), "own", "left")
        rows = rows.join(model.weights[k].select(F.col("gram").alias("context"), F.col("x").alias("w")), "context", "left")
        more = F.when(F.col("p").isNotNull(), F.col("p")).otherwise(F.coalesce("w", zero))
        rows = rows.select("gram", F.when(F.col("found"), F.col("x")).otherwise(add(F.col("x"), more)).alias("x"), (F.col("found") | F.col("p").isNotNull()).alias("found"))
    last = F.array(*[F.lit(float(-np.log(SYMBOLS))).cast("float")] * model.width)
    return rows.select("gram", F.when(F.col("found"), F.col("x")).otherwise(add(F.col("x"), last)).alias("x"))


def cross_entropies(docs: DataFrame, model: Model, *keep: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The kept columns with n (symbols), letters, and entropy: one value per language, in nats a symbol.

    A model of at most ``limit`` bytes is broadcast; there are no more contexts than sequences.
    """
    if 2 * model.size * model.row_bytes() > limit:
        return _joined_entropies(docs, model, keep)
    held = docs.sparkSession.sparkContext.broadcast(model.arrays())
    kept = docs.select(*keep, "text")
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        for batch in batches:
            for low, high, data, off in slices(batch.column(len(keep)), 1 << 18):
                row, gram, letters = symbols_of(data, off)
                scores = log_likelihood(fitted, gram)
                n = np.bincount(row, minlength=high - low)
                sums = np.stack([np.bincount(row, scores[:, i], high - low) for i in range(fitted.width)], 1) if fitted.width else np.zeros((high - low, 0))
                entropy = -sums / np.maximum(n, 1)[:, None]
                yield pa.record_batch([*(batch.column(i).slice(low, high - low) for i in range(len(keep))), n, letters, pa.array(list(entropy), pa.list_(pa.float64()))], [*keep, "n", "letters", "entropy"])

    return kept.mapInArrow(run, f"{fields}, n long, letters boolean, entropy array<double>")


def _row_grams(width: int):
    """The kept columns with n, letters, and the distinct sequences of each text with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, off in slices(batch.column(width), 1 << 20):
                row, gram, letters = symbols_of(data, off)
                order = np.lexsort((gram, row))
                r, g = row[order], gram[order]
                first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (g[1:] != g[:-1])))) if len(r) else np.zeros(0, np.int64)
                bounds = np.searchsorted(r[first], np.arange(high - low + 1)).astype(np.int32)
                counts = np.diff(np.append(first, len(r)))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int64())) for x in (g[first], counts)]
                names = [*batch.schema.names[:width], "n", "letters", "grams", "counts"]
                yield pa.record_batch([*(batch.column(i).slice(low, high - low) for i in range(width)), np.bincount(row, minlength=high - low), letters, *lists], names)

    return run


def _joined_entropies(docs: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    """cross_entropies by joins: rows are numbered once they are stored, and their sequences meet the model in Spark."""
    kept = docs.select(*keep, "text")
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])
    found = kept.mapInArrow(_row_grams(len(keep)), f"{fields}, n long, letters boolean, grams array<bigint>, counts array<bigint>")
    rows = stage(found.withColumn("_row", F.monotonically_increasing_id()), "row_grams")
    pairs = rows.select("_row", F.explode(F.arrays_zip("grams", "counts")).alias("g")).select("_row", F.col("g.grams").alias("gram"), F.col("g.counts").alias("c"))
    tables = Model(model.languages, model.width, *({k: stage(t, "model") for k, t in x.items()} for x in (model.grams, model.weights)), model.size)
    scores = stage(log_likelihoods(pairs.select("gram").distinct(), tables), "scores")
    sums = pairs.join(scores, "gram").groupBy("_row").agg(*[F.sum(F.col("c") * F.col("x")[i].cast("double")).alias(f"s{i}") for i in range(model.width)])
    entropy = F.array(*[-F.coalesce(F.col(f"s{i}"), F.lit(0.0)) / F.greatest(F.col("n"), F.lit(1)) for i in range(model.width)])
    return rows.drop("grams", "counts").join(sums, "_row", "left").select(*keep, "n", "letters", entropy.alias("entropy"))


def _posterior(best, temperature):
    """Score of the best language from the differences of the cross-entropies."""
    return 1 / F.aggregate("entropy", F.lit(0.0), lambda a, x: a + F.exp((best - x) * temperature * F.sqrt(F.col("n"))))


def identify(docs: DataFrame, model: Model, training: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of (doc_id, text).

    Null, empty and letterless texts are ``und`` with score 0 and rejected. Repeated rows get equal answers. Without
    any training text every row is ``und``. ``training`` says by a boolean column which rows of docs may calibrate.
    The model has halves.
    """
    if not model.languages:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    names = F.array(*map(F.lit, model.languages))
    best = F.array_min("entropy")
    scored = stage(cross_entropies(training.withColumn("half", half_of("text")), model, "doc_id", "lang", "calibrate", "half"), "entropies")
    n = len(model.languages)
    other = F.slice("entropy", F.lit(1 + 2 * n) - F.col("half") * n, F.lit(n))
    fit = scored.where("calibrate AND letters AND lang IS NOT NULL").withColumn("entropy", other).withColumn("best", best)
    scored = scored.withColumn("entropy", F.slice("entropy", 1, n)).withColumn("best", best)
    place = F.array_position(names, F.col("lang")).cast("int")
    true = F.element_at("entropy", place)
    losses = [F.avg(-F.ln(F.greatest(F.lit(1e-12), F.exp((F.col("best") - true) * t * F.sqrt("n")) * _posterior(F.col("best"), t)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    found = fit.agg(*losses).first()
    temperature = min(zip(found, TEMPERATURES, strict=True), key=lambda x: (x[0] is None, x[0]))[1]
    bounds = {r.lang: r.m + REJECT * (r.s or 0.0) for r in fit.groupBy("lang").agg(F.avg(true).alias("m"), F.stddev_pop(true).alias("s")).collect()}
    bound = F.array(*[F.lit(float(bounds.get(x, 0.0))) for x in model.languages])
    at = F.array_position("entropy", F.col("best")).cast("int")
    return scored.select(
        "doc_id",
        F.when(F.col("letters"), F.element_at(names, at)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), _posterior(F.col("best"), temperature)).otherwise(0.0).alias("score"),
        F.when(F.col("letters"), F.col("best") > F.element_at(bound, at)).otherwise(True).alias("rejected"),
    )


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) leaves 0 or 2 modulo 3; predict all.

    A row without doc_id is never learned from. Columns besides doc_id, text and lang are ignored.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
    rows = docs.select("doc_id", "text", "lang", (~held_out & F.col("lang").isNotNull()).alias("calibrate"))
    model = train(rows.where("calibrate"), halves=True)
    found = identify(docs, model, rows)
    return found.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True)).alias("held_out"), "lang_pred", "score", "rejected")
