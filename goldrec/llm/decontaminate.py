"""Benchmark decontamination with one FM-index per shard of training text.

A shard is a bounded run of texts. Its words become numbers of the test vocabulary; a word that no test phrase holds
cannot lie in an occurrence, so only runs of vocabulary words that are as long as the shortest phrase are indexed, each
run behind a separator. The suffixes are sorted by prefix doubling; the Burrows-Wheeler transform lies in a wavelet
matrix that answers ranks; every SAMPLE-th position is kept. All phrases are searched backwards together, one word a
step, and each match is walked to a sampled position. Overlapping occurrences merge into removal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm import words
from goldrec.llm.common import slices, unused_name
from goldrec.session import stage

WINDOW = 10
SAMPLE = 8
#: Benchmark words that are searched, and so broadcast, at once; more are searched in further passes.
BLOCK_WORDS = 2_000_000
#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20


class FMIndex:
    """Search phrases in a sequence of symbols 1.. (0 separates texts)."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        text = np.append(sequence, 0).astype(np.int64)
        n = len(text)
        order = self._suffixes(text)
        last = text[order - 1]  # of the suffix at 0 it is the final separator
        self.first = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=symbols + 1))))
        self.bits = max(1, int(symbols).bit_length())
        self.levels, self.zeros = [], []
        at = last
        for level in range(self.bits - 1, -1, -1):
            bit = (at >> level) & 1
            self.levels.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(n - int(bit.sum()))
            at = np.concatenate((at[bit == 0], at[bit == 1]))
        self.last = last
        kept = (order % SAMPLE == 0) | (last == 0)
        self.kept = kept
        self.place = np.cumsum(kept) - 1
        self.samples = order[kept]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix order. Separators differ by position, so that texts end apart."""
        n = len(text)
        zero = text == 0
        rank = np.where(zero, np.cumsum(zero) - 1, text + zero.sum())
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1 if width < n else 0
            key = rank * (n + int(zero.sum()) + int(text.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            fresh = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                return order
            width *= 2

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position of the transform."""
        low, high = np.zeros(len(symbol), np.int64), position.copy()
        for i, (ones, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            a, b = ones[low], ones[high]
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return high - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [low, high) of phrases (rows, filled up with zeros at the end)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        live = np.arange(len(phrases))
        for back in range(int(lengths.max()) if len(lengths) else 0):
            live = live[(lengths[live] > back) & (low[live] < high[live])]
            symbol = phrases[live, lengths[live] - 1 - back]
            low[live], high[live] = (self.first[symbol] + self.rank(symbol, x[live]) for x in (low, high))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in these rows."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            done = self.kept[at[live]]
            own = live[done]
            out[own] = self.samples[self.place[at[own]]] + steps[own]
            live = live[~done]
            symbol = self.last[at[live]]
            at[live] = self.first[symbol] + self.rank(symbol, at[live])
            steps[live] += 1
        return out


@dataclass
class Phrases:
    """Windows of test items: vocabulary of word hashes, symbol rows, and the items of each window."""

    vocabulary: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray
    items: list[list]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases_of(item_ids: list, texts: list[str | None]) -> Phrases:
    """All windows of WINDOW words; an item with fewer words is one window, one without words none."""
    column = pa.array(texts, pa.string())
    by_window: dict[tuple, set] = {}
    for low, high, data, off in slices(column):
        row, _, _, h = words.find_words(data, off, words.ALPHANUMERIC)
        bounds = np.searchsorted(row, np.arange(high - low + 1))
        for i in range(high - low):
            own = h[bounds[i] : bounds[i + 1]].tolist()
            for at in range(max(1, len(own) - WINDOW + 1) if own else 0):
                by_window.setdefault(tuple(own[at : at + WINDOW]), set()).add(item_ids[low + i])
    vocabulary = np.unique(np.array([w for k in by_window for w in k], np.uint64))
    number = {int(w): i + 1 for i, w in enumerate(vocabulary)}
    rows = np.zeros((len(by_window), WINDOW), np.int64)
    lengths = np.array([len(k) for k in by_window], np.int64)
    for i, k in enumerate(by_window):
        rows[i, : len(k)] = [number[w] for w in k]
    return Phrases(vocabulary, rows, lengths, [sorted(v, key=str) for v in by_window.values()])


def occurrences(phrases: Phrases, row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, word, length) of each occurrence in a shard, and nothing else; word counts over the whole shard."""
    none = np.zeros(0, np.int64)
    if not len(h) or not len(phrases.lengths):
        return none, none, none
    at = np.minimum(np.searchsorted(phrases.vocabulary, h), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == h
    # runs of known words of one text
    fresh = np.concatenate(([True], (known[1:] != known[:-1]) | (row[1:] != row[:-1])))
    run = np.cumsum(fresh) - 1
    keep = known & (np.bincount(run)[run] >= phrases.shortest)
    word = np.flatnonzero(keep)
    if not len(word):
        return none, none, none
    # a separator before each run
    opens = np.concatenate(([True], run[word][1:] != run[word][:-1]))
    place = np.arange(len(word)) + np.cumsum(opens)
    sequence = np.zeros(place[-1] + 1, np.int64)
    sequence[place] = at[word] + 1
    origin = np.full(len(sequence) + 1, -1, np.int64)
    origin[place] = word
    index = FMIndex(sequence, len(phrases.vocabulary))
    low, high = index.search(phrases.rows, phrases.lengths)
    count = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(count)), count)
    suffix = np.repeat(low, count) + np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    return window, origin[index.locate(suffix)], phrases.lengths[window]


def merge_spans(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Union of [start, start + length) as disjoint sorted spans."""
    out: list[list[int]] = []
    for s, e in sorted(zip(start.tolist(), (start + length).tolist(), strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _shards(texts: pa.Array, phrases: Phrases) -> Iterator[tuple[int, int, list[int], dict[int, tuple[list, list, list]]]]:
    """(low, high, words per row, {row: (word spans, byte spans, items)}) of each shard of a batch."""
    for low, high, data, off in slices(texts, SHARD_BYTES):
        row, start, end, h = words.find_words(data, off, words.ALPHANUMERIC)
        window, word, length = occurrences(phrases, row, h, high - low)
        count = np.bincount(row, minlength=high - low)
        first = np.cumsum(count) - count
        hits: dict[int, tuple[list, list, list]] = {}
        order = np.argsort(row[word], kind="stable")
        bounds = np.flatnonzero(np.diff(row[word][order], prepend=-1, append=-2)) if len(word) else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[a:b]
            i = int(row[word[own[0]]])
            spans = merge_spans(word[own], length[own])
            items = sorted({x for w in np.unique(window[own]) for x in phrases.items[w]}, key=str)
            in_row = [(s - first[i], e - first[i]) for s, e in spans]
            in_bytes = [(int(start[s] - off[i]), int(end[e - 1] - off[i])) for s, e in spans]
            hits[i] = (in_row, in_bytes, items)
        yield low, high, count.tolist(), hits


def phrase_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The test phrases in blocks of bounded size; an item without id or words is left out."""
    items = stage(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text"), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // (4 * block_words)) or 1
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow() if blocks > 1 else items.toArrow()
        yield phrases_of(own["item_id"].to_pylist(), own["text"].to_pylist())


def _scan(phrases, first: bool, last: bool):
    """Rows (doc_id, text, n_words, spans, items) with the finds of these phrases added; the first scan gets (doc_id, text), the last drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count, hits in _shards(batch.column(1), phrases.value):
                old = [([], [])] * (high - low) if first else list(zip(*(batch.column(c).slice(low, high - low).to_pylist() for c in (3, 4)), strict=True))
                spans, items = [], []
                for i, (known, names) in enumerate(old):
                    more, _, found = hits.get(i, ([], [], []))
                    both = np.array([*((x["start"], x["end"]) for x in known), *more], np.int64).reshape(-1, 2)
                    spans.append([{"start": int(s), "end": int(e)} for s, e in merge_spans(both[:, 0], both[:, 1] - both[:, 0])])
                    items.append(sorted({*names, *map(str, found)}))
                columns = {
                    "doc_id": batch.column(0).slice(low, high - low), "text": batch.column(1).slice(low, high - low), "n_words": pa.array(count, pa.int64()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "items": pa.array(items, pa.list_(pa.string())),
                }
                if last:
                    del columns["text"]
                yield pa.record_batch(list(columns.values()), list(columns))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, spans, items): word spans [start, end) inside occurrences, and the ids of the items they belong to, as sorted text.

    Null and empty texts have no words. Each row gives a row, whatever its id. With a benchmark larger than one block
    every row passes by all blocks and gathers its spans and items on the way.
    """
    spark = docs.sparkSession
    key = dict(docs.dtypes)["doc_id"]
    found = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    rows = docs.select("doc_id", "text")
    blocks = [spark.sparkContext.broadcast(phrases) for phrases in phrase_blocks(benchmark, block_words)]
    for i, held in enumerate(blocks):
        last = i == len(blocks) - 1
        rows = rows.mapInArrow(_scan(held, i == 0, last), f"doc_id {key}, {found}" if last else f"doc_id {key}, text string, {found}")
    return rows


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without sorted byte spans; a line feed takes the place of each."""
    raw, kept, at = text.encode(), [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    return b"\n".join([*kept, raw[at:]]).decode()


def clean_text(text: str, phrases: Phrases) -> str:
    """The text without removal spans; a line feed takes the place of each. Repeats until nothing is left to remove."""
    while True:
        spans = [s for _, _, _, hits in _shards(pa.array([text], pa.string()), phrases) for own in hits.values() for s in own[1]]
        if not spans:
            return text
        text = cut(text, spans)


def join_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Byte spans of the union of word spans [start, end) with their bytes [low, high)."""
    out: list[list[int]] = []
    for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1][0]:
            out[-1] = [max(out[-1][0], x["end"]), out[-1][1], max(out[-1][2], x["high"])]
        else:
            out.append([x["end"], x["low"], x["high"]])
    return [(low, high) for _, low, high in out]


SPANS = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "end", "low", "high")]))


def _add_spans(phrases, at: int):
    """Adds the spans of these phrases to the last column but one; the last one says whether a row is still searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, old, live = batch.columns
            texts = pa.array([t if x else None for t, x in zip(columns[at].to_pylist(), live.to_pylist(), strict=True)], pa.string())
            spans = old.to_pylist()
            for low, _, _, hits in _shards(texts, phrases.value):
                for i, (in_row, in_bytes, _) in hits.items():
                    spans[low + i] = spans[low + i] + [dict(zip(("start", "end", "low", "high"), map(int, (*w, *b)), strict=True)) for w, b in zip(in_row, in_bytes, strict=True)]
            yield pa.record_batch([*columns, pa.array(spans, SPANS), live], batch.schema.names)

    return run


def _cut_spans(at: int):
    """Texts without their spans; a row is searched again if it had any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, spans, _ = batch.columns
            found = spans.to_pylist()
            texts = [cut(t, join_spans(x)) if x else t for t, x in zip(columns[at].to_pylist(), found, strict=True)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.record_batch([*columns, pa.array([[]] * len(texts), SPANS), pa.array([bool(x) for x in found])], batch.schema.names)

    return run


def _remove_by_blocks(docs: DataFrame, blocks: list, at: int) -> DataFrame:
    """Each round finds the spans of all blocks on the same text and cuts their union, until a round finds nothing."""
    kind = "array<struct<start:bigint,end:bigint,low:bigint,high:bigint>>"
    spans, live = (unused_name(docs.columns, name) for name in ("spans", "live"))
    rows = docs.withColumn(spans, F.expr(f"cast(array() AS {kind})")).withColumn(live, F.lit(True))
    while True:
        schema = rows.schema
        for held in blocks:
            rows = rows.mapInArrow(_add_spans(held, at), schema)
        rows = stage(rows.mapInArrow(_cut_spans(at), schema), "cut")
        if rows.where(F.col(live)).isEmpty():
            return rows.drop(spans, live)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, each without the words inside occurrences of test phrases; other columns stay as they are.

    Null stays null. A document that consists of test phrases only is left with what lies between its words. The
    number of blocks of the benchmark does not change the result.
    """
    at = docs.columns.index(text_column)
    blocks = [docs.sparkSession.sparkContext.broadcast(phrases) for phrases in phrase_blocks(benchmark, block_words)]
    if len(blocks) > 1:
        return _remove_by_blocks(docs, blocks, at)
    held = blocks[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            changed = {low + i for low, _, _, hits in _shards(texts, held.value) for i in hits}
            if changed:
                texts = pa.array([clean_text(texts[i].as_py(), held.value) if i in changed else texts[i].as_py() for i in range(len(texts))], texts.type)
            yield pa.record_batch([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
