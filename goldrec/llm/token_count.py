"""Token counts with a whole-token shortcut.

Most pieces of a text are words that the vocabulary holds whole. Which of its entries really encode alone as one token is
proved once, offline, by merging each of them: only then is a piece equal to the entry counted as one token without any
merge. All other pieces are merged; counts of pieces of bounded length and number are remembered in each worker.

The file is a tokenizer description in JSON: byte-pair merges with an end-of-word mark over byte-level characters, text
composed (NFC) and lower-cased, pieces by a pattern. Anything else in the file is refused rather than counted wrongly.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from goldrec.llm.common import GIVE_BACK_BYTES, give_back, worker_tools

WORDS = "word_bpe_49k.json"
#: Pieces remembered per worker before they start afresh, and the longest piece remembered.
PIECE_LIMIT, PIECE_LENGTH = 400_000, 64
#: Pieces of at most so many bytes are merged in lists, longer ones with a heap. NEVER is the rank of a pair that does not merge.
SHORT, NEVER = 96, 1 << 60
#: Texts above so many characters are split lazily.
LAZY_LENGTH = 1 << 20


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte: itself where it is printable, else the next one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [shown[b] for b in range(256)]


def split_pattern(text: str) -> regex.Pattern:
    """The splitting pattern with white space as Unicode defines it, control separators left out."""
    return regex.compile(text.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))


#: Letters whose lower case depends on their neighbours in Python (sigma) or is missing in its tables.
LOWER = {"Σ": "σ", "\ua7cb": "ɤ", "\ua7dc": "ƛ"}


class WordPieces:
    """Rules of one tokenizer file: special strings, pieces, and merges of a piece."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [(s["type"], s.get("pattern"), s.get("content")) for s in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        expected = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        if (
            steps != expected
            or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or (splits[0]["behavior"], splits[0]["invert"]) != ("Removed", True)
            or (splits[1]["add_prefix_space"], splits[1]["use_regex"]) != (False, False)
            or model["type"] != "BPE"
            or any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback"))
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"not a lower-casing word-piece tokenizer with merges: {path}")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.shown = byte_alphabet()
        for c in self.shown:
            if c not in self.vocabulary or c + self.suffix not in self.vocabulary:
                raise ValueError("the vocabulary lacks a byte")
        self.pattern = split_pattern(splits[0]["pattern"]["Regex"])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None

    def normalise(self, text: str) -> str:
        """Composed and lower-cased letter by letter. White space is left as it is, since no piece holds any."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            for upper, lower in LOWER.items():
                if upper in text:
                    text = text.replace(upper, lower)
        return text.lower()

    def parts(self, text: str) -> tuple[int, list[str]]:
        """(number of special strings, normalised texts between them): special strings count as they stand in the text."""
        if self.special is None or not self.special.search(text):
            return 0, [self.normalise(text)]
        between = self.special.split(text)
        return len(between) - 1, [self.normalise(t) for t in between]

    def pieces(self, text: str) -> Iterator[str] | list[str]:
        return self.pattern.findall(text) if len(text) <= LAZY_LENGTH else (m.group() for m in self.pattern.finditer(text))

    def merged(self, piece: str) -> list[str]:
        """Tokens of one piece: of all neighbours the pair of lowest rank merges first, the leftmost of equals."""
        parts = [self.shown[b] for b in piece.encode()]
        parts[-1] += self.suffix
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _merge_short(self, parts: list[str]) -> list[str]:
        """The rank of each neighbouring pair is kept in a list; after a merge two of them change."""
        ranks = self.ranks
        pairs = [ranks.get(p, NEVER) for p in zip(parts, parts[1:])]
        while pairs:
            rank = min(pairs)
            if rank == NEVER:
                break
            i = pairs.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get((parts[i - 1], parts[i]), NEVER)
            if i < len(pairs):
                pairs[i] = ranks.get((parts[i], parts[i + 1]), NEVER)
        return parts

    def _merge_long(self, parts: list) -> list[str]:
        """Open pairs wait in a heap and the parts are chained, so a piece of n bytes takes n log n steps."""
        n, ranks = len(parts), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue  # one of the two has grown or gone since
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]

    def spelled(self, entry: str) -> str | None:
        """The piece that an entry with the end-of-word mark spells; None for bytes that are no text and for parts of words."""
        if not self.suffix or not entry.endswith(self.suffix):
            return None
        values = {c: b for b, c in enumerate(self.shown)}
        try:
            return bytes(values[c] for c in entry[: -len(self.suffix)]).decode() or None
        except (KeyError, UnicodeDecodeError):
            return None

    def stands_alone(self, entry: str) -> str | None:
        """The piece an entry spells if that piece is proved to encode as this entry and nothing else."""
        piece = self.spelled(entry)
        if piece is None or self.pattern.findall(piece) != [piece] or self.normalise(piece) != piece:
            return None
        return piece if self.merged(piece) == [entry] else None


class Counter(dict):
    """Piece -> number of tokens. Proved pieces are there from the start; others are merged when they come."""

    def __init__(self, rules: WordPieces, whole: list[str], limit: int = PIECE_LIMIT):
        super().__init__(dict.fromkeys(whole, 1))
        self.rules, self.room, self.limit = rules, limit, limit
        self.learnt: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = len(self.rules.merged(piece))
        if len(piece) <= PIECE_LENGTH:
            if len(self.learnt) >= self.limit:
                for known in self.learnt:
                    del self[known]
                self.learnt.clear()
            self[piece] = n
            self.learnt.append(piece)
        return n

    def count(self, text: str) -> int:
        special, parts = self.rules.parts(text)
        return special + sum(sum(map(self.__getitem__, self.rules.pieces(part))) for part in parts)


def whole_pieces(spark: SparkSession, path: str) -> list[str]:
    """Pieces proved to be one token: each entry of the vocabulary is merged in a task. At most one piece per entry."""
    entries = [(e,) for e in WordPieces(path).vocabulary]
    slots = max(1, min(spark.sparkContext.defaultParallelism, len(entries) // 2048))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = WordPieces(path)
        for batch in batches:
            proved = [rules.stands_alone(e) for e in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([p for p in proved if p is not None], pa.string())], ["piece"])

    rows = spark.createDataFrame(entries, "entry string").repartition(slots).mapInArrow(prove, "piece string")
    return sorted(r.piece for r in rows.collect())


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row's whole text.

    n_bytes is the length in UTF-8, over_limit whether there are more than ``limit`` tokens. Null and empty texts have
    no bytes and no tokens. Rows are independent, so repeats and null ids stay as they are; other columns are ignored; an
    empty table gives an empty table. A text above 2^20 characters is split lazily, and a piece of n bytes takes
    n log n steps, so a long text needs memory for a few copies of itself and no more.
    """
    path = path or public_tokenizers.path(WORDS)
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(whole_pieces(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_tools(f"token counts {path}", lambda: Counter(WordPieces(path), whole.value))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                n_bytes.append(len(text) if text.isascii() else len(text.encode()))
                n_tokens.append(counter.count(text))
            over = [n > limit for n in n_tokens]
            yield pa.record_batch(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(over, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )
            if batch.nbytes >= GIVE_BACK_BYTES:
                give_back()

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
