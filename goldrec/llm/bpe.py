"""Byte-level BPE as a finite-state transducer, built while it is used.

A sequence of tokens is the BPE encoding of its bytes exactly when each token encodes to itself and each neighbouring pair
does. Hence every prefix of a text has one last token, and the encoding of the prefix without it is the rest. Reading a
byte finds the last token of the longer prefix; a prefix stays open while its rest still begins some token, and what
the encodings of all open prefixes share cannot change any more, so it is emitted. The state is the token before the open
bytes, the open bytes, and their last tokens: a bounded lookahead. States and transitions are made on first use
(lazy determinisation) and thrown away together when there are too many. Plain merging is applied to
single tokens only, to learn how they form.

Decoding is a byte table followed by an incremental UTF-8 automaton, so ids can arrive in any portions.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from goldrec.llm.common import GIVE_BACK_BYTES, give_back, worker_tools

RANKS = "byte_bpe_50k.tiktoken"
#: Entries that a table of the transducer, and the dictionary of known pieces, may hold before they start afresh.
TABLE_LIMIT, PIECE_LIMIT = 250_000, 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def split_pattern(text: str = public_tokenizers.PATTERN) -> regex.Pattern:
    """The splitting pattern with white space as Unicode defines it, control separators left out."""
    space = text.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(space)


class Transducer:
    """Bytes of one piece in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], limit: int = TABLE_LIMIT, spread: int = 400):
        self.ranks, self.limit, self.spread = ranks, limit, spread
        self.longest = max(map(len, ranks))
        #: All tokens in order, and bytes -> where the longer tokens that begin with them lie.
        self.ordered = sorted(ranks)
        self.begins: dict[bytes, range] = {}
        for at, t in enumerate(self.ordered):
            for i in range(1, len(t)):
                known = self.begins.get(t[:i])
                self.begins[t[:i]] = range(at if known is None else known.start, at + 1)
        self.barred: dict[tuple, frozenset] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self._fresh()

    def _fresh(self) -> None:
        start = (None, b"", (0,))
        self.states, self.numbers = [start], {start: 0}
        self.moves: dict[int, int | tuple[int, tuple]] = {}
        self.ends: dict[int, tuple] = {}

    def merged(self, raw: bytes, before: int = 1 << 60) -> list[bytes]:
        """Plain merging of a token's bytes by ranks below ``before``: the lowest first, the leftmost of equals."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and rank < before and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The parts of a token that touch its right or left end, from the whole inwards, each with the rank it formed at.

        Empty for an entry of the vocabulary that merging never forms.
        """
        known = self.edges[right].get(token)
        if known is None:
            if self.merged(token) != [token]:
                known = []
            else:
                known, part = [(token, self.ranks[token] if len(token) > 1 else -1)], token
                while len(part) > 1:
                    a, b = self.halves(part)
                    part = b if right else a
                    known.append((part, self.ranks[part] if len(part) > 1 else -1))
            self.edges[right][token] = known
        return known

    def halves(self, token: bytes) -> list[bytes]:
        """The two parts whose merge completes a token."""
        rank = self.ranks[token]
        return self.merged(token, rank)

    def joins(self, left: bytes | None, right: bytes) -> bool:
        """Whether right can follow left in an encoding.

        The parts next to the border are followed back in time, the one formed last being undone first. The pair is
        split by the merges only if none of the neighbours met on the way would have merged before one of them grew.
        """
        if left is None:
            return bool(self.edge(right, False))
        a, b = self.edge(left, True), self.edge(right, False)
        if not a or not b:
            return False
        ranks, i, j = self.ranks, 0, 0
        grows_left = grows_right = 1 << 60
        while True:
            (x, rank_x), (y, rank_y) = a[i], b[j]
            rank = ranks.get(x + y)
            # of equal ranks the merge further left comes first
            if rank is not None and rank < grows_left and rank <= grows_right:
                return False
            if rank_x < 0 and rank_y < 0:
                return True
            if rank_x > rank_y:
                grows_left = rank_x
                i += 1
            else:
                grows_right = rank_y
                j += 1

    def _context(self, before: bytes | None, held: bytes):
        """What the token before still decides: which tokens that begin with the open bytes cannot follow it.

        While many tokens begin so, the token itself is the answer.
        """
        longer = self.begins.get(held, ())
        if before is None or len(longer) > self.spread:
            return before
        key = (before, held)
        found = self.barred.get(key)
        if found is None:
            if len(self.barred) > self.limit:
                self.barred.clear()
            found = self.barred[key] = frozenset(t for t in map(self.ordered.__getitem__, longer) if not self.joins(before, t))
        return found

    def _move(self, state: int, byte: int) -> int | tuple[int, tuple]:
        """The next state, with the ids emitted on the way if there are any."""
        before, held, last = self.states[state]
        held = held + bytes([byte])
        n = len(held)
        ranks, begins = self.ranks, self.begins
        for start in range(max(0, n - self.longest), n):
            token = held[start:]
            if token in ranks:
                if start:
                    size = last[start]
                    if size and self.joins(held[start - size : start], token):
                        break
                elif token not in before if type(before) is frozenset else self.joins(before, token):
                    break
        else:
            raise ValueError("the vocabulary lacks a byte")
        last = [*last, n - start]
        # ends of encodings that a later token can build on; their ways back to the committed place
        ways = []
        for p in range(max(0, n - self.longest + 1), n + 1):
            if p == n or ((p == 0 or last[p]) and held[p:] in begins):
                way = [p]
                while p:
                    p -= last[p]
                    way.append(p)
                ways.append(way)
        shared = set(ways[0])
        for way in ways:
            shared.intersection_update(way)
        shared.discard(n)  # the last token stays open, so that the token before it tells enough
        done = max(shared) if shared else 0
        ids = ()
        if done:
            out, at = [], done
            while at:
                size = last[at]
                out.append(ranks[held[at - size : at]])
                at -= size
            ids = tuple(out[::-1])
            before, held = self._context(held[done - last[done] : done], held[done:]), held[done:]
        elif type(before) is bytes:
            before = self._context(before, held)
        elif before:
            before = frozenset(t for t in before if len(t) > n and t.startswith(held))
        used = {p for way in ways for p in way}
        after = (before, held, tuple([0, *(last[p] if p in used else 0 for p in range(done + 1, n + 1))]))
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        return (number, ids) if ids else number

    def _end(self, state: int) -> tuple:
        _, held, last = self.states[state]
        out, at = [], len(held)
        while at:
            out.append(self.ranks[held[at - last[at] : at]])
            at -= last[at]
        return tuple(out[::-1])

    def encode(self, piece: bytes) -> tuple:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.moves) > self.limit:
            self._fresh()
        state, out, moves = 0, [], self.moves
        for byte in piece:
            key = state << 8 | byte
            step = moves.get(key)
            if step is None:
                step = moves[key] = self._move(state, byte)
            if type(step) is int:
                state = step
            else:
                state, ids = step
                out.extend(ids)
        if state not in self.ends:
            self.ends[state] = self._end(state)
        return (*out, *self.ends[state])


class Encoder(dict):
    """Texts to ids. The dictionary remembers pieces of bounded length and number."""

    def __init__(self, ranks: dict[bytes, int], limit: int = TABLE_LIMIT, pieces: int = PIECE_LIMIT):
        self.transducer, self.limit = Transducer(ranks, limit), min(limit, pieces)
        self.pattern = split_pattern()

    def __missing__(self, piece: str) -> tuple:
        ids = self.transducer.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> array:
        if len(text) <= 1 << 20:
            pieces: Iterable[str] = self.pattern.findall(text)
        else:
            pieces = (m.group() for m in self.pattern.finditer(text))
        return array("I", chain.from_iterable(map(self.__getitem__, pieces)))


class Utf8Machine:
    """Incremental UTF-8: complete characters out, the beginning of one kept for the next portion."""

    #: Byte -> continuation bytes that a character beginning with it needs; -1 for none that begins one.
    NEEDS = [0] * 0x80 + [-1] * 0x42 + [1] * 0x1E + [2] * 0x10 + [3] * 5 + [-1] * 11

    def __init__(self):
        self.held = b""

    def feed(self, raw: bytes) -> str:
        raw = self.held + raw
        cut = len(raw)
        for back in range(1, min(3, len(raw)) + 1):
            needs = self.NEEDS[raw[-back]]
            if needs >= 0:
                if needs >= back:
                    cut -= back
                break
        self.held = raw[cut:]
        return raw[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    """Ids to text in any portions."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: t for t, i in ranks.items()}

    def stream(self, portions: Iterable[Iterable[int]]) -> Iterator[str]:
        machine = Utf8Machine()
        for ids in portions:
            yield machine.feed(b"".join(map(self.tokens.__getitem__, ids)))
        yield machine.close()


def _tools(ranks) -> tuple[Encoder, Decoder]:
    """One encoder and decoder per worker and rank table, so that their tables stay warm between tasks."""
    return worker_tools(f"bpe {ranks.id}", lambda: (Encoder(ranks.value), Decoder(ranks.value)))


class _Held:
    """A broadcast rank table with a name that is the same in every task."""

    def __init__(self, spark, path: str):
        self.id, self.table = path, spark.sparkContext.broadcast(load_ranks(path))

    @property
    def value(self) -> dict[bytes, int]:
        return self.table.value


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<long>) of each row; null and empty texts have no ids."""
    held = _Held(docs.sparkSession, path or public_tokenizers.path(RANKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _tools(held)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = [encoder.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<bigint>")


def decode_documents(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give an empty text."""
    held = _Held(tokens.sparkSession, path or public_tokenizers.path(RANKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(held)
        for batch in batches:
            texts = ["".join(decoder.stream([ids.as_py() or ()])) for ids in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(tokens.dtypes)['doc_id']}, text string")


def token_digests(docs: DataFrame, path: str | None = None, portion: int = 1 << 16) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, hashed, decoded in portions and hashed again.

    Null and empty texts have no tokens and the hashes of nothing. Rows are independent; other columns are ignored.
    """
    held = _Held(docs.sparkSession, path or public_tokenizers.path(RANKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(held)
        for batch in batches:
            sizes, ids_hash, text_hash = [], [], []
            for text in batch.column(1):
                ids = encoder.encode(text.as_py() or "")
                sizes.append(len(ids))
                if ids.itemsize != 4:
                    raise ValueError("ids must take four bytes")
                ids_hash.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back = hashlib.sha256()
                for s in decoder.stream(ids[i : i + portion] for i in range(0, len(ids), portion)):
                    back.update(s.encode())
                text_hash.append(back.hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            if batch.nbytes >= GIVE_BACK_BYTES:
                give_back()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
