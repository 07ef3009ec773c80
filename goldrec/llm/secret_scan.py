"""Secrets found by one combined deterministic automaton.

Every rule is a sequence of byte classes with bounds. All rules together become one nondeterministic automaton that
may start anywhere; subset construction and minimisation turn it into a transition array, and one pass over the bytes
of a text finds where any rule completes. Only then an anchored automaton, built the same way, settles the exact spans:
leftmost, longest, not overlapping within a kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from goldrec.llm.common import utf8

UPPER = frozenset(range(65, 91))
DIGIT = frozenset(range(48, 58))
LOWERCASE = frozenset(range(97, 123))
VALUE = UPPER | LOWERCASE | DIGIT | frozenset(b"+/_.=-")
QUOTE = frozenset(b"\"'")
MANY = -1

#: A part is (bytes, least, most); most is MANY for no bound. A pattern is a list of parts.
Part = tuple[frozenset, int, int]


def folded(word: str) -> list[Part]:
    """The letters of a word in either case."""
    return [(frozenset({ord(c.lower()), ord(c.upper())}), 1, 1) for c in word]


def literal(word: str) -> list[Part]:
    return [(frozenset({b}), 1, 1) for b in word.encode()]


def _assign(least: int) -> list[list[Part]]:
    between = [(QUOTE, 0, 1), (frozenset(b" "), 0, MANY), (frozenset(b":="), 1, 1), (frozenset(b" "), 0, MANY), (QUOTE, 0, 1), (VALUE, least, MANY)]
    names = ["password", "passwd", "secret", "token"]
    heads = [*(folded(n) for n in names), [*folded("api"), (frozenset(b"_"), 0, 1), *folded("key")]]
    return [[*h, *between] for h in heads]


@dataclass
class Rule:
    """kind; patterns whose completion calls for a closer look; patterns whose leftmost longest matches are taken, and how long they must be.

    The alerts leave out length bounds where the beginning is rare enough: bounds of several rules multiply the states.
    """

    kind: str
    alert: list[list[Part]]
    exact: list[list[Part]]
    least: int = 0


def rules() -> list[Rule]:
    """The base kinds first, in the order in which equal starts are listed; then those that the method adds."""
    hexadecimal = DIGIT | frozenset(b"abcdef")
    word = UPPER | LOWERCASE | DIGIT
    hosting = [*literal("gh"), (frozenset(b"pousr"), 1, 1), *literal("_")]
    chat = [*literal("xox"), (frozenset(b"abprs"), 1, 1), *literal("-")]
    return [
        Rule("assign", _assign(1), _assign(1), 12),
        Rule("access", [[*literal("AKIA"), (UPPER | DIGIT, 1, 1)]], [[*literal("AKIA"), (UPPER | DIGIT, 1, MANY)]], 18),
        Rule("hex", [[(hexadecimal, 16, MANY)]], [[(hexadecimal, 1, MANY)]], 16),
        Rule("hosting", [hosting], [[*hosting, (word, 36, MANY)]]),
        Rule("chat", [chat], [[*chat, (word | frozenset(b"-"), 10, MANY)]]),
    ]


BASE_KINDS = ("assign", "access", "hex")


class Automaton:
    """Minimal deterministic automaton of patterns, as transition arrays.

    ``table[state][byte]`` is the next state, ``accepts[state]`` the set of pattern owners that complete there.
    State 0 is the start. An anchored automaton has a dead state, a searching one may start at every byte.
    """

    def __init__(self, patterns: list[tuple[int, list[Part]]], searching: bool):
        # positions of the nondeterministic automaton: (pattern, part, times)
        steps: dict[tuple, list[tuple[frozenset, tuple]]] = {}

        def close(p: int, part: int, times: int) -> set[tuple]:
            """The position and all that need no byte to reach."""
            out, todo = set(), [(p, part, times)]
            while todo:
                q = todo.pop()
                if q in out:
                    continue
                out.add(q)
                _, i, n = q
                parts = patterns[p][1]
                if i < len(parts) and n >= parts[i][1]:
                    todo.append((p, i + 1, 0))
            return out

        def moves(q: tuple) -> list[tuple[frozenset, tuple]]:
            if q not in steps:
                p, i, n = q
                parts = patterns[p][1]
                steps[q] = []
                if i < len(parts):
                    symbols, least, most = parts[i]
                    if most == MANY:
                        steps[q] = [(symbols, (p, i, min(n + 1, least)))]
                    elif n < most:
                        steps[q] = [(symbols, (p, i, n + 1))]
            return steps[q]

        symbols = {part[0] for _, parts in patterns for part in parts}
        classes: dict[tuple, list[int]] = {}
        for b in range(256):
            classes.setdefault(tuple(b in s for s in symbols), []).append(b)
        members = list(classes.values())
        begin = frozenset(q for p in range(len(patterns)) for q in close(p, 0, 0))
        number, order, rows, accepts = {begin: 0}, [begin], [], []
        for state in order:
            accepts.append(frozenset(patterns[p][0] for p, i, _ in state if i == len(patterns[p][1])))
            row = []
            for bytes_of in members:
                byte = bytes_of[0]
                after = {r for q in state for s, t in moves(q) if byte in s for r in close(*t)}
                after = frozenset(after | begin) if searching else frozenset(after)
                if after not in number:
                    number[after] = len(order)
                    order.append(after)
                row.append(number[after])
            rows.append(row)
        table, accepts = self._minimise(np.array(rows), accepts)
        wide = np.zeros((len(table), 256), np.int64)
        for k, bytes_of in enumerate(members):
            wide[:, bytes_of] = table[:, [k]]
        self.table, self.accepts = wide, accepts
        self.dead = next((s for s in range(len(wide)) if (wide[s] == s).all() and not accepts[s]), -1)

    @staticmethod
    def _minimise(table: np.ndarray, accepts: list[frozenset]) -> tuple[np.ndarray, list[frozenset]]:
        """Merge states that no continuation tells apart, by refining blocks until they are stable."""
        kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
        block = np.array([kinds[a] for a in accepts])
        while True:
            keys = np.column_stack((block, block[table]))
            _, first, fresh = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            if len(first) == block.max() + 1:
                break
            block = fresh.ravel()
        # the start comes first
        names = np.full(block.max() + 1, -1)
        seen = list(dict.fromkeys(block.tolist()))
        names[seen] = np.arange(len(seen))
        where = [int(np.flatnonzero(block == b)[0]) for b in seen]
        return names[block[table[where]]], [accepts[i] for i in where]

    def longest(self, raw: bytes, start: int) -> int:
        """End of the longest match that begins at start, or -1."""
        state, end, table = 0, -1, self.table
        for i in range(start, len(raw)):
            state = table[state, raw[i]]
            if state == self.dead:
                break
            if self.accepts[state]:
                end = i + 1
        return end


class Scanner:
    """The combined automaton of a rule list and one anchored automaton per kind."""

    #: Bytes a lane covers; the lanes of a block of texts step together.
    LANE = 2048

    def __init__(self, rule_list: list[Rule] | None = None):
        self.rules = rule_list if rule_list is not None else rules()
        self.search = Automaton([(i, p) for i, r in enumerate(self.rules) for p in r.alert], True)
        self.exact = [Automaton([(0, p) for p in r.exact], False) for r in self.rules]
        hit = np.array([bool(a) for a in self.search.accepts])
        # accepting states come last, so that one comparison tells them
        order = np.argsort(hit, kind="stable")
        place = np.argsort(order)
        self.accepts = [self.search.accepts[i] for i in order]
        self.begin = int(place[0])
        self.first_hit = int(len(hit) - hit.sum())
        self.table = place[self.search.table[order]].astype(np.int32)

    def alerts(self, data: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
        """{row: kinds} where a pattern completes, in one pass over the bytes of all rows.

        Texts are cut into lanes that step together. A lane begins in the start state; if the lane before it in the
        same text ends elsewhere, it runs again from there until both runs meet.
        """
        size = np.diff(off)
        lanes = -(-size // self.LANE)
        row = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = off[row] + nth * self.LANE
        length = np.minimum(self.LANE, off[row + 1] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        flat = self.table.ravel()
        state = np.full(len(order), self.begin, np.int32)
        found: set[tuple[int, int]] = set()
        for i in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -i, "left"))
            now = flat[state[:live] * np.int32(256) + data[begin[:live] + i]]
            state[:live] = now
            if now.max() >= self.first_hit:
                for k in np.flatnonzero(now >= self.first_hit):
                    found.update((int(row[order[k]]), kind) for kind in self.accepts[now[k]])
        ends = np.empty(len(order), np.int32)
        ends[order] = state
        for lane in np.flatnonzero(nth > 0):  # one after another: an entry state may change the next one
            entry = int(ends[lane - 1])
            if entry == self.begin:
                continue
            at, stop = int(off[row[lane]] + nth[lane] * self.LANE), int(min(off[row[lane] + 1], off[row[lane]] + (nth[lane] + 1) * self.LANE))
            a, b = entry, self.begin
            for byte in data[at:stop].tolist():
                a, b = int(flat[a * 256 + byte]), int(flat[b * 256 + byte])
                if a == b:
                    break
                if a >= self.first_hit:
                    found.update((int(row[lane]), kind) for kind in self.accepts[a])
            else:
                ends[lane] = a
        out: dict[int, set[int]] = {}
        for r, kind in found:
            out.setdefault(r, set()).add(kind)
        return out

    def spans(self, raw: bytes, kinds: set[int]) -> list[tuple[int, int, int]]:
        """(start, kind, end) in bytes of the matches that count, by start, then kind."""
        out = []
        for kind in sorted(kinds):
            auto, rule, at = self.exact[kind], self.rules[kind], 0
            begins = auto.table[0] != auto.dead
            starts = np.flatnonzero(begins[np.frombuffer(raw, np.uint8)])
            for s in starts.tolist():
                if s < at:
                    continue
                end = auto.longest(raw, s)
                if end >= 0:
                    at = end
                    if self._counts(rule, raw[s:end]):
                        out.append((s, kind, end))
        return sorted(out)

    @staticmethod
    def _counts(rule: Rule, match: bytes) -> bool:
        if rule.kind != "assign":
            return len(match) >= rule.least
        # the value follows the first separator and its quote
        cut = min(i for i, b in enumerate(match) if b in b":=")
        return len(match[cut + 1 :].lstrip(b" ").lstrip(b"\"'")) >= rule.least

    def find(self, texts: pa.Array, block: int = 4 << 20) -> list[list[tuple[int, int, int]]]:
        """Spans of each text in code points, end exclusive; null and empty texts have none."""
        data, off = utf8(texts)
        out: list[list[tuple[int, int, int]]] = []
        low = 0
        while low < len(off) - 1:
            high = max(low + 1, int(np.searchsorted(off, off[low] + block, "right")) - 1)
            own = self.alerts(data[off[low] : off[high]], off[low : high + 1] - off[low])
            for i in range(low, high):
                if i - low not in own:
                    out.append([])
                    continue
                raw = data[off[i] : off[i + 1]]
                points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                out.append([(int(points[s]), k, int(points[e])) for s, k, e in self.spans(raw.tobytes(), own[i - low])])
            low = high
        return out


def _listed(scanner: Scanner, spans: list[tuple[int, int, int]], kinds) -> str:
    return ",".join(f"{scanner.rules[k].kind}:{s}:{e}" for s, k, e in spans if kinds is None or scanner.rules[k].kind in kinds)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each row of (doc_id, text).

    The base spans are those of the first three kinds; ``spans`` has the added kinds too. Null and empty texts have no
    spans, and the hash of an empty list is that of an empty text.
    """
    held = docs.sparkSession.sparkContext.broadcast(Scanner())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = held.value
        names = [r.kind for r in scanner.rules]
        for batch in batches:
            found = scanner.find(batch.column(1))
            counts = [pa.array([sum(names[k] == kind for _, k, _ in f) for f in found], pa.int64()) for kind in BASE_KINDS]
            base = pa.array([hashlib.sha256(_listed(scanner, f, BASE_KINDS).encode()).hexdigest() for f in found], pa.string())
            spans = pa.array([_listed(scanner, f, None) for f in found], pa.string())
            yield pa.record_batch([batch.column(0), *counts, base, spans], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[REDACTED]") -> str:
    """The text with each union of overlapping spans replaced by the mark."""
    out, at, open_from = [], 0, 0
    for s, _, e in spans:
        if s >= at or not out and at == 0:
            out += [text[open_from:s], mark]
        at = max(at, e)
        open_from = at
    return "".join([*out, text[open_from:]])


def redact_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with every secret replaced by a mark; null stays null and other columns stay as they are."""
    at = docs.columns.index(text_column)
    held = docs.sparkSession.sparkContext.broadcast(Scanner())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            found = held.value.find(texts)
            if any(found):
                texts = pa.array([redact(t.as_py(), f) if f else t.as_py() for t, f in zip(texts, found, strict=True)], texts.type)
            yield pa.record_batch([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
