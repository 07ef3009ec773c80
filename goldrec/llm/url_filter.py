"""URL rules as one bit-parallel wildcard automaton (Shift-And over packed globs).

Every rule becomes two globs over host + path, ``host/path**`` and ``*.host/path**``. The symbols of all globs lie
side by side in 64-bit words; bit i of the state says that the text read so far ends a match of the glob's first i
symbols. One step for one character is a shift, an AND with the character's mask and, for wildcards, an OR of the
bits that may stay. All URLs of a batch take the step together. ``*`` stays inside the host, ``**`` goes anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import utf8

#: (verdict, host, path): fixed values of the contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT = "allow"
ANY_HOST, ANY = object(), object()


@dataclass
class Automaton:
    masks: np.ndarray  #: 256 x words: symbols that the byte matches
    stay: np.ndarray  #: 256 x words: wildcards that the byte may repeat
    start: np.ndarray  #: words: first symbols
    skip: np.ndarray  #: words: wildcards, which match nothing as well
    finals: list[list[int]]  #: rule -> last bits of its globs
    words: int


def compile_rules(rules: list[tuple[str, str, str]]) -> Automaton:
    """Pack the globs of all rules."""
    globs = []
    for i, (_, host, path) in enumerate(rules):
        tail = [*(host + path).encode(), ANY]
        globs += [(i, tail), (i, [ANY_HOST, ord("."), *tail])]
    n = sum(len(g) for _, g in globs)
    words = (n + 63) // 64
    masks, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    start, skip = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    finals: list[list[int]] = [[] for _ in rules]
    at = 0
    for i, glob in globs:
        start[at // 64] |= np.uint64(1 << at % 64)
        for symbol in glob:
            word, bit = at // 64, np.uint64(1 << at % 64)
            if symbol is ANY or symbol is ANY_HOST:
                rows = np.array([b for b in range(256) if symbol is ANY or b != ord("/")])
                masks[rows, word] |= bit
                stay[rows, word] |= bit
                skip[word] |= bit
            else:
                masks[symbol, word] |= bit
            at += 1
        finals[i].append(at - 1)
    return Automaton(masks, stay, start, skip, finals, words)


def _shift(d: np.ndarray) -> np.ndarray:
    """All bits one place up, across words."""
    out = d << np.uint64(1)
    out[:, 1:] |= d[:, :-1] >> np.uint64(63)
    return out


def match_rules(auto: Automaton, column: pa.Array, block: int = 8192) -> np.ndarray:
    """Boolean table texts x rules."""
    data, off = utf8(column)
    size = np.diff(off)
    found = np.zeros((len(size), len(auto.finals)), bool)
    order = np.argsort(-size, kind="stable")
    # bit i of a state is set when symbols 0..i are matched; a leading wildcard may match nothing
    inject = auto.start | _shift((auto.start & auto.skip)[None])[0]
    # no carry from the end of a glob into the next one
    inner = ~auto.start
    for low in range(0, len(order), block):
        rows = order[low : low + block]
        length = size[rows]
        state = np.zeros((len(rows), auto.words), np.uint64)
        for i in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -i, "left"))
            byte = data[off[rows[:live]] + i]
            d = state[:live]
            before = _shift(d) & inner
            if i == 0:
                before |= inject
            d = (before & auto.masks[byte]) | (d & auto.stay[byte])
            # what precedes a wildcard already matches with it
            state[:live] = d | (_shift(d) & auto.skip & inner)
        for rule, bits in enumerate(auto.finals):
            for bit in bits:
                found[rows, rule] |= (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
    return found


def canonical_url(pages: DataFrame) -> DataFrame:
    """page_id, host and path; null and texts without '://' give empty ones."""
    rest = F.expr("substring(url, locate('://', url) + 3)")
    has = F.col("url").contains("://")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", F.when(has, lower).otherwise("").alias("host"), F.when(has, path).otherwise("").alias("path"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest rule that fits decides, else ``default``.

    Rules of equal length that fit together are taken in the given order. Null, empty and malformed URLs have an
    empty host and path and get the default. Rows are independent: repeats give repeated rows.
    """
    auto = compile_rules(rules)
    names = [host + path for _, host, path in rules]
    order = np.array(sorted(range(len(rules)), key=lambda i: -len(names[i])), int)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = pa.array([*names, None], pa.string())
        verdicts = pa.array([*(v for v, _, _ in rules), default], pa.string())
        for batch in batches:
            found = match_rules(auto, batch.column(3))[:, order]
            best = pa.array(np.where(found.any(1), order[found.argmax(1)] if len(order) else 0, len(rules)))
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), labels.take(best), verdicts.take(best)], ["page_id", "host", "path", "rule", "verdict"])

    urls = canonical_url(pages)
    key = dict(urls.dtypes)["page_id"]
    return urls.select("*", F.concat("host", "path").alias("whole")).mapInArrow(judge, f"page_id {key}, host string, path string, rule string, verdict string")


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM part
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/de/', 'example.org/es/', 'example.org/en/1') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
