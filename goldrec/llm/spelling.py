"""Spelling variants by permuterm rotations.

A word with a terminator has as many rotations as characters. Two words that differ by one replaced code point have rotations
that agree in all but their last one; a word and the same word without one code point have a rotation of the
shorter that is a rotation of the longer less its last code point. So each rotation is listed twice: whole, and without the code
point it ends with, which is the edited one. Sorting by the listed prefix puts a word's near words into one group, which holds
at most one whole rotation and one row per letter of the alphabet: groups are small however the words are distributed.
A scan of a group gives every member the number of its near words there and the best of them; pairs are never formed.

A pair shows up once: a replacement in the one group of its position, an indel in the group of the first of equal
neighbouring code points, since dropping any of them gives the same word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import join_counted
from goldrec.session import stage

#: Runs of letters, as code points; only A-Z is lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands after the last letter; no letter itself.
END = "$"
#: Words of so many code points and occurrences at least; a form has so many times the occurrences of its variant.
LEAST_LENGTH, LEAST_COUNT, DOMINANCE = 5, 3, 2
#: A run whose hash this divides loses a code point.
NOISE = 97
#: Bytes of a word and a form beside each other, for the check of a broadcast.
ROW_BYTES = 96

SQL = f"""
WITH RECURSIVE steps AS (
  SELECT b, CAST(b AS BIGINT) AS c, 0 AS k FROM range(256) AS t(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') AS run FROM documents
),
runs AS (SELECT run, concat(doc_id, ':', run) AS keyed, count(*) AS n FROM found GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(keyed))),
      lambda i: CAST('0x' || substr(hex(encode(keyed)), CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h
  FROM runs, crc
),
words AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}
),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN most >= {DOMINANCE} * w.n THEN other END AS form, CASE WHEN most >= {DOMINANCE} * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL
"""


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all runs of letters in whole texts, after the noise; words that are too short or too rare are left out.

    Null texts have no runs; a null doc_id is hashed as an empty one. A run is hashed and cut where it stands, then counted in
    the map task, so only distinct words are shuffled.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    plain = F.char_length("run") == F.octet_length("run")
    runs = runs.select("doc", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    length = F.char_length("run").cast("long")
    at = (h % length).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length.cast("int")))
    words = runs.select(F.when(h % NOISE == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, whole, first): each rotation whole and without its last code point, if that is a letter.

    ``first`` marks a dropped code point that differs from the one before it in the word.
    """

    def turned(i: Column, left_out: int = 0) -> Column:
        """The word from its code point i on, less some code points there, the terminator, and the word before i."""
        return F.concat(F.substring("word", i + 1 + left_out, length), F.lit(END), F.substring("word", F.lit(1), i))

    length = F.char_length("word")
    whole = F.transform(
        F.sequence(F.lit(0), length),
        lambda i: F.struct(turned(i).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first")),
    )
    edited = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.struct(
            turned(i, 1).alias("prefix"),
            F.lit(False).alias("whole"),
            ((i == 0) | (F.substring("word", i + 1, F.lit(1)) != F.substring("word", i, F.lit(1)))).alias("first"),
        ),
    )
    return words.select("word", "n", F.inline(F.concat(whole, edited)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best struct<n, word>) of the words with near words: how many, and the one with the largest n.

    ``words`` is (word, n), each word once. Equal n go to the smallest word in code-point order.
    """
    group = Window.partitionBy("prefix")
    ranked = Window.partitionBy("prefix").orderBy("whole", F.desc("n"), "word")
    everywhere = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("less"), "word")
    edited, whole, first = ~F.col("whole"), F.col("whole"), F.col("first")
    seen = rotations(words).select(
        "word", "n", "whole", "first",
        F.count_if(edited).over(group).alias("edits"),
        F.min(F.when(edited, me)).over(group).alias("top"),
        F.nth_value(F.when(edited, me), 2).over(everywhere).alias("second"),
        F.count_if(first).over(group).alias("longer"),
        F.min(F.when(first, me)).over(group).alias("top_longer"),
        F.min(F.when(whole, me)).over(group).alias("shorter"),
    )
    replaced = F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top"))
    dropped = F.when(first, F.col("shorter"))
    found = seen.select(
        "word",
        F.when(whole, F.col("longer")).otherwise(F.col("edits") - 1 + dropped.isNotNull().cast("long")).alias("n_near"),
        F.when(whole, F.col("top_longer")).otherwise(F.least(replaced, dropped)).alias("best"),
    )
    found = found.where("n_near > 0").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of the chain of forms. A form is never a variant of its variants.

    Each step replaces a word's place in the chain by that place's own, so a chain of length m takes log m steps; as n at
    least doubles from link to link, m is below 64.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = join_counted(at, onward, "root", "left", ROW_BYTES)
        moved = stage(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("_moved")), "roots")
        if moved.where("_moved").isEmpty():
            return at
        at = moved.drop("_moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at least twice its own, else null;
    its root is the end of its chain of forms, itself without one. Takes (doc_id, text); other columns are ignored. Null and empty texts
    have no words, repeated rows count each, a null doc_id is hashed as an empty one, an empty table gives an empty table. A text
    is split in one task, so the longest one needs memory for its words. Nothing is capped: a prefix group
    is bounded by the alphabet.
    """
    words = stage(word_counts(docs), "words")
    near = near_words(words)
    known = stage(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("best.n") >= DOMINANCE * F.col("n"), F.col("best")).alias("best"),
        ),
        "near",
    )
    chains = roots(known.where("best IS NOT NULL").select("word", F.col("best.word").alias("form")))
    out = join_counted(known, chains, "word", "left", ROW_BYTES)
    return out.select(
        "word", F.col("best.word").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("best.n").alias("form_n")
    )
