"""Spelling variant grouping (operator 11) by a relational trie frontier.

The dictionary (words with their counts over all documents) is a trie in a distributed edge table
(node, label, child), one trie for each word length, of the words and of the reversed words. States
(word, node, rest of the word) walk it by equi-joins with the edges, level by level:

* A word's own path is in the trie, so its states without an edit are the rows of its path.
* An edit turns them into one-edit states. ``replace``: the step goes along another edge of the node, one
  with a lesser label, as the neighbour would find the same pair with the greater one. ``delete``: a
  code point is skipped, in the trie of the words that are shorter by one; of equal code points side by
  side only the last. Insertions are deletions seen from the other word.
* The half of a word that has the edit is walked last: edits in the second half go through the trie
  of words, those in the first half through the trie of reversed words. So the half without the edit
  is one node, no state exists near the roots, and each pair of near words comes up exactly once.
* Every level takes the states that have ``r`` code points left along the edges that have ``r`` left
  to their end: each edge is read at one level. States without a rest are at a terminal, their neighbour.
* Words that have more than ``LEVELS`` code points left get there by one compressed edge: as node
  numbers are polynomial hashes of their prefixes, the node is known without the levels between.

Equal prefixes have equal numbers, so no pair is lost; pairs of different words that meet by a hash are
sorted out by the edit distance of the two words. Nothing is compared but words on a common path;
a node has at most as many edges as there are letters.

Defined results: a null text has no words, a null id counts as an empty text in the rule for
deletions, repeated rows count as often as they are there, other columns are not read, and an empty
table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import LOWER, text_column
from binscope.session import cut_lineage

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form is so many times as frequent as its variant.
FORM_RATIO = 5
#: Levels that are walked one by one: all of words of up to twice as many code points.
LEVELS = 24
#: Levels between two written tables.
CUT_EVERY = 6
#: Distinct words that a task holds before it hands its counts on.
FLUSH = 200_000

_PRIME = (1 << 61) - 1
_BASE = 0x0B5F3A9D7C1E4F27 % _PRIME


def drop_one(key: str) -> Callable[[str], str]:
    """The rule of the query: of every 199th (document, run) one code point is deleted."""
    start = zlib.crc32(f"{key}:".encode())

    def change(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % 199:
            return run
        k = h % len(run)
        return run[:k] + run[k + 1:]
    return change


def _tally(least: int, change: Callable[[str], Callable[[str], str]] | None):
    """Word counts of the texts of a task: (word, n), a word once for each ``FLUSH`` distinct ones."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for batch in batches:
            texts = text_column(batch.column(1))
            for i, key in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py().encode().translate(LOWER).decode()
                words = Counter(runs(text))
                if change is None:
                    for w, n in words.items():
                        found[w] = found.get(w, 0) + n
                else:
                    rule = change(key or "")
                    for w, n in words.items():
                        w = rule(w)
                        if len(w) >= least:
                            found[w] = found.get(w, 0) + n
                if len(found) > FLUSH:
                    yield _counts(found)
                    found = {}
        yield _counts(found)
    return run


def _counts(found: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                change: Callable[[str], Callable[[str], str]] | None = None) -> DataFrame:
    """(word, n) of all words of ``least_length`` code points and ``least_count`` occurrences; ``change``
    gives, for a document's id, a function that rewrites its runs of letters."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`").cast("string"))
    parts = rows.mapInArrow(_tally(least_length, change), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _walk(word: str, start: int) -> list[int]:
    """Numbers of the nodes of a word's path, from the root (``start``) on."""
    out, h = [start], start
    for ch in word:
        h = (h * _BASE + ord(ch) + 1) % _PRIME
        out.append(h)
    return out


_PATH = ("wid long, rest int, node long, label string, child long, ahead string, far_end long, power long, cut long")


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second half of every word's path, and that of the reversed word: one row for each step.

    ``rest``: code points behind the label; ``ahead``: the last ``LEVELS`` of them. Where there are more,
    ``far_end`` is the path's node in front of ``ahead`` and ``power`` what a difference of nodes grows by up
    to there. ``cut``: the node in front of ``ahead`` without the label, in the trie of the shorter words,
    null where another deletion gives the same word.
    """
    names = [f.split(" ")[0] for f in _PATH.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        for wid, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n = len(word)
            for back in (False, True):
                w = word[::-1] if back else word
                path = _walk(w, 4 * n + 2 * back + 1)
                short = _walk(w, 4 * (n - 1) + 2 * back + 1)
                powers, top = [1], max(0, n - LEVELS)
                for _ in range(top - n // 2):
                    powers.append(powers[-1] * _BASE % _PRIME)
                if n == 1 and back:  # its edit is in the other trie, but words of two code points end here
                    rows.append((wid, 0, path[0], "", path[1], "", None, None, None))
                for d in range(n - n // 2 if back else n // 2, n):
                    rest = n - 1 - d
                    far = rest > LEVELS
                    ahead = w[top:] if far else w[d + 1:]
                    same = d > 0 and w[d - 1] == w[d] if back else d + 1 < n and w[d + 1] == w[d]
                    cut = None
                    if not same:
                        cut = (short[top] + (short[d] - short[d + 1]) * powers[top - d - 1]) % _PRIME if far else short[d]
                    rows.append((wid, rest, path[d], w[d], path[d + 1], ahead, path[top] if far else None, powers[top - d - 1] if far else None, cut))
                    if len(rows) == 20_000:
                        yield _batch(rows, names)
                        rows = []
        yield _batch(rows, names)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [_KINDS[f.split(" ")[1]] for f in _PATH.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all pairs of ``words`` (word, n; distinct) that are one edit apart, each
    pair in both orders."""
    words = cut_lineage(words.select("word", "n", F.monotonically_increasing_id().alias("wid")), "words")
    paths = cut_lineage(words.select("wid", "word").mapInArrow(_paths, _PATH), "paths")
    edges = cut_lineage(paths.groupBy("node", "label", "child").agg(F.min("rest").alias("rest")), "edges")

    # one-edit states; decimals hold the product of two node numbers
    other = edges.select("node", F.col("label").alias("instead"), F.col("child").alias("turn"))
    whole, wide = "decimal(38,0)", "decimal(19,0)"
    grown = (F.col("turn") - F.col("child")).cast(wide) * F.col("power").cast(wide) + F.col("far_end").cast(whole)
    landed = F.when(F.col("power").isNull(), F.col("turn")).otherwise(F.pmod(grown, F.lit(_PRIME).cast(whole)).cast("long"))
    replaced = paths.join(other, "node").filter(F.col("instead") < F.col("label")).select("wid", "ahead", landed.alias("node"))
    deleted = paths.filter(F.col("cut").isNotNull()).select("wid", "ahead", F.col("cut").alias("node"))
    states = cut_lineage(replaced.union(deleted).withColumn("left", F.length("ahead")), "states")

    top = states.agg(F.max("left")).first()[0] or 0  # one number, LEVELS at most
    here = states.filter(F.col("left") == top).select("wid", "ahead", "node")
    for left in range(top, 0, -1):
        step = edges.filter(F.col("rest") == left - 1).select("node", "label", "child")
        first = F.substring("ahead", 1, 1)
        here = here.withColumn("label", first).join(step, ["node", "label"]).select(
            "wid", F.expr("substring(ahead, 2)").alias("ahead"), F.col("child").alias("node"))
        here = here.union(states.filter(F.col("left") == left - 1).select("wid", "ahead", "node"))
        if left % CUT_EVERY == 0:
            here = cut_lineage(here, "frontier")
    ends = paths.filter("rest = 0").select(F.col("child").alias("node"), F.col("wid").alias("near_id"))
    pairs = here.select("wid", "node").join(ends, "node").select("wid", "near_id")
    theirs = words.select(F.col("wid").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = pairs.join(words, "wid").join(theirs, "near_id").select("word", "n", "near", "near_n")
    found = cut_lineage(found.filter(F.levenshtein("word", "near", 1) == 1), "near")
    return found.union(found.select("near", "near_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by doubling; counts grow along forms, so there is no circle."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return at


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all ``words`` (word, n; distinct)."""
    words = cut_lineage(words.select("word", "n"), "counted")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best")
    about = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(about, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best.near", (-F.col("best.minus_n")).alias("near_n"))
    has = F.col("near_n") >= ratio * F.col("n")
    placed = cut_lineage(found.select("word", "n", "n_near", F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "placed")
    roots = _roots(placed.filter(F.col("form").isNotNull()))
    return placed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      change: Callable[[str], Callable[[str], str]] | None = None) -> DataFrame:
    """``group_variants`` of the words of ``docs``."""
    return group_variants(count_words(docs, doc_id, text, change=change))
