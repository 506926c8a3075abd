"""Spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced code point makes them equal.
The vocabulary is dealt out by initial states: groups of words that agree in a
prefix and a suffix, in which only what lies between may differ.  If the shorter
word of a pair has ``m`` code points, the edit lies either behind its first half, so
both words begin with that half, or in it, so both end with the rest; a group that is
still large is halved again in the same way, down to a single free code point.  Every
pair is in exactly one group.

In a group the words' free parts become a minimised acyclic acceptor.  It is composed
with the transducer of one edit and with itself: along equal letters both copies are
in one state; an edit leads to a pair of states, from which both must accept the same
rest.  The walk visits only states with at least two words behind them, and a pair of
states only if both accept a rest of the length needed.
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annolink.llm.common import by_value, stored

by_value(__name__)

RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS, MIN_COUNT = 5, 3
#: A damaged run is one whose hash this number divides.
DAMAGE = 97
#: Words of a group that one acceptor holds; larger groups are halved again.
GROUP_WORDS = 20_000
#: A form is at least this many times as frequent.
RATIO = 2

_PAIRS = "a string, an long, b string, bn long"
_PAIRS_ARROW = pa.schema([("a", pa.string()), ("an", pa.int64()), ("b", pa.string()), ("bn", pa.int64())])


# --------------------------------------------------------------- acceptors

class Acceptor:
    """The minimised acyclic acceptor of sorted distinct words.  State 0 is the rest
    of a word that ends; ``lengths`` has a bit for each length a state accepts."""

    def __init__(self, words: list[str]):
        self.known: dict = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[int] = []
        self.size: list[int] = []           # words behind the state
        self.rests: dict = {}
        path: list[list] = [[False, {}]]    # the last word's states, not minimised yet
        last = ""
        for word in words:
            same = 0
            for x, y in zip(last, word):
                if x != y:
                    break
                same += 1
            self._freeze(path, last, same)
            path += [[False, {}] for _ in word[same:]]
            path[-1][0] = True
            last = word
        self._freeze(path, last, 0)
        self.start = self._state(*path[0])

    def _freeze(self, path: list, word: str, keep: int) -> None:
        while len(path) > keep + 1:
            state = self._state(*path.pop())
            path[-1][1][word[len(path) - 1]] = state

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())        # arcs come in sorted order
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.arcs)
            lengths = int(final)
            for t in arcs.values():
                lengths |= self.lengths[t] << 1
            self.arcs.append(arcs)
            self.final.append(final)
            self.lengths.append(lengths)
            self.size.append(final + sum(self.size[t] for t in arcs.values()))
        return got

    def common(self, s: int, t: int, length: int, but: str = "") -> list[str]:
        """The rests of that length that both states accept, none beginning with ``but``."""
        key = (s, t, length, but)
        got = self.rests.get(key)
        if got is None:
            got = []
            lengths, arcs = self.lengths, self.arcs
            stack = [(s, t, length, None)] if lengths[s] & lengths[t] & (1 << length) else []
            while stack:
                s, t, left, read = stack.pop()
                if not left:
                    letters = []
                    while read:
                        letters.append(read[1])
                        read = read[0]
                    got.append("".join(reversed(letters)))
                    continue
                bit = 1 << left - 1
                theirs = arcs[t]
                for letter, u in arcs[s].items():
                    v = theirs.get(letter)
                    if v is not None and lengths[u] & lengths[v] & bit and (read or letter != but):
                        stack.append((u, v, left - 1, (read, letter)))
            self.rests[key] = got
        return got

    def near(self, length: int, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that are one edit apart and of which the shorter has
        ``length``; with ``at_end`` also those with a letter added behind the shorter."""
        stack = [(self.start, "")]
        while stack:
            state, read = stack.pop()
            left = length - len(read)
            arcs = list(self.arcs[state].items())
            if left > 0:
                for i, (x, s) in enumerate(arcs):                     # a letter replaced
                    if self.lengths[s] & (1 << left - 1):
                        for y, t in arcs[i + 1:]:
                            for rest in self.common(s, t, left - 1):
                                yield read + x + rest, read + y + rest
                stack += [(s, read + x) for x, s in arcs if self.size[s] > 1]
            if left > 0 or (left == 0 and at_end):
                for y, t in arcs:                                     # a letter inserted, at its first place
                    for rest in self.common(state, t, left, y):
                        yield read + rest, read + y + rest


def _composer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group -> the group's pairs."""
    group, words, out = None, {}, []

    def pairs():
        if len(words) > 1:
            m, left, right, shut = group
            made = Acceptor(sorted(words))
            for a, b in made.near(m - len(left) - len(right), not shut):
                out.append((left + a + right, words[a], left + b + right, words[b]))

    def batch():
        cols = zip(*out) if out else [[]] * 4
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PAIRS_ARROW)], schema=_PAIRS_ARROW)
        out.clear()
        return made

    for rows in batches:
        for m, left, right, shut, mid, n in zip(*(rows.column(c).to_pylist() for c in ("m", "left", "right", "shut", "mid", "n"))):
            if (m, left, right, shut) != group:
                pairs()
                group, words = (m, left, right, shut), {}
                if len(out) > 20_000:
                    yield batch()
            words[mid] = n
    pairs()
    yield batch()


# --------------------------------------------------------------- operator

_GROUP = ["m", "left", "right"]


def _halves(rows: DataFrame) -> DataFrame:
    """Each group's two halves: pairs that differ behind the first half of the free part,
    and pairs that differ in it.  In the second a letter behind the shorter word is no
    pair of that group (``shut``), since the first has it."""
    free = F.col("m") - F.length("left") - F.length("right")
    half = F.floor(free / 2).cast("int")
    size = F.length("mid")
    rest = free - half
    front = F.struct(F.concat("left", F.substring("mid", F.lit(1), half)).alias("left"), F.col("right"), F.col("shut"),
                     F.substring("mid", half + 1, size).alias("mid"))
    back = F.struct(F.col("left"), F.concat(F.substring("mid", size - rest + 1, rest), F.col("right")).alias("right"),
                    F.lit(True).alias("shut"), F.substring("mid", F.lit(1), size - rest).alias("mid"))
    return rows.select("m", "n", F.explode(F.array(front, back)).alias("g")).select("m", "n", "g.*")


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """``words(word, n)``, distinct, none null or empty -> ``a, an, b, bn``: each pair
    of words one edit apart, once."""
    size = F.length("word")
    rows = words.where(size > 0).select("n", F.explode(F.array(size, size - 1)).alias("m"), F.lit("").alias("left"),
                                        F.lit("").alias("right"), F.lit(False).alias("shut"), F.col("word").alias("mid")).where("m > 0")
    ready, rows = [], _halves(rows)
    while True:
        large = rows.groupBy(*_GROUP).count().where((F.col("count") > group_words) & (F.col("m") - F.length("left") - F.length("right") > 1))
        large = stored(large.select(*_GROUP), "spelling-groups")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, _GROUP, "left_anti"))
        rows = _halves(rows.join(large, _GROUP, "left_semi"))
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    return every.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_composer, _PAIRS)


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``words(word, n)`` -> ``word, form, root, n, n_near, form_n``.

    The form is the near word of largest n (ties: smallest in code-point order) if that
    is at least ``ratio`` (2 or more) times the word's n; forms are followed to the root.  Words
    are distinct; null and empty ones are left out; no words, no rows."""
    words = stored(words.where("word is not null and word <> ''").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs = near_pairs(words)
    both = F.array(F.struct(F.col("a").alias("word"), (-F.col("bn")).alias("less"), F.col("b").alias("near")),
                   F.struct(F.col("b").alias("word"), (-F.col("an")).alias("less"), F.col("a").alias("near")))
    near = (pairs.select(F.explode(both).alias("p")).select("p.*").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct("less", "near")).alias("best")))
    takes = -F.col("best.less") >= ratio * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, -F.col("best.less")).alias("form_n")), "spelling-forms")
    tops = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:     # each round doubles the steps taken; n grows by the ratio at every step
        on = tops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = stored(tops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")), "spelling-roots")
        tops = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    return found.join(tops, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _lower_az(word: Column) -> Column:
    """A-Z only; the fast way where there is nothing else that has a lower case."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def damaged_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``docs(doc_id, text)`` -> ``word, n``: letter runs, lower-cased; where ``DAMAGE`` divides
    the crc32 of ``doc_id:run``, the run loses its code point number crc32 modulo its length.  A null text
    has no runs; a null doc_id is empty; repeated rows count as often as they occur."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("id", _lower_az(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
