"""Evaluation texts that leak into training text.

A generalised suffix automaton of the normalised test items is built on the driver and broadcast. Its size is bounded by the
words it may hold (``AUTOMATON_WORDS``: about 300 MB); more items are split over several automata, of which one is held and
broadcast at a time, in passes over the documents. Each document's words are streamed through it; the automaton's state and the length of the longest match are tracked word by
word, so a document costs time in proportion to its own length, whatever the number of items.

Defined results
---------------
* Words are runs of letters and digits after NFKD, combining marks dropped, case ignored.
* An item leaks into a document that holds ``least`` (12) consecutive words of it, or the whole item if it is shorter.
* Null texts hold nothing; null or wordless items leak nowhere. Repeated documents give the same pairs once; items with
  the same text all come out. Empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrom import scratch

LEAST_WORDS = 12
#: Words in one automaton; beyond that the items are split over several, each of which reads all documents.
AUTOMATON_WORDS = 500_000


class _Fold(dict):
    """Code point to its folded form; anything but letters and digits becomes a space, combining marks vanish."""

    def __missing__(self, code: int) -> str:
        folded = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", chr(code)).casefold())
        self[code] = s = "".join("" if unicodedata.category(c)[0] == "M" else c if c.isalnum() else " " for c in folded)
        return s


_FOLD = _Fold()


def words_of(text: str | None) -> list[str]:
    """The normalised words of a text."""
    return (text or "").translate(_FOLD).split()


def words_with_spans(text: str) -> list[tuple[str, int, int]]:
    """The normalised words with their place in the raw text."""
    folded: list[str] = []
    origin: list[int] = []
    for i, c in enumerate(text):
        s = _FOLD[ord(c)]
        folded.append(s)
        origin.extend([i] * len(s))
    return [(m.group(), origin[m.start()], origin[m.end() - 1] + 1) for m in re.finditer(r"\S+", "".join(folded))]


@dataclass
class Automaton:
    """Suffix automaton of several word sequences."""

    least: int = LEAST_WORDS
    vocabulary: dict[str, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: Items by state: those with the state's ``least`` words, and whole short items with their lengths.
    long_items: dict[int, list[int]] = field(default_factory=dict)
    short_items: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    chains: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        clone = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p != -1 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    def build(self, items: list[tuple[int, list[str]]]) -> Automaton:
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        for i, codes in coded:
            state = 0
            for n, c in enumerate(codes, 1):
                state = self.step[state][c]
                if n >= self.least:
                    self._note(self.long_items, self._suffix(state), i)
            if 0 < len(codes) < self.least:
                self._note(self.short_items, state, (len(codes), i))
        return self

    @staticmethod
    def _note(into: dict, state: int, what: object) -> None:
        held = into.setdefault(state, [])
        if not held or held[-1] != what:
            held.append(what)

    def _suffix(self, state: int) -> int:
        """The state of the suffix of ``least`` words."""
        while self.length[self.link[state]] >= self.least:
            state = self.link[state]
        return state

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """``(end, length, item)``: up to word ``end`` a text agrees with ``item``; ``length`` is the longest match there."""
        step, link, length, code = self.step, self.link, self.length, self.vocabulary.get
        state, n = 0, 0
        for end, w in enumerate(words, 1):
            c = code(w)
            if c is None:
                state = n = 0
                continue
            while state and c not in step[state]:
                state = link[state]
                n = length[state]
            if c in step[state]:
                state, n = step[state][c], n + 1
            if n >= self.least:
                for item in self.long_items.get(self._suffix(state), ()):
                    yield end, n, item
            for size, item in self._short(state):
                if size <= n:
                    yield end, size, item

    def _short(self, state: int) -> list[tuple[int, int]]:
        """The short items that are suffixes of a state's words; looked up along its links once."""
        if state not in self.chains:
            found, s = [], state
            while s:
                found += self.short_items.get(s, ())
                s = self.link[s]
            self.chains[state] = found
        return self.chains[state]


def build_automata(items: DataFrame, item_id: str = "item_id", text: str = "item_text", least: int = LEAST_WORDS, most_words: int = AUTOMATON_WORDS) -> Iterator[Automaton]:
    """Automata of the test items, one at a time; each holds at most ``most_words`` words, or one item if that is longer.

    Items come to the driver one partition after the other, and only one automaton is held at a time.
    """
    group: list[tuple[int, list[str]]] = []
    held = 0
    for i, t in items.select(F.col(item_id).cast("long"), F.col(text)).distinct().toLocalIterator():
        words = words_of(t)
        if held and held + len(words) > most_words:
            yield Automaton(least).build(group)
            group, held = [], 0
        group.append((i, words))
        held += len(words)
    if group:
        yield Automaton(least).build(group)


def _in_passes(automata: Iterable[Automaton], run: Callable[[Broadcast], DataFrame], spark: SparkSession) -> list[DataFrame]:
    """``run`` with each automaton, of which only one is broadcast at a time: where there are several, the result of a pass
    is written before the next automaton is built."""
    queue = iter(automata)
    first, second = next(queue, None), next(queue, None)
    if first is None:
        return []
    if second is None:
        return [run(spark.sparkContext.broadcast(first))]
    done = []
    for automaton in chain((first, second), queue):
        shared = spark.sparkContext.broadcast(automaton)
        done.append(scratch.materialise(run(shared), "leak-pass"))
        shared.destroy()
    return done


def find_leaks(docs: DataFrame, automata: Iterable[Automaton], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, longest, covered``: for each leak the longest match and the share of the words it covers.

    Each automaton is one pass over the documents; one automaton of ``AUTOMATON_WORDS`` words is all that is ever broadcast.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    schema = "doc_id long, item_id long, longest int, covered double"

    def run(shared: Broadcast) -> DataFrame:
        def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            automaton = shared.value
            for f in frames:
                out = []
                for i, t in zip(f["doc_id"], f["text"], strict=True):
                    words = words_of(t)
                    found: dict[int, list[int]] = {}  # item: longest, words covered, end of the last match
                    for end, n, item in automaton.matches(words):
                        longest, covered, last = found.get(item, (0, 0, 0))
                        # least words (or the whole short item) are certain to be the item's own; more may be another's
                        own = min(n, automaton.least)
                        found[item] = [max(longest, n), covered + end - max(last, end - own), end]
                    out += [(i, item, n, c / len(words)) for item, (n, c, _) in found.items()]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "longest", "covered"])

        return rows.mapInPandas(scan, schema)

    leaks = spark.createDataFrame([], schema)
    for part in _in_passes(automata, run, spark):
        leaks = leaks.unionByName(part)
    return leaks.groupBy("doc_id", "item_id").agg(F.max("longest").alias("longest"), F.max("covered").alias("covered"))


def remove_leaks(docs: DataFrame, automata: Iterable[Automaton], doc_id: str = "doc_id", text: str = "text", most_words: int | None = None, most_coverage: float = 0.5) -> DataFrame:
    """``doc_id, text, removed, dropped``: leaked spans cut out; documents covered beyond ``most_coverage`` are dropped (text null).

    A span is cut if it agrees with the items over more than ``most_words`` words (by default over all that the automata
    find: ``least`` words, or a whole shorter item).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null").withColumn("spans", F.array().cast("array<long>"))
    schema = "doc_id long, text string, spans array<long>"

    def marked(current: DataFrame, shared: Broadcast) -> DataFrame:
        """``spans`` with the matches of one automaton added, as first and last word in turn."""

        def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            automaton = shared.value
            for f in frames:
                out = []
                for t, spans in zip(f["text"], f["spans"], strict=True):
                    ends: dict[int, int] = {}
                    for end, n, _ in automaton.matches(words_of(t)):
                        if most_words is None or n > most_words:
                            ends[end] = max(n, ends.get(end, 0))
                    out.append([*spans, *(x for end, n in ends.items() for x in (end - n, end))])
                yield f.assign(spans=out)

        return current.mapInPandas(scan, schema)

    def cut(t: str, spans: Iterable[int]) -> tuple[str | None, int, bool]:
        words = words_with_spans(t)
        inside = np.zeros(len(words), bool)
        for a, z in np.asarray(spans, np.int64).reshape(-1, 2):
            inside[a:z] = True
        if inside.sum() > most_coverage * len(words):
            return None, int(inside.sum()), True
        kept, at = [], 0
        for (_, a, z), leaked in zip(words, inside, strict=True):
            if leaked:
                kept.append(t[at:a])
                at = z
        return "".join([*kept, t[at:]]), int(inside.sum()), False

    def scrub(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(i, *(cut(t, s) if len(s) else (t, 0, False))) for i, t, s in zip(f["doc_id"], f["text"], f["spans"], strict=True)], columns=["doc_id", "text", "removed", "dropped"])

    queue = iter(automata)
    first, second = next(queue, None), next(queue, None)
    for automaton in chain((first, second), queue):
        if automaton is None:
            continue
        shared = spark.sparkContext.broadcast(automaton)
        rows = marked(rows, shared)
        if second is not None:  # several passes: each is written, so that one automaton is broadcast at a time
            rows = scratch.materialise(rows, "leak-spans")
            shared.destroy()
    return rows.mapInPandas(scrub, "doc_id long, text string, removed int, dropped boolean")
