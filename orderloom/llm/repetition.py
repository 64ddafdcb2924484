"""Repetition inside a text, by suffix array.

Words are numbered, and one suffix array is built over all texts of a batch by prefix doubling;
words of different texts count as different, so nothing matches across texts. An interval of
neighbours in the array whose longest common prefix has n words is a substring of n words that
occurs as often as the interval is long. It is a maximal repeat if its occurrences do not all
follow the same word. The union of the spans of all maximal repeats of a least length, and the
longest repeat, decide whether a text is kept.
"""

import re
from array import array
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from orderloom.llm.text import filter_texts, map_texts

#: Repeats of fewer words are how language works.
MIN_REPEAT_WORDS = 8
#: A text goes if such repeats cover more than this share of its words (clearly below the half
#: of `base_failed`, which no text with more than a half in such repeats gets past) ...
MAX_COVERED = 0.3
#: ... or if one repeat is longer than this.
MAX_REPEAT_WORDS = 100

#: Layout only: characters or entries that become Python objects at one time ...
PIECE = 1 << 16
#: ... and words compared of all suffixes at once before the long prefixes are taken one by one.
SHORT = 64

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_LINE = re.compile(r"[^\n]+")


class Repeats:
    """Suffix array and common prefixes of the words of several texts.

    `texts` is a list of iterables of words. `bounds` holds where each text begins among all
    words; `longest[i]` is the number of words of the longest prefix of suffix i that occurs
    elsewhere in its text; `order` is the suffix array and `common[t]` the common prefix of its
    entries t and t + 1. Arrays of four bytes a word are all that is kept.
    """

    def __init__(self, texts):
        numbered, known = [np.empty(0, dtype=np.int32)], 0
        for words in texts:
            numbers = {}
            numbered.append(np.fromiter(
                (numbers.setdefault(w, known + len(numbers)) for w in words), dtype=np.int32))
            known += len(numbers)
        self.bounds = np.cumsum([len(n) for n in numbered])
        self.numbers = np.concatenate(numbered)
        self.order = _suffix_array(self.numbers)
        self.common = _common_prefixes(self.numbers, self.order)
        self.longest = np.zeros(len(self.numbers), dtype=np.int32)
        if len(self.longest) > 1:
            self.longest[self.order[1:]] = self.common
            self.longest[self.order[:-1]] = np.maximum(
                self.longest[self.order[:-1]], self.common)

    def covered(self, least: int) -> np.ndarray:
        """Words of each text inside an occurrence of a maximal repeat of `least` words or more.

        Of the maximal intervals that hold a suffix, the innermost has the longest prefix, so
        its span is the union of theirs.
        """
        found = self.intervals(least)
        up = np.append(np.where(found.maximal, np.arange(len(found.words)), found.parents), -1)
        while True:  # to the next maximal interval around, in doubling steps
            further = up[up]
            if (further == up).all():
                break
            up = further
        spans = np.zeros(len(self.numbers), dtype=np.int32)
        spans[self.order[found.entries]] = np.append(found.words, 0)[up[found.innermost]]
        starts = np.flatnonzero(spans)
        return self._union(starts, spans[starts])

    def in_windows(self, width: int) -> np.ndarray:
        """Words of each text inside a window of `width` words that occurs twice or more."""
        return self._union(np.flatnonzero(self.longest >= width), width)

    def _union(self, starts, sizes):
        edges = np.zeros(len(self.numbers) + 1, dtype=np.int32)
        edges[starts] += 1
        np.subtract.at(edges, starts + sizes, 1)
        return self._per_text(np.cumsum(edges[:-1]) > 0, np.add)

    def longest_of_each(self) -> np.ndarray:
        return self._per_text(self.longest, np.maximum)

    def _per_text(self, values, combine):
        out = np.zeros(len(self.bounds) - 1, dtype=np.int64)
        full = np.flatnonzero(np.diff(self.bounds))
        if len(full):
            out[full] = combine.reduceat(values.astype(np.int64), self.bounds[full])
        return out

    def intervals(self, least: int) -> "Intervals":
        """The intervals of the array whose common prefix has `least` words or more."""
        words, lows, highs, parents = array("i"), array("i"), array("i"), array("i")
        entries, innermost, still_open = array("i"), array("i"), array("i")
        every, end = np.flatnonzero(self.common >= least), -1

        def close(end):
            entries.append(end)
            innermost.append(still_open[-1])
            while still_open:
                highs[still_open.pop()] = end

        for at in range(0, len(every), PIECE):
            piece = every[at:at + PIECE]
            for t, size in zip(piece.tolist(), self.common[piece].tolist(), strict=True):
                if t != end and still_open:
                    close(end)
                inside = still_open[-1] if still_open else -1
                low, last = t, -1
                while still_open and words[still_open[-1]] > size:
                    last = still_open.pop()
                    highs[last], low = t, lows[last]
                if not still_open or words[still_open[-1]] < size:
                    parents.append(still_open[-1] if still_open else -1)
                    if last >= 0:
                        parents[last] = len(words)
                    still_open.append(len(words))
                    words.append(size)
                    lows.append(low)
                    highs.append(-1)
                entries.append(t)
                innermost.append(inside if last >= 0 else still_open[-1])
                end = t + 1
        if still_open:
            close(end)
        words, lows, highs, parents, entries, innermost = (
            np.array(a, dtype=np.int32) for a in (words, lows, highs, parents, entries, innermost))
        # how often the word before changes between the entries of the array up to each of them
        before = np.where(np.isin(self.order, self.bounds[:-1]), -1, self.numbers[self.order - 1]) \
            if len(self.order) else self.order
        changes = np.cumsum(np.append(0, before[1:] != before[:-1]))
        return Intervals(words, lows, highs, parents, changes[highs] > changes[lows], entries,
                         innermost)

    def maximal(self, least: int):
        """(text, words, occurrences, first place) of the maximal repeats of `least` words or
        more. Places count words from the text's start."""
        found = self.intervals(least)
        out = []
        for words, low, high in zip(found.words[found.maximal], found.lows[found.maximal],
                                    found.highs[found.maximal], strict=True):
            first = self.order[low:high + 1].min()
            text = int(np.searchsorted(self.bounds, first, side="right")) - 1
            out.append((text, int(words), int(high - low) + 1, int(first - self.bounds[text])))
        return out


class Intervals(NamedTuple):
    """Intervals of a suffix array: entries `lows` to `highs` share `words` words and no more.

    `parents` is the next interval around each (-1: none); `maximal` tells whether different
    words, or a text's start, come before the occurrences. `innermost` is the smallest interval
    that holds each of `entries`.
    """

    words: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    parents: np.ndarray
    maximal: np.ndarray
    entries: np.ndarray
    innermost: np.ndarray


def _suffix_array(first: np.ndarray) -> np.ndarray:
    """Suffix array of `first`, by prefix doubling; only groups of several are sorted again."""
    n = len(first)
    order = np.argsort(first, kind="stable").astype(np.int32)
    new = np.ones(n, dtype=bool)
    new[1:] = np.diff(first[order]) != 0
    rank = np.full(n + 1, -1, dtype=np.int32)  # the array entry at which a suffix's group begins
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    width = 1
    tied = np.flatnonzero(~new | np.append(~new[1:], False)).astype(np.int32)
    while len(tied):
        at = order[tied]
        after = rank[np.minimum(at + width, n)]
        inside = np.lexsort((after, rank[at]))
        at, after = at[inside], after[inside]
        head = rank[at]
        order[tied] = at
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (np.diff(head) != 0) | (np.diff(after) != 0)
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        tied = tied[~fresh | np.append(~fresh[1:], False)]
        width *= 2
    return order


def _common_prefixes(first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that entries t and t + 1 of a suffix array share.

    Word by word only for suffixes that differ from their neighbour in the word before, whose
    prefixes add up to n log n at most; one place further on, a prefix is a word shorter. Texts
    share no number, so a prefix ends with its text.
    """
    n = len(first)
    if n < 2:
        return np.zeros(0, dtype=np.int32)
    padded = np.append(first, np.int32(-1))
    near = np.full(n, n, dtype=np.int32)  # the suffix before in the array
    near[order[1:]] = order[:-1]
    alone = np.ones(n, dtype=bool)
    alone[1:] = (near[1:] == n) | (near[1:] == 0) | (padded[near[1:] - 1] != first[:-1])
    shared = np.zeros(n, dtype=np.int32)
    growing = np.flatnonzero(alone).astype(np.int32)
    for size in range(SHORT):
        left, right = np.minimum(growing + size, n), np.minimum(near[growing] + size, n)
        growing = growing[(left < n) & (right < n) & (padded[left] == padded[right])]
        if not len(growing):
            break
        shared[growing] += 1
    for place in growing:
        left, right, size = int(place), int(near[place]), SHORT
        step = SHORT
        while True:
            step = min(2 * step, n - max(left, right) - size)
            other = np.flatnonzero(first[left + size:left + size + step]
                                   != first[right + size:right + size + step])
            size += int(other[0]) if len(other) else step
            if len(other) or not step:
                break
        shared[place] = size
    # what follows a place that was compared: a word less at every step
    places = np.arange(n, dtype=np.int32)
    source = np.maximum.accumulate(np.where(alone, places, 0))
    shared = np.maximum(shared[source] - (places - source), 0)
    return shared[order[1:]].astype(np.int32)


def words_of(text: str | None):
    """The words of a text, a piece of it at a time."""
    text, at = text or "", 0
    while at < len(text):
        blank = _BLANK.search(text, at + PIECE)
        end = blank.end() if blank else len(text)
        yield from _WORD.findall(text[at:end])
        at = end


def word_chars(text: str | None) -> int:
    return len(text or "") - sum(map((text or "").count, _BLANKS))


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    seen, lines = set(), 0
    for line in _LINE.finditer(text or ""):
        if _WORD.search(line[0]):
            lines += 1
            seen.add(line[0])
    return lines - len(seen)


def _measure(texts, least, max_covered, max_words):
    found = Repeats(map(words_of, texts))
    counts = np.diff(found.bounds)
    repeated = found.in_windows(3)
    covered, longest = found.covered(least), found.longest_of_each()
    failed = (counts < 50) | (100 * repeated > 50 * counts)
    kept = ~failed & (covered <= max_covered * counts) & (longest <= max_words)
    return counts, repeated, covered, longest, failed, kept


def repetition(df: DataFrame, least=MIN_REPEAT_WORDS, max_covered=MAX_COVERED,
               max_words=MAX_REPEAT_WORDS, keep=("doc_id",), text="text") -> DataFrame:
    """`keep` and the measures of every whole text.

    n_words (words are separated by ASCII white space), word_chars, n_symbols, n_dup_lines,
    n_repeat_words (words in 3-word windows found twice or more), n_covered_words (words inside
    maximal repeats of `least` words or more), longest_repeat (words), base_failed (fewer than 50
    words, or more than half of them in repeated windows), kept (not base_failed, and covered
    share and longest repeat within the limits).

    A null text has no words, so it fails like an empty one. Rows are independent: repeated rows
    give repeated results, an empty table none. Other columns are ignored.
    """

    def measure(texts):
        counts, repeated, covered, longest, failed, kept = _measure(
            texts, least, max_covered, max_words)
        return [counts, list(map(word_chars, texts)),
                [sum(map((t or "").count, SYMBOLS)) for t in texts],
                [duplicate_lines(t) for t in texts], repeated, covered, longest, failed, kept]

    return map_texts(
        df, measure, "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_covered_words long, longest_repeat long, base_failed boolean, "
        "kept boolean", keep, text)


def maximal_repeats(df: DataFrame, least=MIN_REPEAT_WORDS, keep=("doc_id",),
                    text="text") -> DataFrame:
    """One row per maximal repeat of a text: `keep`, n_words, occurrences (they may overlap),
    first_word (its first place, in words from 0) and repeat (its words, joined by spaces)."""

    def report(texts):
        words = [list(words_of(t)) for t in texts]
        rows = [[] for _ in texts]
        for at, size, times, first in Repeats(words).maximal(least):
            rows[at].append({"n_words": size, "occurrences": times, "first_word": first,
                             "repeat": " ".join(words[at][first:first + size])})
        return [rows]

    found = map_texts(df, report, "found array<struct<n_words: int, occurrences: int, "
                      "first_word: int, repeat: string>>", keep, text)
    return found.selectExpr(*(f"`{c}`" for c in keep), "inline(found)")


def drop_repetitive(df: DataFrame, least=MIN_REPEAT_WORDS, max_covered=MAX_COVERED,
                    max_words=MAX_REPEAT_WORDS, text="text") -> DataFrame:
    """The rows of `df` whose text is kept, with all their columns."""
    return filter_texts(df, lambda texts: _measure(texts, least, max_covered, max_words)[-1],
                        text)
