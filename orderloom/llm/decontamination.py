"""Benchmark decontamination by a generalised suffix automaton.

The automaton of the normalised test items recognises every run of words that occurs in an item.
Texts are streamed through it word by word; its state gives the length of the longest match that
ends at the current word. Where that length reaches a window, the window's words are hit. Hit
spans are cut out of a text, and a text of which too much is hit goes.

The automaton is built from at most `BLOCK_WORDS` words of items; more items make more automata,
through which the texts pass one after the other, each pass adding its hits to the row.
"""

import functools
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import parts, reachable
from orderloom.session import cut_lineage

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: A text is contaminated if one word in so many is hit.
ONE_IN = 20
#: Item words per automaton, about 100 MB of it.
BLOCK_WORDS = 100_000

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b if b >= 128 or b in _KEEP else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))
_SPAN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return (text or "").encode().translate(_FOLD).split()


class Automaton:
    """All word runs of `items`, a list of (id, text), with the items they occur in."""

    def __init__(self, items, window=WINDOW):
        self.window = window
        self.numbers = {}
        self.next, self.link, self.size = [{}], [-1], [0]
        self._windows = {}
        self.whole = {}  # state of a short item -> its size
        self.same = {}  # and the items that are no more than that
        texts = []
        for name, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)]
            if words:
                texts.append((name, words))
                state = self._add(words)
                if len(words) < window:
                    self.whole[state] = len(words)
                    self.same.setdefault(state, set()).add(name)
        self.shortest = min([window, *self.whole.values()])
        self.items = [set() for _ in self.next]
        for name, words in texts:
            state = 0
            for word in words:
                state = at = self.next[state][word]
                while at and name not in self.items[at]:
                    self.items[at].add(name)
                    at = self.link[at]

    def _add(self, words) -> int:
        state = 0
        for word in words:
            state = self._step(state, word)
        return state

    def _step(self, last, word) -> int:
        """The state of the item read so far, followed by `word`."""
        known = self.next[last].get(word)
        if known is not None:
            if self.size[known] == self.size[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state({}, self.size[last] + 1, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            known = self.next[at][word]
            fits = self.size[known] == self.size[at] + 1
            self.link[new] = known if fits else self._split(at, word, known)
        return new

    def _state(self, following, size, link) -> int:
        self.next.append(following)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, at, word, known) -> int:
        """Gives the shorter runs of state `known` a state of their own."""
        short = self._state(dict(self.next[known]), self.size[at] + 1, self.link[known])
        self.link[known] = short
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = short
            at = self.link[at]
        return short

    def windows(self, state: int, size: int) -> tuple[int, frozenset]:
        """Words of the longest window that ends a match of `size` words in `state` (0: none),
        and the items of all windows that do."""
        if (state, size) not in self._windows:
            self._windows[state, size] = self._find_windows(state, size)
        return self._windows[state, size]

    def _find_windows(self, state, size):
        longest, items = 0, frozenset()
        while state > 0:
            least = self.size[self.link[state]]
            if least < self.window <= size:
                longest, items = self.window, items | self.items[state]
            if (short := self.whole.get(state, size + 1)) <= size:
                longest, items = max(longest, short), items | self.same[state]
            state = self.link[state]
            size = min(size, least)
        return longest, items

    def hits(self, words) -> tuple[list[tuple[int, int]], frozenset]:
        """The spans of words inside windows, apart and ascending, and the windows' items."""
        numbers = self.numbers
        known = bytes(map(numbers.__contains__, words))  # 1: a word of some item
        spans, items, high = [], frozenset(), 0
        low = known.find(b"\x01" * self.shortest)
        while low >= 0:
            high = known.find(b"\x00", low)
            high = len(words) if high < 0 else high
            state = size = 0
            for place in range(low, high):
                word = numbers[words[place]]
                while state and word not in self.next[state]:
                    state = self.link[state]
                    size = self.size[state]
                state = self.next[state].get(word, 0)
                size = size + 1 if state else 0
                if size >= self.shortest:
                    longest, found = self.windows(state, size)
                    if longest:
                        items |= found
                        _join(spans, place + 1 - longest, place + 1)
            low = known.find(b"\x01" * self.shortest, high)
        return spans, items


def _join(spans, low, high):
    while spans and spans[-1][1] >= low:
        low = min(low, spans.pop()[0])
    spans.append((low, high))


def united(spans):
    """Spans that may overlap, as spans apart."""
    out = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def without(text: str, spans) -> str:
    """The text without the words of `spans` and what stands between them."""
    data = text.encode()
    places = [m.span() for m in _SPAN.finditer(data.translate(_FOLD))]
    kept, done = [], 0
    for low, high in spans:
        kept.append(data[done:places[low][0]])
        done = places[high - 1][1]
    return b"".join([*kept, data[done:]]).decode()


def contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and ONE_IN * n_hit >= n_words


@functools.lru_cache(maxsize=2)
def _automaton(items, window):
    return Automaton(items, window)


def _blocks(items: DataFrame, words: int, key, text):
    """Tuples of (id, text) with about so many words of text each, as the rows come."""
    block, size = [], 0
    rows = items.where(F.col(text).isNotNull()).select(
        F.col(key).cast("string"), text).sort(F.xxhash64(text), key)
    for name, body in rows.toLocalIterator():
        block.append((name or "", body))
        size += len(words_of(body))
        if size >= words:
            yield tuple(block)
            block, size = [], 0
    if block:
        yield tuple(block)


def find_hits(df: DataFrame, items: DataFrame, window=WINDOW, block_words=BLOCK_WORDS,
              text="text", item_key="item_id", item_text="text") -> DataFrame:
    """The rows of `df` with four more columns: hit_starts and hit_ends (arrays, in words from
    0, of the spans inside some window), hit_items (the items, sorted as text) and hit_of (the
    number of words of the text).

    Items without words (null, empty, signs only) have no window; one without id is called "".
    An empty table of items hits nothing. Null texts have no words. Rows are independent, and
    all columns of `df` stay. Only one block of items at a time is in the driver and the tasks.
    """
    return _passes(df, items, window, block_words, text, item_key, item_text)


def _passes(df, items, window=WINDOW, block_words=BLOCK_WORDS, text="text", item_key="item_id",
            item_text="text", finish=None, schema=None):
    """`df` with its hits; or what `finish` makes of each batch in the last pass, in `schema`."""
    reachable(df.sparkSession)
    found = df.select("*", *(F.array().cast(f"array<{kind}>").alias(name) for name, kind in (
        ("hit_starts", "int"), ("hit_ends", "int"), ("hit_items", "string"))),
        F.lit(0).cast("long").alias("hit_of"))
    blocks = itertools.chain(_blocks(items, block_words, item_key, item_text), [None])
    block = next(blocks) or ()
    while block is not None:
        after = next(blocks, None)
        last = after is None
        run = _hits_of(block, window, df.columns.index(text), len(df.columns),
                       finish if last else None)
        found = found.mapInArrow(run, schema if last and finish else found.schema)
        if not last:
            found = cut_lineage(found, "decontamination")
        block = after
    return found


def _hits_of(block, window, text_at, first_at, finish):
    def run(batches):
        automaton = _automaton(block, window)
        for batch in batches:
            for part in parts(batch, text_at):
                columns = part.columns
                before = [c.to_pylist() for c in columns[first_at:first_at + 3]]
                rows = []
                for body, *earlier in zip(columns[text_at].to_pylist(), *before, strict=True):
                    words = words_of(body)
                    spans, names = automaton.hits(words)
                    if earlier[0]:
                        spans = united([*zip(earlier[0], earlier[1], strict=True), *spans])
                    rows.append(([a for a, _ in spans], [b for _, b in spans],
                                 sorted({*earlier[2], *names}), len(words)))
                if finish:
                    yield finish(part.select(range(first_at)), rows)
                    continue
                made = [pa.array([r[i] for r in rows], type=columns[first_at + i].type)
                        for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*columns[:first_at], *made], schema=part.schema)

    return run


def contamination(df: DataFrame, items: DataFrame, keep=("doc_id",), text="text",
                  **options) -> DataFrame:
    """`keep` and the contract's digest: n_words, n_hit (words inside windows), n_items,
    items_sha256 (of the items, sorted and joined by commas) and contaminated."""
    narrow = df.select(*keep, F.col(text).alias("text"))
    n_hit = F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a),
                        F.lit(0), lambda x, y: x + y).cast("long")
    return find_hits(narrow, items, **options).select(
        *keep, F.col("hit_of").alias("n_words"), n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("hit_of"))).alias("contaminated"))


def clean(df: DataFrame, items: DataFrame, text="text", count="n_chars", **options) -> DataFrame:
    """`df` without contaminated rows; in the others the hit spans are cut out of the text, and
    `count`, if there is such a column, is its new number of characters."""
    text_at = df.columns.index(text)
    count_at = df.columns.index(count) if count in df.columns else None

    def cut(part, rows):
        texts, keep, counts = part.column(text_at).to_pylist(), [], None
        if count_at is not None:
            counts = part.column(count_at).to_pylist()
        for i, (starts, ends, _, n_words) in enumerate(rows):
            n_hit = sum(ends) - sum(starts)
            keep.append(not contaminated(n_hit, n_words))
            if n_hit and keep[-1]:
                texts[i] = without(texts[i], zip(starts, ends, strict=True))
                if counts:
                    counts[i] = len(texts[i])
        columns = part.columns
        columns[text_at] = pa.array(texts, type=columns[text_at].type)
        if counts:
            columns[count_at] = pa.array(counts, type=columns[count_at].type)
        return pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(
            pa.array(keep, type=pa.bool_()))

    return _passes(df, items, text=text, finish=cut, schema=df.schema, **options)
