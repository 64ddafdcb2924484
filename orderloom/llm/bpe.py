"""Byte-level BPE by content-defined chunks.

A rolling hash cuts a text where its content says so, so passages that documents share fall into
the same chunks. A Python worker keeps the encoded chunks that it used last, up to a number of
bytes, and encodes a chunk again that is no longer among them. Where two chunks meet, the tokens
near the cut may differ from those of the whole text, and the join is repaired in two steps.

The pattern that splits a text into pieces breaks it between some kinds of characters whatever
stands around them, in any script: before white space behind anything else, and where letters,
numbers and other signs meet, but for what an apostrophe begins. Encodings of both sides agree at
such a position with that of the whole. So only the stretch between the two nearest to a cut is
repaired. If it is one piece, it is repaired by tokens: more and more tokens on both sides of the
cut are encoded again, until the new ones agree with those that stay. Tokens agree if the bytes of
each two neighbours are encoded as just these two; a piece whose neighbours all agree is encoded
as the whole would be. Other stretches (white space, apostrophes, special tokens, characters
younger than Unicode 3.2, whose kind libraries may see differently) are encoded again whole.
"""

import bisect
import collections
import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import map_texts

#: The splitting pattern of byte-level vocabularies, a fixed value.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

#: A chunk ends where this many low bits of the rolling hash are zero: 2 KiB on average.
CUT_BITS = 11
#: Bytes of chunks and their tokens that a worker keeps; those not used for longest go first.
KEPT_BYTES = 16 << 20
#: White-space runs of more characters do not go through the pattern, on which the engine's stack
#: for backtracking overflows at about a million.
LONG_RUN = 100_000

#: What the pattern calls white space; Python's own \s holds U+001C to U+001F too.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class Codec:
    """Encodes and decodes with the byte-level BPE vocabulary in a tokenizers JSON file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(_printable())}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in stored["model"]["vocab"].items() if token not in special}
        self._bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)
        self._special = tuple(special)
        self._one_piece = functools.cache(lambda: tiktoken.Encoding(
            "piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}))
        self.bytes_of = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self._lengths = [len(b) for b in self.bytes_of]
        self._agree = functools.lru_cache(1 << 16)(
            lambda left, right: self._piece(self.bytes_of[left] + self.bytes_of[right])
            == [left, right])
        self._chunks, self._chunk_bytes = collections.OrderedDict(), 0

    def plain(self, data: bytes) -> np.ndarray:
        """Ids of a text that is encoded in one go.

        The pattern makes one piece of a white-space run up to its last character, and of the
        whole run where the text ends or a special token follows: long runs are taken out so.
        """
        text, out, done = data.decode(), [], 0
        for run in _WHITE.finditer(text) if len(data) > LONG_RUN else ():
            low, high = run.span()
            if high - low > LONG_RUN:
                high -= high < len(text) and not text.startswith(self._special, high)
                out.append(self._split(text[done:low]))
                out.append(np.array(self._one_piece().encode_ordinary(text[low:high]),
                                    dtype=np.uint32))
                done = high
        if not out:
            return self._split(text)
        return np.concatenate([*out, self._split(text[done:])])

    def _split(self, text: str) -> np.ndarray:
        return self._bpe.encode_to_numpy(text, allowed_special="all")

    def chunk(self, data: bytes) -> np.ndarray:
        """Ids of a chunk, from the store if it is there."""
        ids = self._chunks.get(data)
        if ids is not None:
            self._chunks.move_to_end(data)
            return ids
        ids = self._chunks[data] = self.plain(data)
        self._chunk_bytes += _kept_bytes(data, ids)
        while self._chunk_bytes > KEPT_BYTES and len(self._chunks) > 1:
            self._chunk_bytes -= _kept_bytes(*self._chunks.popitem(last=False))
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of the whole text, chunk by chunk; none for null."""
        text = text or ""
        data = text.encode()
        cuts = chunk_ends(data)
        if len(cuts) < 2:
            return self.chunk(data)
        kinds, starts = character_kinds(text)
        safe = safe_positions(kinds, starts, self._special_spans(text))
        windows = repair_windows(cuts[:-1], safe, len(data))
        out, done, start, window = [], 0, 0, 0  # done: bytes of the text in `out`
        for end in cuts:
            ids = None
            while done < end:
                if window < len(windows) and windows[window][0] <= done:
                    low, high = windows[window]
                    out.append(self._repaired(data, low, high, cuts, kinds, starts))
                    done, window = high, window + 1
                    continue
                stop = min(end, windows[window][0]) if window < len(windows) else end
                ids = self.chunk(data[start:end]) if ids is None else ids
                first = self._count(ids, done - start)
                last = len(ids) - self._count(ids[::-1], end - stop)
                out.append(ids[first:last])
                done = stop
            start = end
        return np.concatenate(out)

    def _special_spans(self, text: str):
        """Characters of special tokens: first, and one behind the last."""
        return [m.span() for token in self._special for m in re.finditer(re.escape(token), text)]

    def _piece(self, data: bytes) -> list[int]:
        return self._one_piece()._encode_single_piece(data)

    def _repaired(self, data: bytes, low: int, high: int, cuts, kinds, starts) -> np.ndarray:
        """Ids of a stretch with cuts in it: from those of its chunks if it is one piece, behind
        white space or not, else encoded again."""
        first, last = np.searchsorted(starts, (low, high))
        signs = first + int(np.argmax(kinds[first:last] != WHITE))
        at = bisect.bisect_right(cuts, low)  # the first cut behind `low`
        kind = kinds[signs]
        if (kind not in (LETTER, NUMBER, OTHER) or cuts[at] <= starts[signs]
                or (kinds[signs:last] != kind).any()):
            return self.plain(data[low:high])
        begin = int(starts[signs])
        begin -= begin > low and data[begin - 1] == 32  # a space before signs is in their piece
        ids, place = [], low
        while place < high:
            start, end = cuts[at - 1] if at else 0, cuts[at]
            part = self.chunk(data[start:end])
            part = part[self._count(part, place - start):]
            if end > high:
                part = part[:len(part) - self._count(part[::-1], end - high)]
            if ids:
                self._join(ids, before, part.tolist())
            else:
                before, ids = self._count(part, begin - low), part.tolist()
            place, at = end, at + 1
        return np.array(ids, dtype=np.uint32)

    def _join(self, left: list[int], before: int, right: list[int]) -> None:
        """Appends to `left` the ids of the rest of a piece, after encoding as many ids on both
        sides again as it takes. The first `before` ids of `left` are of earlier pieces."""
        if self._agree(left[-1], right[0]):
            left += right
            return
        take, give = 1, 1
        while True:
            kept = max(len(left) - take, before)
            taken = [*left[kept:], *right[:give]]
            middle = self._piece(b"".join(map(self.bytes_of.__getitem__, taken)))
            fits_left = kept == before or self._agree(left[kept - 1], middle[0])
            fits_right = give >= len(right) or self._agree(middle[-1], right[give])
            if fits_left and fits_right:
                left[kept:] = [*middle, *right[give:]]
                return
            take, give = take * (1 + (not fits_left)), give * (1 + (not fits_right))

    def _count(self, ids: np.ndarray, size: int) -> int:
        """How many of the first ids hold the first `size` bytes, a break between ids."""
        near = 0
        while size > 0:
            size -= self._lengths[ids[near]]
            near += 1
        return near

    def decode(self, ids) -> str:
        """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _kept_bytes(data: bytes, ids: np.ndarray) -> int:
    return len(data) + ids.nbytes + 200


def _printable():
    """The character that stands for each byte in such a vocabulary: itself if printable,
    else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_GEAR = np.random.default_rng(8).integers(0, 2**32, 256, dtype=np.uint32)

#: Kinds of characters, as the pattern tells them apart.
UNSURE, WHITE, LETTER, NUMBER, OTHER, APOSTROPHE = range(6)
_KNOWN = 0x30000  # code points from here on are unsure
_LETTERS, _NUMBERS = ("Lu", "Ll", "Lt", "Lm", "Lo"), ("Nd", "Nl", "No")


def _kind(code: int) -> int:
    sign = chr(code)
    if sign == "'":
        return APOSTROPHE
    if _WHITE.match(sign):
        return WHITE
    old, new = unicodedata.ucd_3_2_0.category(sign), unicodedata.category(sign)
    if old in ("Cn", "Cs") or 0x1C <= code <= 0x1F:
        return UNSURE
    kinds = {LETTER if c in _LETTERS else NUMBER if c in _NUMBERS else UNSURE if c[0] == "Z"
             else OTHER for c in (old, new)}
    return kinds.pop() if len(kinds) == 1 else UNSURE


@functools.cache
def _kinds() -> np.ndarray:
    return np.array([*map(_kind, range(_KNOWN)), UNSURE], dtype=np.uint8)


def character_kinds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each character, and the byte at which it begins, with the number of bytes
    last."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    starts = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int8) + (codes > 0xFFFF),
              out=starts[1:])
    return _kinds()[np.minimum(codes, _KNOWN)], starts


_BREAKS = np.zeros((6, 6), dtype=bool)
_BREAKS[[LETTER, NUMBER, OTHER, APOSTROPHE], WHITE] = True
_BREAKS[LETTER, [NUMBER, OTHER, APOSTROPHE]] = True
_BREAKS[NUMBER, [LETTER, OTHER, APOSTROPHE]] = True
_BREAKS[OTHER, [LETTER, NUMBER]] = True
_BREAKS[APOSTROPHE, NUMBER] = True


def safe_positions(kinds: np.ndarray, starts: np.ndarray, special=()) -> np.ndarray:
    """Bytes before which any encoding breaks, by the characters on both sides; none within the
    spans `special` of special tokens."""
    breaks = _BREAKS[kinds[:-1], kinds[1:]]
    for low, high in special:
        breaks[low:high - 1] = False
    return starts[np.flatnonzero(breaks) + 1]


def chunk_ends(data: bytes, bits: int = CUT_BITS) -> list[int]:
    """Ends of the content-defined chunks, the last one the end of the data.

    The rolling hash of a byte is the sum of table values of the last 16 bytes, each shifted by
    its distance; a cut is made after a byte whose hash ends in zero bits, before a character.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    rolling = _GEAR[codes]
    for width in (1, 2, 4, 8):
        earlier = rolling[:-width] << np.uint32(width)
        rolling[width:] += earlier
    cut = (rolling[15:-1] >> np.uint32(16)) & np.uint32((1 << bits) - 1) == 0
    ends = np.flatnonzero(cut & (codes[16:] & 0xC0 != 0x80)) + 16
    return [*ends.tolist(), len(data)] if len(data) else []


def repair_windows(cuts, safe: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The stretches to encode again, apart and in order: around each cut that is not a safe
    position, from the last one before it to the first one after it."""
    windows = []
    if not cuts:
        return windows
    for cut, place in zip(cuts, np.searchsorted(safe, cuts).tolist(), strict=True):
        if place < len(safe) and safe[place] == cut:
            continue
        low = int(safe[place - 1]) if place else 0
        high = int(safe[place]) if place < len(safe) else size
        if windows and low < windows[-1][1]:
            windows[-1] = windows[-1][0], max(high, windows[-1][1])
        else:
            windows.append((low, high))
    return windows


@functools.cache
def codec(path: str) -> Codec:
    """One codec per worker process."""
    return Codec(path)


def encode_documents(df: DataFrame, path: str, keep=("doc_id",), text="text") -> DataFrame:
    """`keep` and `ids`: the token ids of every whole text, an empty list for null and empty
    texts. `path` is the vocabulary's place on every executor. Rows are independent: repeated
    rows give repeated results, an empty table none, and other columns are ignored."""
    return map_texts(df, lambda texts: [[codec(path).encode(t) for t in texts]],
                     "ids array<int>", keep, text)


def decode_documents(df: DataFrame, path: str, keep=("doc_id",), ids="ids") -> DataFrame:
    """`keep` and `text`: the text of the token ids in column `ids`, empty for null."""
    kept = df.select(*keep, F.coalesce(F.to_json(ids), F.lit("[]")).alias("ids"))
    return map_texts(kept, lambda rows: [[codec(path).decode(json.loads(r)) for r in rows]],
                     "text string", keep, "ids")


def digests(df: DataFrame, path: str, keep=("doc_id",), text="text") -> DataFrame:
    """`keep`, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers) and
    decoded_sha256 (of the text that decoding the ids gives), in one pass over the texts."""

    def digest(texts):
        counts, of_ids, of_text = [], [], []
        for t in texts:
            ids = codec(path).encode(t)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            decoded = codec(path).decode(ids.tolist())
            of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
        return counts, of_ids, of_text

    return map_texts(df, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                     keep, text)
