"""Subword lattices: the probability of a word over all its segmentations.

The pieces come from an existing vocabulary. Words of the same length are handled together: the
pieces at all their places are looked up by hash, and a forward recursion in log space adds up all
ways to cover the word.
"""

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it can be inverted
_MIX = np.uint64(0xD6E8FEB86659FD93)
_CELLS = 1 << 21  # word bytes times piece lengths that are handled at a time
_SLOT_BITS = 20
_WRAP = (1 << 64) - 1

#: A longer word is read in stretches of so many bytes.
LONG = 1 << 16

BEGIN = b" "  # stands before a word, as words hold no white space


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece vocabulary as bytes, all single bytes included, and first log
    probabilities.

    The vocabulary's scores are minus the ranks of its pieces; a piece's first probability falls
    with its rank by Zipf's law. Special pieces are left out, and pieces that reach over the
    beginning of a word. Byte pieces stand for single bytes that no other piece spells.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            scores[piece] = max(scores.get(piece, -np.inf), model.get_score(i))
    least = min(scores.values(), default=0.0)
    for byte in range(256):
        scores.setdefault(bytes([byte]), least)
    pieces = sorted(scores, key=lambda p: (-scores[p], p))
    first = 1 / (10 + np.arange(len(pieces)))
    return pieces, np.log(first / first.sum())


class Lattice:
    """Pieces with log probabilities; every single byte must be a piece."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.log_p = np.append(log_p, -np.inf)  # the last one: no such piece
        self.longest = max(map(len, pieces))
        keys = np.array([_key(p) for p in pieces], dtype=np.uint64)
        self.slot_keys = np.zeros(1 << _SLOT_BITS, dtype=np.uint64)
        self.slot_ids = np.full(1 << _SLOT_BITS, len(pieces), dtype=np.int32)
        for i, (key, slot) in enumerate(zip(keys.tolist(), _slots(keys).tolist(), strict=True)):
            while self.slot_ids[slot] < len(pieces):
                slot = (slot + 1) % (1 << _SLOT_BITS)
            self.slot_keys[slot], self.slot_ids[slot] = key, i

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slots = _slots(keys)
        ids = self.slot_ids[slots]
        none = len(self.log_p) - 1
        other = np.flatnonzero((ids < none) & (self.slot_keys[slots] != keys))
        while len(other):
            slots[other] = (slots[other] + 1) % (1 << _SLOT_BITS)
            ids[other] = self.slot_ids[slots[other]]
            other = other[(ids[other] < none) & (self.slot_keys[slots[other]] != keys[other])]
        return ids

    def _places(self, codes: np.ndarray) -> list[np.ndarray]:
        """Ids of the pieces of 1, 2, ... bytes that begin at each place of each word."""
        count, size = codes.shape
        prefix = np.zeros((count, size + 1), dtype=np.uint64)
        for j in range(size):
            prefix[:, j + 1] = prefix[:, j] * np.uint64(_BASE) + codes[:, j] + np.uint64(1)
        found = []
        for length in range(1, min(self.longest, size) + 1):
            power = np.uint64(pow(_BASE, length, 1 << 64))
            hashes = prefix[:, length:] - prefix[:, :-length] * power
            keys = _mixed(hashes, length)
            found.append(self._find(keys.ravel()).reshape(keys.shape))
        return found

    def _forward(self, places, count, size, start=None):
        """Log probability of all ways to each place; `start` holds those to the first ones."""
        ways = np.empty((count, size + 1))
        start = np.zeros((count, 1)) if start is None else start
        ways[:, :start.shape[1]] = start
        for j in range(start.shape[1], size + 1):
            terms = np.stack([ways[:, j - length] + self.log_p[places[length - 1][:, j - length]]
                              for length in range(1, min(len(places), j) + 1)])
            ways[:, j] = _log_sum(terms)
        return ways

    def _backward(self, places, count, size):
        ways = np.empty((count, size + 1))
        ways[:, size] = 0
        for j in range(size - 1, -1, -1):
            terms = np.stack([ways[:, j + length] + self.log_p[places[length - 1][:, j]]
                              for length in range(1, min(len(places), size - j) + 1)])
            ways[:, j] = _log_sum(terms)
        return ways

    def _groups(self, words: list[bytes]):
        """Places in `words` of words of one length, and their bytes, in bounded portions."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if not len(same):
                continue
            size = int(sizes[same[0]]) + len(BEGIN)
            step = max(1, _CELLS // (size * min(size, self.longest)))
            for low in range(0, len(same), step):
                part = same[low:low + step]
                joined = b"".join(BEGIN + words[i] for i in part.tolist())
                yield part, np.frombuffer(joined, dtype=np.uint8).reshape(len(part), size)

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of each word's probability, summed over all segmentations."""
        out = np.empty(len(words))
        for part, codes in self._groups(words):
            if codes.shape[1] > LONG:
                out[part] = self._stretches(codes)
                continue
            places = self._places(codes)
            out[part] = self._forward(places, *codes.shape)[:, -1]
        return out

    def _stretches(self, codes) -> np.ndarray:
        """The same for long words: a stretch needs the ways to as many places before it as the
        longest piece has bytes."""
        done, ways = 0, np.zeros((len(codes), 1))  # ways to the last places up to `done`
        while done < codes.shape[1]:
            high = min(done + LONG, codes.shape[1])
            part = codes[:, done + 1 - ways.shape[1]:high]
            ways = self._forward(self._places(part), *part.shape, start=ways)[:, -self.longest:]
            done = high
        return ways[:, -1]

    def expected_counts(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, repeated `counts` times. Long words are
        taken stretch by stretch."""
        out = np.zeros(len(self.log_p))
        long = [i for i, w in enumerate(words) if len(w) >= LONG]
        if long:
            short = np.array([len(w) < LONG for w in words])
            cut = [(words[i][j:j + LONG - 1], counts[i]) for i in long
                   for j in range(0, len(words[i]), LONG - 1)]
            counts = np.append(counts[short], [c for _, c in cut])
            words = [w for w in words if len(w) < LONG] + [w for w, _ in cut]
        for part, codes in self._groups(words):
            count, size = codes.shape
            places = self._places(codes)
            ahead = self._forward(places, count, size)
            behind = self._backward(places, count, size)
            for length, ids in enumerate(places, start=1):
                chance = np.exp(ahead[:, :-length] + self.log_p[ids] + behind[:, length:]
                                - ahead[:, -1:]) * counts[part][:, None]
                out += np.bincount(ids.ravel(), chance.ravel(), len(out))
        return out[:-1]


def _log_sum(terms):
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _mixed(hashes, length):
    mixed = (hashes ^ np.uint64(length)) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _key(piece: bytes) -> np.uint64:
    value = 0
    for byte in piece:
        value = (value * _BASE + byte + 1) & _WRAP
    return _mixed(np.array([value], dtype=np.uint64), len(piece))[0]


def _slots(keys):
    return ((keys * np.uint64(_BASE)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
