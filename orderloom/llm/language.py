"""Language identification by a byte convolutional network.

A text is cut into windows of a fixed number of bytes. Filters of several widths slide over a
window's bytes; the largest response of each filter goes through a softmax layer. Training is
plain numpy on a bounded sample of labelled windows; a text's language has the largest mean
probability over all its windows.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.text import filter_texts, held_out, map_texts

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Distinct texts per language to learn from, those with the smallest hashes, and windows of each.
SAMPLE_TEXTS = 400
SAMPLE_WINDOWS = 8
#: A text goes if its language has a smaller mean probability.
MIN_SCORE = 0.35

UNDETERMINED = "und"
_UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def folded(text: str | None) -> bytes:
    return (text or "").encode().translate(_UPPER_TO_LOWER)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def windows(data: bytes) -> np.ndarray:
    """The windows of a text, one after the other, the last one filled up with spaces."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW), dtype=np.uint8).reshape(count, WINDOW)


class ByteNet:
    """`labels`, filters `kernels[width]` (width x 256 x FILTERS, with `bias`), and a softmax
    layer over the largest responses."""

    def __init__(self, labels, kernels, bias, weights, offset):
        self.labels, self.kernels, self.bias = labels, kernels, bias
        self.weights, self.offset = weights, offset
        self._pairs = None

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each window.

        Two neighbouring bytes are looked up together, in tables built once from the filters.
        """
        if self._pairs is None:
            self._pairs = {
                (width, j): (k[j][:, None, :] + k[j + 1][None, :, :]).reshape(65536, -1)
                for width, k in self.kernels.items() for j in range(0, width - 1, 2)}
        pair = codes[:, :-1].astype(np.int32) * 256 + codes[:, 1:]
        found = []
        for width, kernel in self.kernels.items():
            places = WINDOW - width + 1
            total = self._pairs[width, 0][pair[:, :places]]
            for j in range(2, width - 1, 2):
                total += self._pairs[width, j][pair[:, j:j + places]]
            if width % 2:
                total += kernel[-1][codes[:, width - 1:]]
            found.append(total.max(axis=1))
        return np.maximum(np.concatenate(found, axis=1) + self.bias, 0)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return _softmax(self.pooled(codes) @ self.weights + self.offset)

    def __getstate__(self):
        return self.__dict__ | {"_pairs": None}


def _softmax(scores):
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(codes: np.ndarray, answers: np.ndarray, labels, epochs=6, batch=128, rate=0.01,
          seed=1) -> ByteNet:
    """Fits a network to windows and the numbers of their labels (Adam on cross entropy).

    Only the place of a filter's largest response has a gradient, so the filters' gradients are
    sums over those places.
    """
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    state = {f"k{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    state |= {"bias": np.zeros(total, np.float32),
              "weights": rng.normal(0, 0.1, (total, len(labels))).astype(np.float32),
              "offset": np.zeros(len(labels), np.float32)}
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in state.items()}
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(codes))
        for low in range(0, len(codes), batch):
            chosen = shuffled[low:low + batch]
            step += 1
            for name, gradient in _gradients(state, codes[chosen], answers[chosen]).items():
                first, second = moments[name]
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                state[name] -= rate * (first / (1 - 0.9**step)) / (
                    np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return ByteNet(list(labels), {w: state[f"k{w}"] for w in WIDTHS}, state["bias"],
                   state["weights"], state["offset"])


def _gradients(state, codes, answers):
    n, pooled, places = len(codes), [], {}
    for width in WIDTHS:
        count = WINDOW - width + 1
        responses = sum(state[f"k{width}"][j][codes[:, j:j + count]] for j in range(width))
        places[width] = responses.argmax(axis=1)
        pooled.append(responses.max(axis=1))
    raw = np.concatenate(pooled, axis=1) + state["bias"]
    hidden = np.maximum(raw, 0)
    error = _softmax(hidden @ state["weights"] + state["offset"])
    error[np.arange(n), answers] -= 1
    error /= n
    back = (error @ state["weights"].T) * (raw > 0)
    out = {"weights": hidden.T @ error, "offset": error.sum(axis=0), "bias": back.sum(axis=0)}
    for i, width in enumerate(WIDTHS):
        gradient = np.zeros_like(state[f"k{width}"])
        part = back[:, i * FILTERS:(i + 1) * FILTERS]
        for j in range(width):
            seen = codes[np.arange(n)[:, None], places[width] + j]
            np.add.at(gradient[j], (seen, np.arange(FILTERS)[None, :]), part)
        out[f"k{width}"] = gradient
    return out


def labelled_windows(df: DataFrame, texts=SAMPLE_TEXTS, count=SAMPLE_WINDOWS, key="doc_id",
                     text="text", label="lang"):
    """(windows, label numbers, labels) of a bounded sample of the rows that may be learned from:
    those with a label, and letters in the text, that are not held out.

    Per label it takes the `texts` distinct texts with the smallest hashes, and of each up to
    `count` windows at even distances, and one shorter piece, so that short texts are learned.
    """
    rows = df.where(~held_out(key, 5) & F.col(label).isNotNull() & F.col(text).isNotNull())
    hashed = rows.select(F.col(label).alias("label"), F.xxhash64(text).alias("hash"))
    share = hashed.groupBy("label").agg(
        (2.0 * texts / F.approx_count_distinct("hash")).alias("share"))
    # about twice as many come near the front of a label's hashes: no task sorts a whole label
    near = hashed.join(F.broadcast(share), "label").where(
        F.col("hash") / 2.0**64 + 0.5 <= F.col("share"))
    first = Window.partitionBy("label").orderBy("hash")
    chosen = (near.select("label", "hash").distinct()
              .withColumn("n", F.row_number().over(first))
              .where(F.col("n") <= texts).select("label", "hash"))

    def pieces(bodies):
        return [[_pieces(folded(b), count) if has_letter(b) else [] for b in bodies]]

    sample = (rows.select(F.col(label).alias("label"), F.xxhash64(text).alias("hash"),
                          F.col(text).alias("text"))
              .join(F.broadcast(chosen), ["label", "hash"], "left_semi")
              .groupBy("label", "hash").agg(F.first("text").alias("text")))
    found = sorted((label_of, bytes(piece)) for label_of, made in map_texts(
        sample, pieces, "pieces array<binary>", ["label"]).collect() for piece in made)
    labels = sorted({label_of for label_of, _ in found})
    number = {label_of: i for i, label_of in enumerate(labels)}
    codes = np.concatenate([windows(p) for _, p in found] or [windows(b"")[:0]])
    return codes, np.array([number[label_of] for label_of, _ in found], dtype=np.int64), labels


def _pieces(data: bytes, count: int) -> list[bytes]:
    step = max(1, -(-len(data) // WINDOW) // count)
    found = [data[low:low + WINDOW] for low in range(0, len(data), step * WINDOW)][:count]
    size = 8 + len(data) % 56
    return [*found, data[len(data) // 2:][:size]]


def fit(df: DataFrame, **options) -> ByteNet | None:
    """A network for the labels in `df`; None if there is nothing to learn from."""
    codes, answers, labels = labelled_windows(df, **options)
    return train(codes, answers, labels) if labels else None


def predict(net: ByteNet | None, texts) -> tuple[list[str], list[float]]:
    """Label and mean probability of each text; `und` and 0 without letters or a network."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if net is None:
        return names, scores
    read = [i for i, t in enumerate(texts) if has_letter(t)]
    if not read:
        return names, scores
    data = [folded(texts[i]) for i in read]
    counts = [max(1, -(-len(d) // WINDOW)) for d in data]
    codes = np.frombuffer(b"".join(
        d.ljust(c * WINDOW) for d, c in zip(data, counts, strict=True)),
        dtype=np.uint8).reshape(-1, WINDOW)
    chances = np.concatenate([
        net.probabilities(codes[low:low + 256]) for low in range(0, len(codes), 256)])
    ends = np.cumsum(counts)
    # a last window of a few bytes counts for as much as it holds
    weight = np.full(len(codes), float(WINDOW))
    weight[ends - 1] = [len(d) - (c - 1) * WINDOW for d, c in zip(data, counts, strict=True)]
    sums = np.add.reduceat(chances * weight[:, None], ends - counts)
    means = sums / sums.sum(axis=1, keepdims=True)
    for i, row in zip(read, means, strict=True):
        best = int(row.argmax())
        names[i], scores[i] = net.labels[best], float(min(row[best], 1.0))
    return names, scores


def identify(df: DataFrame, net: ByteNet | None, keep=("doc_id",), text="text") -> DataFrame:
    """`keep`, lang_pred and score of every whole text.

    lang_pred is `und`, score 0, for a text that is null or has no letter, and for all if there
    is no network. Ties go to the label that sorts first. Rows are independent: repeated rows
    give repeated results, an empty table none. Other columns are ignored.
    """
    return map_texts(df, lambda texts: predict(net, texts), "lang_pred string, score double",
                     keep, text)


def drop_unclear(df: DataFrame, net: ByteNet | None, min_score=MIN_SCORE,
                 text="text") -> DataFrame:
    """The rows of `df`, all columns, whose text has a language of at least `min_score`."""

    def clear(texts):
        names, scores = predict(net, texts)
        return [n != UNDETERMINED and s >= min_score for n, s in zip(names, scores, strict=True)]

    return filter_texts(df, clear, text)
