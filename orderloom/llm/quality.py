"""Quality classification by random indexing.

Words fall into a fixed number of buckets by hash. Every bucket has a sparse random vector with a
few entries of +1 and -1, and a context vector: the sum of the random vectors of its words'
neighbours, over all documents. So words of one bucket share a vector: the table of vectors keeps
its size, however many words the documents hold, at the price of mixing rare words with others.
A text is described by the mean and spread of its words' context vectors; a network with one
hidden layer turns that into a probability, calibrated by a temperature.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import held_out, map_texts, parts, reachable, smallest_hashes

#: Words share this many context vectors, by hash.
BUCKETS = 1 << 14
DIMENSIONS = 32
ENTRIES = 4
#: Neighbours on either side.
REACH = 2
#: Labelled texts to learn from, those with the smallest hashes.
SAMPLE_TEXTS = 12_000
HIDDEN = 32
THRESHOLD = 0.3

_BLOCK = 256  # buckets per row while sums travel
_SLICE = 1 << 17  # words, or bytes of a text, that are handled at a time
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\x00-\x20]+")
_GAP = re.compile(rb"[\x00-\x20]")
_rng = np.random.default_rng(3)
_PLACES = np.argsort(_rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :ENTRIES].astype(np.int32)
_SIGNS = _rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def tokens(text: str | None) -> np.ndarray:
    """Buckets of a text's words and runs of signs, letters A-Z in lower case."""
    data, found, low = (text or "").encode().lower(), [np.empty(0, np.int32)], 0
    while low < len(data):  # slices end where no word goes on
        gap = _GAP.search(data, low + _SLICE)
        high = gap.start() if gap else len(data)
        part = _TOKEN.findall(data, low, high)
        found.append(np.fromiter(map(zlib.crc32, part), np.uint32, len(part)).astype(np.int32)
                     % BUCKETS)
        low = high
    return np.concatenate(found)


def context_sums(texts) -> np.ndarray:
    """Per bucket: the sum of its neighbours' random vectors, and its number of words."""
    sums = np.zeros(BUCKETS * DIMENSIONS)
    pieces = [tokens(t) for t in texts]
    ids = np.concatenate([np.empty(0, np.int32), *pieces])
    counts = np.bincount(ids, minlength=BUCKETS)
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces])
    for low in range(0, len(ids), _SLICE):
        high = low + _SLICE
        for distance in range(1, REACH + 1):
            right = ids[low + distance:high + distance]
            left = ids[low:low + len(right)]
            near = owner[low:low + len(right)] == owner[low + distance:high + distance]
            left, right = left[near], right[near]
            for word, other in ((left, right), (right, left)):
                for entry in range(ENTRIES):
                    sums += np.bincount(word * DIMENSIONS + _PLACES[other, entry],
                                        _SIGNS[other, entry], BUCKETS * DIMENSIONS)
    return np.column_stack([sums.reshape(BUCKETS, DIMENSIONS), counts]).astype(np.int64)


def word_vectors(df: DataFrame, text="text") -> np.ndarray:
    """Context vectors of all buckets from all texts of `df`, of length 1 and weighted down for
    frequent words.

    Each task adds up its own texts. The sums travel in blocks of buckets and are added in two
    steps, spread over 64 groups first, by tasks that hold one block sum each; their integers do
    not depend on the order. The result has a fixed size.
    """
    reachable(df.sparkSession)
    schema = "block int, salt int, sums binary"

    def of_texts(batches):
        total = np.zeros((BUCKETS, DIMENSIONS + 1), dtype=np.int64)
        for batch in batches:
            for part in parts(batch, 0):
                total += context_sums(part.column(0).to_pylist())
        salt = zlib.crc32(total.tobytes()) % 64
        yield from _rows((low // _BLOCK, salt, total[low:low + _BLOCK])
                         for low in range(0, BUCKETS, _BLOCK) if total[low:low + _BLOCK].any())

    def of_sums(batches):
        totals = {}
        for batch in batches:
            for block, salt, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = np.frombuffer(data, dtype=np.int64).reshape(-1, DIMENSIONS + 1)
                totals[block] = totals[block] + sums if block in totals else sums
        yield from _rows((block, 0, sums) for block, sums in totals.items())

    found = (df.select(text).mapInArrow(of_texts, schema)
             .repartition("block", "salt").mapInArrow(of_sums, schema)
             .repartition("block").mapInArrow(of_sums, schema))
    total = np.zeros((BUCKETS, DIMENSIONS + 1))
    for block, _, data in found.collect():  # one row per block
        total[block * _BLOCK:(block + 1) * _BLOCK] += np.frombuffer(
            data, dtype=np.int64).reshape(-1, DIMENSIONS + 1)
    vectors, counts = total[:, :-1], total[:, -1]
    length = np.linalg.norm(vectors, axis=1)
    share = counts / max(1.0, counts.sum())
    weight = 1e-3 / (1e-3 + share)
    return (vectors * (weight / np.maximum(length, 1e-9))[:, None]).astype(np.float32)


def _rows(rows):
    for block, salt, sums in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([salt], pa.int32()),
             pa.array([np.ascontiguousarray(sums).tobytes()], pa.binary())],
            names=["block", "salt", "sums"])


def pooled(vectors: np.ndarray, texts) -> np.ndarray:
    """Per text: mean and spread of its words' vectors, length of the mean, log of the number of
    words, share of different words, and mean cosine of neighbours."""
    out = np.zeros((len(texts), 2 * DIMENSIONS + 4), dtype=np.float32)
    length = np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)
    for row, text in zip(out, texts, strict=True):
        ids = tokens(text)
        if len(ids):
            count = np.bincount(ids, minlength=BUCKETS)
            used = np.flatnonzero(count)
            share = (count[used] / len(ids))[:, None]
            mean = (vectors[used] * share).sum(axis=0)
            row[:DIMENSIONS] = mean
            row[DIMENSIONS:-4] = np.sqrt(((vectors[used] - mean) ** 2 * share).sum(axis=0))
            alike = 0.0
            for low in range(0, len(ids) - 1, _SLICE):
                part = ids[low:low + _SLICE + 1]
                even = vectors[part] / length[part][:, None]
                alike += np.einsum("ij,ij->i", even[1:], even[:-1]).sum(dtype=float)
            row[-4:] = (np.linalg.norm(mean), np.log1p(len(ids)) / 10, len(used) / len(ids),
                        alike / len(ids))
    return out


class Network:
    """Standardised inputs, one hidden layer of tanh units, a logit divided by `temperature`."""

    def __init__(self, mean, scale, weights, temperature=1.0):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.temperature = temperature

    def logits(self, features):
        w1, b1, w2, b2 = self.weights
        return np.tanh((features - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def train(features: np.ndarray, labels: np.ndarray, epochs=40, batch=128, rate=0.005,
          seed=2) -> Network:
    """Fits the network by Adam on four fifths of the rows; the temperature that makes the rest
    likeliest calibrates it."""
    rng = np.random.default_rng(seed)
    rows = rng.permutation(len(features))
    spare = rows[:len(rows) // 5]
    rows = rows[len(rows) // 5:]
    mean, scale = features[rows].mean(axis=0), features[rows].std(axis=0) + 1e-4
    inputs = (features - mean) / scale
    weights = [rng.normal(0, inputs.shape[1] ** -0.5, (inputs.shape[1], HIDDEN)),
               np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for low in range(0, len(rows), batch):
            chosen = rows[low:low + batch]
            x, y = inputs[chosen], labels[chosen]
            w1, b1, w2, b2 = weights
            hidden = np.tanh(x @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y) / len(y)
            back = error[:, None] * w2 * (1 - hidden**2)
            gradients = (x.T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2,
                         error.sum())
            step += 1
            for i, gradient in enumerate(gradients):
                first = moments[i][0] * 0.9 + 0.1 * gradient
                second = moments[i][1] * 0.999 + 0.001 * gradient**2
                moments[i] = first, second
                weights[i] = weights[i] - rate * (first / (1 - 0.9**step)) / (
                    np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, weights)
    if len(spare):
        logits, y = net.logits(features[spare]), labels[spare]
        def loss(t):
            return np.mean(np.logaddexp(0, logits / t) - y * logits / t)
        net.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))
    return net


def fit(df: DataFrame, labels: DataFrame, vectors: np.ndarray, texts=SAMPLE_TEXTS, key="doc_id",
        text="text", label="quality") -> Network | None:
    """Learns from at most `texts` labelled documents that are not held out; None if all have the
    same label. A document with several labels has the largest; null labels don't count."""
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key, 5))
             .groupBy(key).agg(F.max(label).alias("answer")))
    hashed = known.withColumn("hash", F.xxhash64(key))
    chosen = smallest_hashes(hashed, texts).orderBy("hash", key).limit(texts).drop("hash")
    rows = df.select(key, F.coalesce(text, F.lit("")).alias("text")).join(
        F.broadcast(chosen), key)
    found = map_texts(rows, lambda bodies: [pooled(vectors, bodies).tolist()],
                      "features array<float>", ["answer"]).collect()
    rows = sorted((row["answer"], row["features"]) for row in found)
    if len({answer for answer, _ in rows}) < 2:
        return None
    return train(np.array([f for _, f in rows]), np.array([float(a > 0) for a, _ in rows]))


def scores(df: DataFrame, vectors: np.ndarray, net: Network | None, keep=("doc_id",),
           text="text") -> DataFrame:
    """`keep`, score (probability of good quality) and predicted (1 from `THRESHOLD` on) of every
    whole text.

    Null and empty texts are scored as texts without words. Without a network all scores are
    0.5. Rows are independent: repeated rows give repeated results, an empty table none. Other
    columns are ignored.
    """

    def score(texts):
        found = net.score(pooled(vectors, texts)) if net else np.full(len(texts), 0.5)
        return [found, (found >= THRESHOLD).astype(np.int32)]

    return map_texts(df, score, "score double, predicted int", keep, text)
