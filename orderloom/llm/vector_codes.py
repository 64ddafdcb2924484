"""Product codes of vectors, with a GNAT over the entries of each codebook.

A vector is cut into equal parts; each part is coded by the nearest entry of its position's
codebook, which a few rounds of means refine. All arithmetic is on integers, so the result is the
same whatever the layout.

The nearest entry is found in a geometric near-neighbour access tree: a node picks split points far
from one another, hangs every other entry below the split point nearest to it, and keeps for each
pair of a split point and a child the range of distances between them. The distance of a query to one
split point thus bounds its distance to the entries of every child; a child whose bound lies strictly
beyond the best distance so far is left out with its whole subtree. Bounds are whole numbers, rounded
so that they never exceed the true distance, and what is left is decided by squared distances in
integers, ties to the lower index.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import reachable
from orderloom.session import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Split points of a node, and entries below which a subtree is searched one by one.
SPLITS = 6
LEAF = 4
#: Largest absolute integer component; beyond it squared distances might not fit 64 bits.
LARGEST = 1 << 26

_BATCH = 4096  # vectors at a time


def _floor_root(squares):
    """Whole square roots, rounded down."""
    root = np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def _ceil_root(squares):
    root = _floor_root(squares)
    return root + (root * root < squares)


def _squares(queries, point):
    apart = queries - point
    return np.einsum("ij,ij->i", apart, apart)


class Gnat:
    """A tree over the rows of `entries` with the numbers `ids`."""

    def __init__(self, entries: np.ndarray, ids: np.ndarray | None = None, splits=SPLITS,
                 leaf=LEAF):
        self.entries = entries
        self.ids = np.arange(len(entries)) if ids is None else ids
        self.children = []
        if len(self.ids) <= leaf:
            return
        self.split = self._far_apart(min(splits, len(self.ids)))
        rest = np.setdiff1d(self.ids, self.split)
        nearest = np.argmin([_squares(entries[rest], entries[s]) for s in self.split], axis=0)
        groups = [rest[nearest == i] for i in range(len(self.split))]
        self.children = [Gnat(entries, g, splits, leaf) if len(g) else None for g in groups]
        # the distances of split point i to child j's entries lie in low[i, j] .. high[i, j]
        shape = len(self.split), len(self.split)
        self.low, self.high = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for i, s in enumerate(self.split):
            for j, group in enumerate(groups):
                if len(group):
                    between = _squares(entries[group], entries[s])
                    self.low[i, j] = _floor_root(between.min())
                    self.high[i, j] = _ceil_root(between.max())

    def _far_apart(self, count):
        """`count` different entries, each as far as can be from those before it."""
        chosen = [self.ids[0]]
        near = _squares(self.entries[self.ids], self.entries[chosen[0]])
        while len(chosen) < count:
            near[np.isin(self.ids, chosen)] = -1
            chosen.append(self.ids[int(np.argmax(near))])
            near = np.minimum(near, _squares(self.entries[self.ids], self.entries[chosen[-1]]))
        return np.array(chosen)

    def nearest(self, queries: np.ndarray):
        """(index of the nearest entry, squared distance, number of distances computed)."""
        best = np.full(len(queries), len(self.entries), np.int64)
        far = np.full(len(queries), np.iinfo(np.int64).max)
        asked = self._search(queries, np.arange(len(queries)), best, far)
        return best, far, asked

    def _compare(self, queries, rows, entry, best, far):
        """Squared distances of some queries to an entry, which becomes the best where it wins."""
        square = _squares(queries[rows], self.entries[entry])
        wins = (square < far[rows]) | ((square == far[rows]) & (entry < best[rows]))
        best[rows[wins]], far[rows[wins]] = entry, square[wins]
        return square

    def _search(self, queries, rows, best, far):
        if not self.children:
            for entry in self.ids:
                self._compare(queries, rows, entry, best, far)
            return len(rows) * len(self.ids)
        asked, bound = 0, np.zeros((len(self.split), len(rows)), np.int64)
        for i, entry in enumerate(self.split):
            square = self._compare(queries, rows, entry, best, far)
            below, above = _floor_root(square), _ceil_root(square)
            asked += len(rows)
            for j, child in enumerate(self.children):
                if child is not None:
                    np.maximum(bound[j], np.maximum(self.low[i, j] - above,
                                                    below - self.high[i, j]), out=bound[j])
        for j, child in enumerate(self.children):
            if child is not None:
                left = rows[bound[j] * bound[j] <= far[rows]]  # else strictly beyond the best
                if len(left):
                    asked += child._search(queries, left, best, far)
        return asked


def integer_vectors(df: DataFrame, key="vec_id", vector="embedding", label="label",
                    scale=SCALE) -> DataFrame:
    """(key, label, vector of floor(scale * x)) of the rows whose vector is neither null nor holds a
    null or a component that is not finite. Products are exact, as `scale` is a power of two."""
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(key).alias("key"), F.col(label).alias("label"),
        F.transform(x, lambda v: F.floor(v * float(scale))).alias("vector"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != size).any():
        raise ValueError(f"vectors of other lengths than {size}")
    if len(flat) and max(-int(flat.min()), int(flat.max())) > LARGEST:
        raise ValueError(f"components beyond {LARGEST}")
    return flat.reshape(len(column), size)


def _assigned(vectors: np.ndarray, trees):
    """Codes and squared distances of all parts, (vectors, parts) each."""
    width = vectors.shape[1] // len(trees)
    codes = np.empty((len(vectors), len(trees)), np.int64)
    squares = np.empty_like(codes)
    for part, tree in enumerate(trees):
        piece = np.ascontiguousarray(vectors[:, part * width:(part + 1) * width])
        codes[:, part], squares[:, part], _ = tree.nearest(piece)
    return codes, squares


def _portions(batches, size):
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH):
            portion = batch.slice(start, _BATCH)
            yield portion, _matrix(portion.column("vector"), size)


def first_codebooks(vectors: DataFrame, parts=PARTS, entries=ENTRIES) -> np.ndarray:
    """(parts, entries, width): the parts of the vectors with the smallest keys, ascending (equal
    keys by vector, a null key last); fewer if there are fewer vectors."""
    rows = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    if not rows:
        return np.empty((parts, 0, 0), np.int64)
    size = len(rows[0].vector)
    if any(len(r.vector) != size for r in rows):
        raise ValueError(f"vectors of other lengths than {size}")
    if size % parts:
        raise ValueError(f"vectors of {size} components do not cut into {parts} equal parts")
    books = np.array([r.vector for r in rows], np.int64).reshape(len(rows), parts, -1)
    return np.ascontiguousarray(books.transpose(1, 0, 2))


def refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts nearest to it; an entry that no
    part is nearest to stays. A task sends one sum and one count per used entry."""
    parts, entries, width = books.shape

    def sums(batches):
        trees = [Gnat(book) for book in books]
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for _, matrix in _portions(batches, parts * width):
            codes, _ = _assigned(matrix, trees)
            for part in range(parts):
                piece = matrix[:, part * width:(part + 1) * width]
                np.add.at(total[part], codes[:, part], piece)
                count[part] += np.bincount(codes[:, part], minlength=entries)
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_pydict({
                "part": part.astype(np.int32), "entry": entry.astype(np.int32),
                "n": count[part, entry], "total": list(total[part, entry])})

    found = (vectors.select("vector").mapInArrow(
        sums, "part int, entry int, n long, total array<long>")
        .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
            F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)])
        .collect())  # parts x entries rows
    after = books.copy()
    for r in found:
        after[r.part, r.entry] = [int(r[f"t{i}"]) // r.n for i in range(width)]
    return after


def fit(vectors: DataFrame, parts=PARTS, entries=ENTRIES, rounds=ROUNDS) -> np.ndarray:
    """Codebooks of `integer_vectors`, learned from every row; at most 256 entries each, as a code
    has two digits per part."""
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries")
    reachable(vectors.sparkSession)
    books = first_codebooks(vectors, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refined(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(key, label, code, error): two hexadecimal digits per part, and the squared distances of all
    parts to their entries, summed up."""
    parts, _, width = books.shape

    def run(batches):
        trees = [Gnat(book) for book in books]
        for portion, matrix in _portions(batches, parts * width):
            codes, squares = _assigned(matrix, trees)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [portion.column("key"), portion.column("label"), pa.array(text),
                 pa.array(squares.sum(axis=1))], names=["key", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    reachable(vectors.sparkSession)
    return vectors.mapInArrow(
        run, f"key {kinds['key']}, label {kinds['label']}, code string, error long")


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[part, entry] for part, entry in enumerate(bytes.fromhex(code))])


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, key="vec_id", vector="embedding", label="label", parts=PARTS,
             entries=ENTRIES, rounds=ROUNDS) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row with a sound vector.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. All others
    must have one length, a multiple of `parts`, and components of at most `LARGEST` after scaling.
    Repeated rows are coded alike; equal vectors tie on the lower entry. label_error sums the errors
    of equal labels, null being one. An empty table gives no rows. Other columns are ignored.
    """
    kept = cut_lineage(integer_vectors(df, key, vector, label), "vector-integers")
    books = fit(kept, parts, entries, rounds)
    coded = cut_lineage(encode(kept, books), "vector-codes")
    labels = coded.groupBy(F.col("label").alias("of")).agg(
        F.sum("error").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
