"""N-gram Jaccard join of whole texts: a size-aware join that treats light and heavy sets apart.

A text's set holds its distinct shingles. Two sets link when their intersection is at least
`PERCENT` of their union. Equal sets are one class, found first, so copies cost nothing.

Light sets, up to a boundary, are enumerated: a pair that links shares a subset as large as the
larger set's share of `PERCENT`, so every light set lists its subsets of the few sizes its partners
may ask for, and those with a subset in common meet. Heavy sets scan inverted lists: with the
tokens of every set in one order, rare ones first, a pair that links shares one of the first few,
so only those are indexed; a light set near the boundary is indexed too, to meet heavy ones. The
boundary is where enumerating and scanning together cost least, from the sizes of all sets and the
frequencies of all tokens.

Lists are scanned in rounds. In every round a few sets of each list, its centers, are compared with
the others in it and then leave it; a list whose members are all connected already is done. So a
list of near-copies is done once one center links them, and a list of any length costs a row per
member and center. Two bounds that never exclude a link leave out most other pairs: the largest overlap
that the positions in the list allow, and the least difference that parity sketches show (every
token in one set only flips one bit). What is left is held against longer sketches first, so that
few sets are moved that do not link; the rest is decided by exact intersections.

Shingles and sets stand as 64-bit hashes. Two different sets with one hash are found by a second
hash and end the run with an error; another seed then helps.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.graph import components
from orderloom.llm.text import parts, reachable
from orderloom.session import cut_lineage, delete_folder, work_folder

SHINGLE = 3
PERCENT = 90
SEED = 42
#: Token frequencies are counted per hash bucket: the order of tokens needs them only roughly.
BUCKETS = 1 << 16
#: Sets beyond this size are never enumerated: their subsets would be too many at any frequency.
LARGEST_LIGHT = 40
#: Longs of a set's parity sketch.
SKETCH = 4
#: Longs of the sketch that pairs are held against before their sets are moved: it bounds the
#: difference well up to texts of about 20,000 words.
LONG_SKETCH = 128
#: Size of the filter that tells which texts to read again: half a megabyte.
FILTER_BITS = 1 << 22
#: Centers of a list in the first round, in the second, and the factor from then on.
CENTERS, MORE_CENTERS, GROWTH = 1, 16, 8

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def tokens(text: str | None, shingle=SHINGLE, seed=SEED) -> np.ndarray:
    """The hashes of the text's distinct shingles, ascending; of the whole sequence if it has fewer
    words; none without words."""
    words = (text or "").encode().translate(_FOLD).split()
    if len(words) < shingle:
        joined = b" ".join(words)
        return np.array([xxhash.xxh64_intdigest(joined, seed + 1)] if words else [], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - shingle + 1
    mixed = np.full(count, seed, np.uint64)
    for i in range(shingle):
        mixed = (mixed ^ hashes[i:i + count]) * _MIX[i % len(_MIX)]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_hash(values: np.ndarray, seed=SEED) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes(), seed) - (1 << 63)


def parities(values: np.ndarray, longs=SKETCH) -> np.ndarray:
    """`longs` longs with a bit for each of as many groups of tokens: whether its number is odd."""
    bits = 64 * longs
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed(size: int, percent=PERCENT) -> int:
    """Tokens of a set of `size` that any partner of no larger size must share."""
    return -(-percent * size // 100)


def largest_partner(size: int, percent=PERCENT) -> int:
    return 100 * size // percent


def subset_sizes(size: int, boundary: int, percent=PERCENT) -> list:
    """Sizes of the subsets that a light set enumerates: what it and its larger light partners
    need."""
    partners = range(size, min(boundary, largest_partner(size, percent)) + 1)
    return sorted({c for c in (needed(n, percent) for n in partners) if c <= size})


def prefix(size: int, percent=PERCENT) -> int:
    """Tokens of a set to index, so that it shares one with every partner."""
    return size - needed(size, percent) + 1


def choose_boundary(sizes: dict, met: float, percent=PERCENT, largest=LARGEST_LIGHT) -> int:
    """The size up to which sets are light.

    `sizes` has the number of sets of each size. Enumerating a set costs a row per subset;
    scanning costs a row per indexed token and the `met` sets that its list holds on average.
    Light sets near the boundary do both.
    """
    best = None
    for boundary in range(largest + 1):
        cost = 0.0
        for size, count in sizes.items():
            scans = size > boundary or largest_partner(size, percent) > boundary
            if scans:
                cost += count * prefix(size, percent) * (1 + met)
            if size <= boundary:
                cost += count * sum(math.comb(size, c)
                                    for c in subset_sizes(size, boundary, percent))
        if best is None or cost < best[0]:
            best = cost, boundary
    return best[1]


def keys_of(values: np.ndarray, counts: np.ndarray, boundary: int, percent=PERCENT):
    """(keys, positions) under which a set meets its partners; subsets have position 0."""
    size = len(values)
    keys, places = [], []
    if size > boundary or largest_partner(size, percent) > boundary:
        order = np.lexsort((values, counts[_bucket(values)]))[:prefix(size, percent)]
        keys.append(values[order].view(np.int64))
        places.append(np.arange(len(order), dtype=np.int32))
    if size <= boundary:
        for c in subset_sizes(size, boundary, percent):
            some = [xxhash.xxh64_intdigest(np.array(s).tobytes(), c) for s in
                    itertools.combinations(values.tolist(), c)]
            keys.append(np.array(some, np.uint64).view(np.int64))
            places.append(np.zeros(len(some), np.int32))
    return np.concatenate(keys), np.concatenate(places)


def _bucket(values):
    return (values >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


class _Scratch:
    """Tables in the shared folder that are deleted as soon as nothing reads them any more."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = work_folder(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def empty(self, but=()):
        """Deletes all tables but those of `but` (numbers from the end)."""
        last = [self.paths[-i] for i in but]
        for path in self.paths:
            if path not in last:
                delete_folder(self.spark, path)
        self.paths = last


def _read(docs: DataFrame, shingle, seed) -> DataFrame:
    """(key, n, set, check, sketch) of every row, and (bucket, hits) of every task."""
    sketch = [f"p{i}" for i in range(SKETCH)]

    def run(batches):
        hits = np.zeros(BUCKETS, np.int64)
        schema = None
        for batch in batches:
            schema = batch.schema.field("key")
            for part in parts(batch, "text"):
                sizes, sets, checks = [], [], []
                odd = np.empty((part.num_rows, SKETCH), np.int64)
                for i, text in enumerate(part.column("text").to_pylist()):
                    values = tokens(text, shingle, seed)
                    np.add.at(hits, _bucket(values), 1)
                    odd[i] = parities(values)
                    sizes.append(len(values))
                    sets.append(set_hash(values, seed))
                    checks.append(set_hash(values, seed + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()),
                     pa.array(checks, pa.int64()), *map(pa.array, odd.T.copy()),
                     pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int64())],
                    names=names)
        used = np.flatnonzero(hits)
        if len(used):
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), schema.type), none, none, none, *[none] * SKETCH,
                 pa.array(used.astype(np.int32)), pa.array(hits[used])], names=names)

    names = ["key", "n", "set", "check", *sketch, "bucket", "hits"]
    kind = dict(docs.dtypes)["key"]
    longs = ", ".join(f"`{name}` long" for name in names[1:-2])
    return docs.mapInArrow(run, f"key {kind}, {longs}, bucket int, hits long")


def _index(docs: DataFrame, counts: np.ndarray, boundary, percent, shingle, seed) -> DataFrame:
    """(token, set, at): a row for each key of each text's set; equal sets of a task's neighbouring
    rows once."""

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                found, known = [], set()
                for text in part.column("text").to_pylist():
                    values = tokens(text, shingle, seed)
                    name = set_hash(values, seed)
                    if len(values) and name not in known:
                        known.add(name)
                        keys, places = keys_of(values, counts, boundary, percent)
                        found.append((keys, np.full(len(keys), name, np.int64), places))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                        names=["token", "set", "at"])

    return docs.select("text").mapInArrow(run, "token long, `set` long, at int")


def _frequencies(read: DataFrame):
    """(hits per bucket, sets that the list of an average token holds)."""
    counts = np.zeros(BUCKETS, np.int64)
    for r in read.where("bucket IS NOT NULL").groupBy("bucket").agg(
            F.sum("hits").alias("hits")).collect():  # BUCKETS rows
        counts[r.bucket] = r.hits
    total = max(int(counts.sum()), 1)
    return counts, float(((counts - total / BUCKETS) ** 2).sum()) / total


def _members(index: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, set, at, n, sketch) of the tokens that two sets or more have. The index is by far the
    largest table, and is moved once."""
    of_token = Window.partitionBy("token")
    met = index.select("*", F.min("set").over(of_token).alias("a"),
                       F.max("set").over(of_token).alias("b")).where("a < b").select(
        *index.columns).distinct()
    return met.join(classes.drop("least", "clash"), "set")


def _lists(members: DataFrame, roots: DataFrame, degree: DataFrame, centers: int, scratch):
    """(members of the lists that hold unconnected sets, their centers): of each list the `centers`
    sets with the most links so far."""
    known = members.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    apart = known.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where(
        "a < b").select("token")
    left = scratch.keep(known.join(apart, "token", "left_semi").join(degree, "set", "left")
                        .fillna(0, ["links"]), "jaccard-lists")
    first = Window.partitionBy("token").orderBy(F.desc("links"), F.xxhash64("token", "set"), "set")
    chosen = left.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= centers)
    return left, scratch.keep(chosen.drop("rank", "links"), "jaccard-centers")


def _asked(classes: DataFrame, pairs: DataFrame) -> np.ndarray:
    """The filter of `FILTER_BITS` bits that the keys of the sets in `pairs` pass, and a few
    others."""
    asked = classes.join(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "set",
                         "left_semi").select(_bit("least").alias("bit"))
    words = asked.groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS INT))")).alias("bits")).collect()
    wanted = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:  # one per 64 bits at most
        wanted[r.word] = r.bits
    return np.unpackbits(wanted.view(np.uint8), bitorder="little").astype(bool)


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle, seed,
          sketched=False) -> DataFrame:
    """(set, n, tokens) of the sets in `pairs`, and of a few others; or (set, n, sketch) with the
    `LONG_SKETCH` longs of each.

    Texts are read again, not shuffled; both sides of a pair share one exchange of these sets. A
    filter tells each task which keys are asked for; a key it lets through in error costs its
    text's hashing.
    """
    wanted, column = _asked(classes, pairs), "sketch" if sketched else "tokens"

    def again(batches):
        for batch in batches:
            passed = wanted[batch.column("bit").to_numpy(zero_copy_only=False)]
            for part in parts(batch.filter(pa.array(passed)), "text"):
                found = [tokens(t, shingle, seed) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_hash(v, seed) for v in found], pa.int64()),
                     pa.array(list(map(len, found)), pa.int64()),
                     pa.array([parities(v, LONG_SKETCH) if sketched else v.view(np.int64)
                               for v in found], pa.list_(pa.int64()))],
                    names=["set", "n", column])

    return docs.select(_bit("key").alias("bit"), "text").mapInArrow(
        again, f"`set` long, n long, {column} array<long>").dropDuplicates(["set"])


def _near(pairs: DataFrame, sketches: DataFrame, percent) -> DataFrame:
    """The pairs (a, b) but those whose long sketches show that they do not link.

    Sketches are a fraction of a large set's size, so that most pairs are decided without moving
    the sets.
    """
    def side(name):
        return sketches.select(F.col("set").alias(name), F.col("n").alias(f"n_{name}"),
                               F.col("sketch").alias(f"of_{name}"))

    apart = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda total, bits: total + bits)
    both = F.col("n_a") + F.col("n_b")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        2 * percent * both <= (100 + percent) * (both - apart)).select("a", "b")


def _bit(key):
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def _linked(pairs: DataFrame, sets: DataFrame, percent) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection."""
    def side(name):
        return sets.select(F.col("set").alias(name), F.col("tokens").alias(f"of_{name}"))

    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return (pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", common)
            .where(100 * F.col("common") >= percent * union).select("a", "b"))


def linked_sets(docs: DataFrame, classes: DataFrame, counts, met, percent=PERCENT,
                shingle=SHINGLE, seed=SEED, boundary=None) -> DataFrame:
    """(set, root) of all sets with a link, root the same for all that links connect.

    `docs` has key and text, `classes` set, n and the key of one of its texts (least).
    """
    if boundary is None:
        small = classes.where(F.col("n") <= largest_partner(LARGEST_LIGHT, percent)).groupBy(
            "n").count().collect()
        boundary = choose_boundary({r.n: r["count"] for r in small}, met, percent)
    scratch = _Scratch(docs.sparkSession)
    index = scratch.keep(_index(docs, counts, boundary, percent, shingle, seed), "jaccard-index")
    members = scratch.keep(_members(index, classes), "jaccard-members")
    scratch.empty(but=[1])

    columns, sketch = members.columns, [f"p{i}" for i in range(SKETCH)]
    spark, centers = docs.sparkSession, CENTERS
    links = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "`set` long, root long")
    while True:
        degree = links.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").agg(
            F.count("*").alias("links"))
        left, chosen = _lists(members, roots, degree, centers, scratch)
        center = chosen.select("token", *[F.col(c).alias(f"c_{c}")
                                          for c in ("set", "at", "n", "root", *sketch)])
        # what lies before the first token in common is not shared
        overlap = F.least(F.col("n") - F.col("at"), F.col("c_n") - F.col("c_at"))
        apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"c_{c}"))) for c in sketch), F.lit(0))
        both = F.col("n") + F.col("c_n")
        pairs = left.join(center, "token").where(
            (F.col("root") != F.col("c_root")) & ((100 + percent) * overlap >= percent * both)
            & (2 * percent * both <= (100 + percent) * (both - apart))).select(
            F.least("set", "c_set").alias("a"), F.greatest("set", "c_set").alias("b")).distinct()
        pairs = scratch.keep(pairs, "jaccard-pairs")
        near = scratch.keep(_near(pairs, _sets(docs, classes, pairs, shingle, seed, sketched=True),
                                  percent), "jaccard-near")
        found = cut_lineage(_linked(near, _sets(docs, classes, near, shingle, seed), percent),
                            "jaccard-links")
        members = scratch.keep(left.join(chosen.select("token", "set"), ["token", "set"],
                                         "left_anti").select(*columns), "jaccard-members")
        scratch.empty(but=[1])
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = components(links).withColumnRenamed("node", "set")
        if members.isEmpty():
            return roots
        centers = MORE_CENTERS if centers == CENTERS else centers * GROWTH


def join(df: DataFrame, key="doc_id", text="text", percent=PERCENT, shingle=SHINGLE, seed=SEED,
         boundary=None) -> DataFrame:
    """`key`, n_shingles and component_id, the smallest key among all rows that links connect, of
    every row.

    A text without words (null, empty, blank) has an empty set, which links with nothing: its
    component is its own key. Texts with equal sets link. Repeated rows stay. A null key is a
    component's id only if no row of the component has a key. An empty table gives no rows. Other
    columns are ignored. `boundary` fixes the largest light size instead of choosing it by cost;
    the result is the same.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    reachable(df.sparkSession)
    read = cut_lineage(_read(docs, shingle, seed), "jaccard-read")
    rows = read.where("bucket IS NULL")
    counts, met = _frequencies(read)
    classes = cut_lineage(rows.where("n > 0").groupBy("set").agg(
        F.min("key").alias("least"), F.min("n").alias("n"),
        *[F.min(f"p{i}").alias(f"p{i}") for i in range(SKETCH)],
        (F.min("check") < F.max("check")).alias("clash")), "jaccard-classes")
    if not classes.where("clash").isEmpty():
        raise ValueError("two different sets have one hash: choose another seed")
    roots = cut_lineage(
        linked_sets(docs, classes, counts, met, percent, shingle, seed, boundary)
        .join(classes.select("set", "least"), "set"), "jaccard-roots")
    least = roots.groupBy("root").agg(F.min("least").alias("all_least"))
    component = cut_lineage(
        classes.select("set", "least").join(
            roots.join(cut_lineage(least, "jaccard-least"), "root").select("set", "all_least"),
            "set", "left")
        .select("set", F.coalesce("all_least", "least").alias("component_id")),
        "jaccard-components")
    linked = rows.where("n > 0").join(component, "set").select("key", "n", "component_id")
    alone = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(F.col("key").alias(key),
                                            F.col("n").alias("n_shingles"), "component_id")
