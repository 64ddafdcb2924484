"""SimHash near-duplicates, found with BK-trees.

Fingerprints that differ in at most `radius` bits agree in one of radius + 1 bands of bits, so
all fingerprints with the same band value form a shard, and only they are compared. A shard's
fingerprints stand in BK-trees: a child hangs at the Hamming distance to its parent, and a search
follows only the edges within the radius of its own distance to the node. Trees hold a bounded
number of fingerprints; a larger shard has several, and each meets the shard's searches in blocks.

Trees and searches meet by a shuffle on (shard, tree, block). They are not broadcast, since their
number grows with the documents.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.llm.text import map_texts, reachable
from orderloom.session import cut_lineage

BITS = 64
SEED = 42
#: Words of a shingle, and bits in which linked fingerprints may differ.
SHINGLE = 3
RADIUS = 2
#: Fingerprints per tree, and searches per block.
TREE = 4096
BLOCK = 4096

_PAIRS = 1 << 21  # searches times tree nodes at a time
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle=SHINGLE) -> int:
    """Bit by bit the majority of the hashes of the text's shingles; zero without words."""
    words = (text or "").encode().translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[shingle - 1:]
    count, set_bits = len(ends), np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, 1 << 15):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[low:low + (1 << 15)], ends[low:low + (1 << 15)], strict=False)],
            dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > count).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, keep=("doc_id",), text="text", shingle=SHINGLE,
                 name="fp") -> DataFrame:
    """`keep` and the fingerprint of every whole text, as a signed long."""
    return map_texts(df, lambda texts: [[_signed(fingerprint(t, shingle)) for t in texts]],
                     f"`{name}` long", keep, text)


class Forest:
    """BK-trees over fingerprints, one for each value of `tree_of`; equal values stand together,
    and each tree's fingerprints differ."""

    def __init__(self, codes: np.ndarray, tree_of: np.ndarray):
        self.codes = codes
        new = np.ones(len(codes), dtype=bool)
        new[1:] = tree_of[1:] != tree_of[:-1]
        self.trees, self.roots = tree_of[new], np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.roots, len(codes)))
        at = np.repeat(self.roots, self.sizes)
        going = np.flatnonzero(~new)
        keys, children = [], []
        while len(going):  # one level of all trees
            edge = at[going] * (BITS + 1) + _distance(codes[going], codes[at[going]])
            here, first, which = np.unique(edge, return_index=True, return_inverse=True)
            child = going[first]
            keys.append(here)
            children.append(child)
            at[going] = child[which]
            stays = np.ones(len(going), dtype=bool)
            stays[first] = False
            going = going[stays]
        keys = np.concatenate([np.empty(0, np.int64), *keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.children = np.concatenate([np.empty(0, np.int64), *children])[order]

    def search(self, codes: np.ndarray, tree_of: np.ndarray, radius: int):
        """Pairs (search, node) within the radius, in portions of bounded size."""
        tree = np.searchsorted(self.trees, tree_of)
        tree[tree == len(self.trees)] = 0
        found = np.flatnonzero(self.trees[tree] == tree_of) if len(self.trees) else tree[:0]
        portion = np.cumsum(self.sizes[tree[found]]) // _PAIRS
        for wanted in np.split(found, np.flatnonzero(np.diff(portion)) + 1):
            query, node = wanted, self.roots[tree[wanted]]
            while len(query):
                distance = _distance(codes[query], self.codes[node])
                near = distance <= radius
                yield query[near], node[near]
                base = node * (BITS + 1)
                low = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0))
                high = np.searchsorted(
                    self.keys, base + np.minimum(distance + radius, BITS), side="right")
                count = high - low
                query = np.repeat(query, count)
                skipped = np.repeat(low - np.cumsum(count) + count, count)
                node = self.children[np.arange(len(query)) + skipped]


def _distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int64)


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each node's smallest known relative) after joining the nodes `a` with `b`."""
    while len(a):
        left, right = labels[a], labels[b]
        apart = left != right
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(labels, left, right)
        np.minimum.at(labels, right, left)
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels = further
    return labels


def link_units(unit: np.ndarray, roles: np.ndarray, codes: np.ndarray, radius: int):
    """Edges that join what lies within the radius, for whole units in ascending order: rows with
    role bit 1 form a unit's tree, rows with role bit 2 search it. Of the links inside a unit it
    returns a spanning star for each connected group."""
    in_tree, searching = np.flatnonzero(roles & 1), np.flatnonzero(roles & 2)
    forest = Forest(codes[in_tree], unit[in_tree])
    labels = np.arange(len(codes))
    for query, node in forest.search(codes[searching], unit[searching], radius):
        labels = unite(labels, searching[query], in_tree[node])
    moved = np.flatnonzero((labels != np.arange(len(codes))) & (codes != codes[labels]))
    return codes[moved], codes[labels[moved]]


def units(codes: DataFrame, radius: int) -> DataFrame:
    """(shard, tree, block, role, fp): what has to meet, of all shards with two fingerprints or
    more. A shard that fits into one tree and one block has a row per fingerprint; in a larger
    one a fingerprint stands in its tree once for each block, and searches once in each tree."""
    bands, low = [], 0
    for i in range(radius + 1):
        high = BITS * (i + 1) // (radius + 1)
        value = F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1)
        bands.append(F.shiftleft(value, 3).bitwiseOR(i) if high - low < 60 else value)
        low = high
    members = codes.select("fp", F.explode(F.array(*bands)).alias("shard"))
    crowded = cut_lineage(members.groupBy("shard").agg(F.count("*").alias("n"))
                          .where("n > 1"), "simhash-shards")
    placed = members.join(crowded, "shard").select(
        "shard", "fp", F.ceil(F.col("n") / TREE).cast("int").alias("trees"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.xxhash64("fp").alias("hash"))
    tree = F.pmod("hash", "trees").cast("int")
    block = F.pmod(F.shiftright("hash", 20), F.col("blocks")).cast("int")

    def roles(tree, block, role):
        return F.struct(tree.alias("tree"), block.alias("block"), F.lit(role).alias("role"))

    small = (F.col("trees") == 1) & (F.col("blocks") == 1)
    meets = F.when(small, F.array(roles(F.lit(0), F.lit(0), 3))).otherwise(F.concat(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: roles(tree, b, 1)),
        F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda t: roles(t, block, 2))))
    return placed.select("shard", "fp", F.inline(meets))


def linked(codes: DataFrame, radius=RADIUS) -> DataFrame:
    """(fp, root) of the different fingerprints `codes` (column fp) that have a link: root is
    the same for all that links connect."""
    reachable(codes.sparkSession)

    def run(batches):
        rest = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
            new = _changes(columns[:3])
            whole = int(np.flatnonzero(new)[-1]) if len(new) else 0
            rest = [c[whole:] for c in columns]
            if whole:
                yield edges([c[:whole] for c in columns])
        if rest is not None and len(rest[0]):
            yield edges(rest)

    def edges(columns):
        unit = np.cumsum(_changes(columns[:3]))
        a, b = link_units(unit, columns[3], columns[4].astype(np.int64).view(np.uint64), radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    meeting = (units(codes, radius).select("shard", "tree", "block", "role", "fp")
               .repartition("shard", "tree", "block")
               .sortWithinPartitions("shard", "tree", "block"))
    found = components(meeting.mapInArrow(run, "a long, b long"))
    return found.select(F.col("node").alias("fp"), "root")


def _changes(columns) -> np.ndarray:
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def near_duplicates(df: DataFrame, key="doc_id", text="text", shingle=SHINGLE,
                    radius=RADIUS) -> DataFrame:
    """`key`, fingerprint (16 hexadecimal digits) and component_id, the smallest key among all
    rows that links connect, of every row.

    Texts without words (null, empty, blank) have fingerprint zero and are linked like any
    other. Repeated rows stay. A null key is never a component's id, unless the whole component
    has none. An empty table gives no rows. Other columns are ignored.
    """
    rows = cut_lineage(fingerprints(df, [key], text, shingle), "simhash")
    codes = cut_lineage(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-codes")
    roots = cut_lineage(linked(codes.select("fp"), radius).join(codes, "fp"), "simhash-roots")
    least = cut_lineage(roots.groupBy("root").agg(F.min("least").alias("all_least")),
                        "simhash-least")
    joined = roots.join(least, "root").select("fp", "all_least")
    component = cut_lineage(
        codes.join(joined, "fp", "left")
        .select("fp", F.coalesce("all_least", "least").alias("component_id")),
        "simhash-components")
    return rows.join(component, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key="doc_id", text="text", shingle=SHINGLE,
             radius=RADIUS) -> DataFrame:
    """One row of each component of `df`, with all its columns: that with the smallest key (a
    null key comes last); of rows that repeat it, any one."""
    spare = "_" * (1 + max(map(len, df.columns)))  # no column is called so
    fp, row, columns = f"{spare}fp", f"{spare}row", df.columns
    rows = cut_lineage(fingerprints(df, columns, text, shingle, fp)
                       .withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    best = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("key"),
                          F.col(row).alias("row"))).alias("best")
    codes = cut_lineage(rows.groupBy(F.col(fp).alias("fp")).agg(best), "simhash-codes")
    roots = linked(codes.select("fp"), radius)
    kept = (codes.join(roots, "fp", "left")
            .groupBy(F.coalesce("root", "fp")).agg(F.min("best").alias("best"))
            .select(F.col("best.row").alias(row)))
    return rows.join(kept, row, "left_semi").select(*(f"`{c}`" for c in columns))
