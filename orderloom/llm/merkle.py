"""Merkle manifest of a data set by time-forward processing.

Every row is a leaf. The leaves of a group stand in the order of their key; runs of `fanout`
consecutive nodes are hashed together until one is left, the group's root; the roots of the groups,
in the order of their names, are hashed together in the same way.

A node's label is the place of the last leaf below it and its level, so children come before their
parents. Time-forward processing visits the nodes by label: each sends its digest to its parent
through a priority queue ordered by label, and a node finds its children's messages at the head of
the queue when its turn comes. A reversed sweep, from the largest label down, sends every child the
rest of its proof: the digests it lacks on its way to the root.

The queue is external. Between bands of `BAND` levels Spark's shuffle is the queue: it sorts
messages by tree and subtree, on disk where need be. Within a band it is a heap that never holds more
than the messages of one subtree of `fanout ** BAND` leaves. So no task holds a whole group,
whatever its size. Every band is written to the shared folder.
"""

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.text import reachable
from orderloom.session import cut_lineage

FANOUT = 2
#: Levels of a subtree that a task processes at a time.
BAND = 7
#: An audit tampers with rows whose key has a CRC-32 divisible by this.
TAMPERED = 7

_NODES = "tree long, place long, count long, value string"
_MESSAGES = "tree long, place long, value string, proof string, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(count: int, fanout: int = FANOUT) -> int:
    """How often `count` nodes are hashed together until one is left."""
    n = 0
    while count > 1:
        count, n = -(-count // fanout), n + 1
    return n


def rise(leaves, height, fanout=FANOUT):
    """Forward sweep over the digests `leaves` of a subtree of `height` levels: the digest of its
    root, and for every inner node (level, place) the digests of its children."""
    queue, children, value = [], {}, leaves[0]

    def send(level, place, value):  # to the parent, at its label
        above = place // fanout
        last = min((above + 1) * fanout ** (level + 1), len(leaves)) - 1
        heapq.heappush(queue, (last, level + 1, above, place, value))

    for last, leaf in enumerate(leaves if height else ()):
        send(0, last, leaf)
        while queue and queue[0][0] == last:  # a node's turn
            _, level, place, *_ = queue[0]
            run = []
            while queue and queue[0][:3] == (last, level, place):
                run.append(heapq.heappop(queue)[4])
            children[level, place] = run
            value = digest("".join(run))
            if level < height:
                send(level, place, value)
    return value, children


def descend(children, count, height, proof, fanout=FANOUT):
    """Reversed sweep: the proofs of `count` leaves from the `proof` of their subtree's root.

    A proof is a step `left:right;` for every level upwards, with the digests of the siblings on
    either side, so that it folds without the place of the leaf.
    """
    queue, proofs = [(1 - count, -height, 0, proof)], [""] * count
    while queue:
        _, level, place, rest = heapq.heappop(queue)
        if level == 0:
            proofs[place] = rest
            continue
        run, below = children[-level, place], -level - 1
        for i in range(len(run)):
            child = place * fanout + i
            last = min((child + 1) * fanout ** below, count) - 1
            step = f"{''.join(run[:i])}:{''.join(run[i + 1:])};"
            heapq.heappush(queue, (-last, -below, child, step + rest))
    return proofs


def fold(value: str, proof: str) -> str:
    """The root that a leaf's digest and its proof lead to."""
    for step in proof.split(";")[:-1]:
        left, right = step.split(":")
        value = digest(left + value + right)
    return value


def proof_digest(proof) -> Column:
    """The hash of all digests of a proof, one after another."""
    return F.sha2(F.regexp_replace(proof, "[:;]", ""), 256)


def leaf_digest(*columns: Column) -> Column:
    """Of each value its byte count, a colon and the value, `-` for null, hashed together."""
    fields = []
    for column in columns:
        text = column.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                 F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def placed(rows: DataFrame, group: str, order) -> DataFrame:
    """`rows` with `place`, the row's number in its group along `order` (null first, repeated rows
    in any order), and `count`, the group's size. Null is a group like any other.

    The rows are sorted over all tasks and written with the number of their task, so that a group
    of any size is spread evenly; what earlier tasks hold of a group is added up from one row per
    task and group.
    """
    held = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    by = [group, *order, "row"]
    sorted_rows = cut_lineage(
        held.repartitionByRange(*by).sortWithinPartitions(*by).drop("row")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33)), "merkle-sorted")
    per_part = sorted_rows.groupBy("part", F.col(group).alias("of")).agg(
        F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(per_part.select(
        F.col("part").alias("in_part"), "of",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"),
        F.sum("n").over(Window.partitionBy("of")).alias("count")), "merkle-starts")
    here = (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("of"))
    return sorted_rows.join(starts, here).select(
        *rows.columns, (F.col("at") + F.col("start")).alias("place"), "count")


def _by_subtree(rows: DataFrame, size: int):
    return rows.withColumn("subtree", F.expr(f"place div {size}")).groupBy("tree", "subtree")


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("place")


def _bands_up(nodes: DataFrame, largest: int, fanout: int, band: int) -> list:
    """`nodes` and the nodes above them, band by band, up to one per tree."""
    size, bands = fanout ** band, [nodes]

    def up(table):
        table = _ordered(table)
        count = table["count"][0].as_py()
        value, _ = rise(table["value"].to_pylist(), min(band, levels(count, fanout)), fanout)
        return pa.table({
            "tree": table["tree"][:1], "place": [table["place"][0].as_py() // size],
            "count": [-(-count // size)], "value": [value]})

    while largest > 1:
        bands.append(cut_lineage(_by_subtree(
            bands[-1].select("tree", "place", "count", "value"), size)
            .applyInArrow(up, _NODES), "merkle-band"))
        largest = -(-largest // size)
    return bands


def _down(nodes: DataFrame, messages: DataFrame, fanout: int, band: int, made, schema):
    """Hands the proof of every subtree of `nodes` (which the message for its root holds) on to its
    nodes; `made(nodes, proofs, message)` gives the columns of the result."""
    size = fanout ** band

    def down(table, message):
        table = _ordered(table)
        height = min(band, levels(table["count"][0].as_py(), fanout))
        _, children = rise(table["value"].to_pylist(), height, fanout)
        note = message.to_pylist()[0]
        return pa.table(made(table, descend(children, len(table), height, note["proof"], fanout),
                             note))

    above = messages.withColumn("subtree", F.col("place")).groupBy("tree", "subtree")
    return _by_subtree(nodes, size).cogroup(above).applyInArrow(down, schema)


def _passed_on(table, proofs, note):
    return {"tree": table["tree"], "place": table["place"], "value": table["value"],
            "proof": proofs, "subroot": [note["subroot"]] * len(table),
            "root": [note["root"]] * len(table)}


def manifest(leaves: DataFrame, key="doc_id", group="lang", value="leaf", claimed="claimed",
             fanout=FANOUT, band=BAND) -> DataFrame:
    """(key, leaf, subroot, root, proof, folded_root, verified) of every row of `leaves`.

    `value` is a leaf's digest; `claimed` the digest that an audit recomputes from the row it was
    given. `folded_root` is what the claimed digest and the proof lead to, `verified` whether that is
    the root. Rows without group are a group of their own, the first; a row without key stands first
    in its group; repeated rows are leaves of their own. An empty table gives no rows. Other
    columns are ignored.
    """
    reachable(leaves.sparkSession)
    rows = placed(leaves.select(F.col(key).alias("key"), F.col(group).alias("group"),
                                F.col(value).alias("value"), F.col(claimed).alias("claimed")),
                  "group", ["key", "value"])
    rows = cut_lineage(rows, "merkle-placed")
    groups = placed(rows.groupBy("group").agg(F.first("count").alias("leaves"))
                    .withColumn("all", F.lit(0)), "all", ["group"])
    groups = cut_lineage(groups.select(F.col("group").alias("of"), F.col("place").alias("tree"),
                                       F.col("count").alias("trees"), "leaves"), "merkle-groups")
    largest, trees = (n or 0 for n in groups.agg(F.max("leaves"), F.max("trees")).first())
    nodes = cut_lineage(rows.join(groups, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", "place", "count", "value", "key", "claimed"), "merkle-leaves")

    bands = _bands_up(nodes, largest, fanout, band)
    subroots = bands[-1].select("tree", "value").join(groups.select("tree", "trees"), "tree")
    top = _bands_up(cut_lineage(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"),
        F.col("trees").alias("count"), "value"), "merkle-band"), trees, fanout, band)

    none = F.lit("")
    messages = top[-1].select("tree", "place", "value", none.alias("proof"), none.alias("subroot"),
                              F.col("value").alias("root"))
    for nodes_below in reversed(top[:-1]):
        messages = cut_lineage(_down(nodes_below, messages, fanout, band, _passed_on, _MESSAGES),
                               "merkle-proofs")
    messages = messages.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"),
                               "value", "proof", F.col("value").alias("subroot"), "root")
    for nodes_below in reversed(bands[1:-1]):
        messages = cut_lineage(_down(nodes_below, messages, fanout, band, _passed_on, _MESSAGES),
                               "merkle-proofs")

    def proven(table, proofs, note):
        folded = [fold(*pair) for pair in zip(table["claimed"].to_pylist(), proofs, strict=True)]
        root = note["root"]
        return {"key": table["key"], "leaf": table["value"],
                "subroot": [note["subroot"]] * len(table), "root": [root] * len(table),
                "proof": proofs, "folded_root": folded, "verified": [f == root for f in folded]}

    kind = leaves.schema[key].dataType.simpleString()
    schema = (f"key {kind}, leaf string, subroot string, root string, proof string, "
              "folded_root string, verified boolean")
    return _down(nodes, messages, fanout, band, proven, schema).withColumnRenamed("key", key)


def document_leaves(docs: DataFrame, tampered=TAMPERED) -> DataFrame:
    """(doc_id, lang, leaf, claimed) of the documents table: `claimed` is the digest of the row as an
    audit finds it, with 1 added to n_chars where `tampered` divides the CRC-32 of the id."""
    def leaf(n_chars):
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    hit = F.crc32(F.col("doc_id").cast("string")) % tampered == 0
    n_chars = F.col("n_chars").cast("decimal(38,0)")
    return docs.select("doc_id", "lang", leaf(n_chars).alias("leaf"),
                       leaf(F.when(hit, n_chars + 1).otherwise(n_chars)).alias("claimed"))
