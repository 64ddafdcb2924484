"""The Merkle manifest against plain Python, level by level."""

import itertools

import pytest
from pyspark.sql import functions as F

from orderloom.llm import merkle
from orderloom.llm.merkle import digest


def plain_tree(values, fanout=2):
    """(root, proof of every leaf as a list of sibling lists) without queues or sweeps."""
    proofs, below = [[] for _ in values], [[i] for i in range(len(values))]
    while len(values) > 1:
        runs = [list(range(i, min(i + fanout, len(values))))
                for i in range(0, len(values), fanout)]
        for run in runs:
            for i in run:
                for leaf in below[i]:
                    proofs[leaf] += [(values[j], j < i) for j in run if j != i]
                    proofs[leaf].append(None)
        below = [list(itertools.chain(*(below[i] for i in run))) for run in runs]
        values = [digest("".join(values[i] for i in run)) for run in runs]
    return values[0], proofs


@pytest.mark.parametrize("fanout", [2, 3, 5])
@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 8, 9, 27, 28, 100])
def test_sweeps(count, fanout):
    leaves = [digest(str(i)) for i in range(count)]
    height = merkle.levels(count, fanout)
    root, children = merkle.rise(leaves, height, fanout)
    expected, proofs = plain_tree(leaves, fanout)
    assert root == expected
    found = merkle.descend(children, count, height, "", fanout)
    for leaf, proof, plain in zip(leaves, found, proofs, strict=True):
        assert merkle.fold(leaf, proof) == root
        assert proof.replace(":", "").replace(";", "") == "".join(
            s[0] for s in plain if s is not None)


def test_a_subtree_of_a_larger_tree_is_as_high_as_its_band():
    """The last subtree of a band may hold one leaf, which is still hashed at every level."""
    value, _ = merkle.rise(["a"], 3)
    assert value == digest(digest(digest("a")))
    assert merkle.rise(["a"], 0)[0] == "a"


def leaves_of(spark, rows):
    return spark.createDataFrame(
        [(k, g, digest(v), digest(c)) for k, g, v, c in rows],
        "doc_id long, lang string, leaf string, claimed string")


@pytest.mark.parametrize("fanout, band", [(2, 1), (2, 2), (3, 2), (2, 7)])
def test_manifest_equals_plain_trees(spark, fanout, band):
    rows = [(i, lang, f"{lang}{i}", "x" if i % 5 == 0 else f"{lang}{i}")
            for lang, n in (("en", 41), ("de", 1), (None, 9), ("é", 16), ("", 2))
            for i in range(n)]
    found = {(r.leaf): r for r in merkle.manifest(
        leaves_of(spark, rows), fanout=fanout, band=band).collect()}
    assert len(found) == len(rows)
    names = [None, "", "de", "en", "é"]
    trees = {g: plain_tree([digest(v) for k, h, v, _ in rows if h == g], fanout) for g in names}
    root, above = plain_tree([trees[g][0] for g in names], fanout)
    for k, g, v, c in rows:
        r, subroot = found[digest(v)], trees[g][0]
        steps = trees[g][1][k] + above[names.index(g)]
        assert (r.subroot, r.root) == (subroot, root)
        assert r.proof.replace(":", "").replace(";", "") == "".join(
            s[0] for s in steps if s is not None)
        assert r.verified == (c == v) and (r.folded_root == root) == (c == v)


def test_repeated_rows_null_keys_and_clashing_columns(spark):
    rows = [(1, "a", "v", "v"), (1, "a", "v", "v"), (None, "a", "n", "n"), (2, None, "w", "w")]
    odd = leaves_of(spark, rows).selectExpr("*", "1 AS place", "'p' AS proof", "2 AS key",
                                            "3 AS tree", "4 AS `group`")
    found = merkle.manifest(odd).collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 1, 1, 2]
    subroot = digest(digest(digest("n") + digest("v")) + digest(digest("v")))
    assert {r.subroot for r in found if r.leaf != digest("w")} == {subroot}
    assert {r.root for r in found} == {digest(digest("w") + subroot)}
    assert all(r.verified for r in found)


def test_no_rows(spark):
    assert merkle.manifest(leaves_of(spark, [])).collect() == []


def test_place(spark):
    rows = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, id % 3) AS g", "id")
    for r in merkle.placed(rows, "g", ["id"]).collect():
        assert r.place == r.id // 3 and r["count"] == (334 if r.g is None else 333)


def test_leaf_of_a_document(spark, odd, docs):
    one = docs([(5, "é\n", "de")])
    r = merkle.document_leaves(one).first()
    assert r.leaf == digest("1:51:s2:de1:23:é\n")
    tampered = docs([(i, "t") for i in range(200)])
    import zlib
    for r in merkle.document_leaves(tampered).collect():
        assert (r.leaf != r.claimed) == (zlib.crc32(str(r.doc_id).encode()) % 7 == 0)
    found = merkle.manifest(merkle.document_leaves(odd)).collect()
    assert len(found) == odd.count()
    assert merkle.document_leaves(odd.where(F.col("text").isNull())).count() == 3
