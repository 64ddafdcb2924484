import numpy as np
import pytest
import xxhash

from orderloom.llm import graph, simhash
from orderloom.llm.queries import op7_simhash_bk_trees
from orderloom.llm.text import table

SF = "/root/testdata/sf0.01"


def test_fingerprint_bit_by_bit():
    words = "The quick brown fox jumps over The lazy dog".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(7)]
    expected = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 7)
    assert simhash.fingerprint("The quick\n brown fox jumps over The lazy dog ") == expected
    assert simhash.fingerprint("One two") == xxhash.xxh64_intdigest("one two", 42)
    assert simhash.fingerprint(" ") == simhash.fingerprint(None) == 0


def _codes(seed, groups, size, flips):
    rng = np.random.default_rng(seed)
    codes = {0}
    for base in rng.integers(0, 2**64, groups, dtype=np.uint64):
        for _ in range(size):
            code = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, flips + 1)):
                code ^= 1 << int(bit)
            codes.add(code)
    return np.array(sorted(codes), dtype=np.uint64)


def _labels(codes, radius):
    labels = np.arange(len(codes))
    for i in range(len(codes)):
        near = np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= radius)
        labels = simhash.unite(labels, np.full(len(near), i), near)
    return labels


def _same_groups(found, codes, radius):
    expected = {}
    for code, label in zip(codes.tolist(), _labels(codes, radius).tolist(), strict=True):
        expected.setdefault(label, set()).add(code)
    groups = {}
    for code, root in found:
        groups.setdefault(root, set()).add(code % 2**64)
    return sorted(map(sorted, groups.values())) == sorted(
        sorted(g) for g in expected.values() if len(g) > 1)


def test_searches_find_all_within_the_radius():
    codes = _codes(1, 12, 30, 8)
    forest = simhash.Forest(codes, np.zeros(len(codes), dtype=int))
    for radius in (0, 1, 2, 5):
        found = {(int(q), int(n)) for a, b in forest.search(
            codes, np.zeros(len(codes), dtype=int), radius) for q, n in zip(a, b, strict=True)}
        assert found == {(i, j) for i in range(len(codes)) for j in range(len(codes))
                         if bin(int(codes[i] ^ codes[j])).count("1") <= radius}


@pytest.mark.parametrize("tree, block", [(4096, 4096), (16, 4096), (4096, 16), (16, 10)])
def test_groups_do_not_depend_on_trees_and_blocks(spark, monkeypatch, tree, block):
    monkeypatch.setattr(simhash, "TREE", tree)
    monkeypatch.setattr(simhash, "BLOCK", block)
    codes = _codes(2, 8, 60, 6)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    found = [tuple(r) for r in simhash.linked(frame, 2).collect()]
    assert _same_groups(found, codes, 2)


def test_components_of_paths_and_stars(spark, rng):
    edges, groups = [], []
    for base in (0, 1000, 2000):
        nodes = [base + i for i in range(70)]
        rng.shuffle(nodes)
        groups.append(min(nodes))
        edges += zip(nodes, nodes[1:], strict=False) if base else [(nodes[0], n) for n in nodes]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(b + i, b) for b in groups for i in range(70)]


def test_component_ids(docs):
    text = " ".join(f"w{i}" for i in range(400))
    rows = docs([(9, text), (3, text), (3, text), (5, text + " tail"), (7, "other words here"),
                 (8, None), (2, ""), (None, "alone with no id")])
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).collect()}
    near = bin(simhash.fingerprint(text) ^ simhash.fingerprint(text + " tail")).count("1") <= 2
    assert found == {(9, 3), (3, 3), (5, 3 if near else 5), (7, 7), (8, 2), (2, 2), (None, None)}


def test_one_of_each_component_stays(docs):
    rows = docs([(9, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"),
                 (None, "x y z"), (4, "p q r")])
    kept = simhash.keep_one(rows).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [
        (0, "x y z"), (3, "a b c d"), (4, "p q r")]


def test_other_columns_keep_their_types(spark):
    rows = spark.sql("SELECT 1L AS doc_id, 'a b' AS text, TIMESTAMP '2026-01-01 00:00:00' AS at, "
                     "DATE '2026-01-02' AS day, 1.50BD AS price, array(1, 2) AS list")
    (kept,) = simhash.keep_one(rows).collect()
    assert kept == rows.first()


def test_query_against_all_pairs(spark):
    texts = dict(map(tuple, table(spark, SF, "documents").select("doc_id", "text").collect()))
    prints = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[j:j + 3]), 42)
                  for j in range(max(1, len(words) - 2))] if words else []
        prints[i] = sum(1 << b for b in range(64)
                        if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = np.array(sorted(texts))
    codes = np.array([prints[i] for i in ids.tolist()], dtype=np.uint64)
    smallest = ids[_labels(codes, 2)]
    found = {r.doc_id: (r.fingerprint, r.component_id)
             for r in op7_simhash_bk_trees(spark, SF).collect()}
    assert found == {i: (f"{prints[i]:016x}", least)
                     for i, least in zip(ids.tolist(), smallest.tolist(), strict=True)}
    assert len(set(smallest.tolist())) < len(ids)
