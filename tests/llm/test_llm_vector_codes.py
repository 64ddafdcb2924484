"""Vector codes and their trees against plain loops over all entries."""

import math

import numpy as np
import pytest

from orderloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_nearest(query, entries):
    """(squared distance, index), ties to the lower index."""
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(query, e, strict=True)), i)
               for i, e in enumerate(entries))


@pytest.mark.parametrize("splits, leaf", [(2, 1), (3, 2), (6, 4), (64, 4)])
@pytest.mark.parametrize("spread", [1, 3, 100, vc.LARGEST])
def test_tree_finds_what_a_scan_finds(splits, leaf, spread):
    rng = np.random.default_rng(spread + splits)
    entries = rng.integers(-spread, spread + 1, (64, 4))  # with many equal ones for small spreads
    tree = vc.Gnat(entries, splits=splits, leaf=leaf)
    queries = np.concatenate([rng.integers(-spread, spread + 1, (300, 4)), entries])
    best, far, _ = tree.nearest(queries)
    for q, i, d in zip(queries, best, far, strict=True):
        assert (d, i) == plain_nearest(q, entries)


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(1)
    entries = rng.integers(-500, 500, (64, 2))
    queries = rng.integers(-500, 500, (500, 2))
    *_, asked = vc.Gnat(entries).nearest(queries)
    assert asked < 0.6 * 64 * 500


def test_roots_round_to_the_safe_side():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, 10, 2 ** 60, 2 ** 60 - 1, (2 ** 30 - 1) ** 2])
    for s, low, high in zip(squares.tolist(), vc._floor_root(squares), vc._ceil_root(squares),
                            strict=True):
        assert low == math.isqrt(s) and high == math.isqrt(s) + (math.isqrt(s) ** 2 < s)


def plain_codes(rows, parts, entries, rounds=vc.ROUNDS):
    kept = [(k, [math.floor(256 * float(np.float32(x))) for x in v], label) for k, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts

    def cut(v):
        return [v[p * width:(p + 1) * width] for p in range(parts)]

    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    for _ in range(rounds):
        near = [[plain_nearest(cut(v)[p], books[p])[1] for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), at in zip(kept, near[p], strict=True) if at == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, by_label = [], {}
    for k, v, label in kept:
        found = [plain_nearest(piece, books[p]) for p, piece in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((k, "".join(f"{i:02x}" for _, i in found), error, label))
    digest = vc.codebooks_digest(np.array(books))
    return sorted(((k, c, e, by_label[label], digest) for k, c, e, label in out), key=str)


def rows_of(count, size, rng):
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, size)],
             None if i % 5 == 0 else i % 3) for i in range(count)]
    return rows + [(1000, None, 1), (1001, [float("nan")] * size, 1), (1002, [None] * size, 2),
                   (1003, [float("inf")] + [0.0] * (size - 1), 1)]


@pytest.mark.parametrize("count, entries", [(60, 8), (5, 8)])
def test_codes_equal_plain_loops(spark, count, entries):
    rows = rows_of(count, 12, np.random.default_rng(count))
    rows += rows[:2] + [(None, rows[0][1], 7)]  # repeated rows and a null key
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS code", "3 AS error")
    found = vc.compress(df.repartition(5), parts=4, entries=entries).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_codes(rows, 4, entries)


def test_decode(spark):
    rows = rows_of(30, 8, np.random.default_rng(3))
    vectors = vc.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    books = vc.fit(vectors, 2, 4)
    for r in vc.encode(vectors, books).collect():
        v = [math.floor(256 * x) for x in rows[r.key][1]]
        assert int(((np.array(v) - vc.decode(r.code, books)) ** 2).sum()) == r.error


def test_no_rows_and_wrong_lengths(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    uneven = spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 15, 1)], SCHEMA)
    with pytest.raises(Exception, match="lengths"):
        vc.compress(uneven).collect()
