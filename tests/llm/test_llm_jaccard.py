"""The size-aware Jaccard join against all pairs."""

import itertools
import random

import pytest

from orderloom.llm import jaccard


def shingles(text, size=jaccard.SHINGLE):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, percent=jaccard.PERCENT):
    """(doc_id, number of shingles, component) of rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    linked = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        before = dict(least)
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return sorted((i, len(sets[i]), least[i]) for i in sets)


def corpus(seed, sizes, copies, vocabulary=60):
    """Texts of the given sizes, each with variants in which a few words change."""
    rng, texts = random.Random(seed), []
    for size in sizes:
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(copies):
            other = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                spot, how = rng.randrange(len(other)), rng.randrange(3)
                if how == 0:
                    other[spot] = f"x{rng.randrange(9)}"
                elif how == 1:
                    other.insert(spot, f"y{rng.randrange(9)}")
                elif len(other) > 1:
                    del other[spot]
            texts.append(" ".join(other).upper() if rng.random() < 0.2 else " ".join(other))
    rng.shuffle(texts)
    return list(enumerate(texts))


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("boundary", [None, 0, 12, 22])
def test_equals_all_pairs_at_any_boundary(docs, boundary):
    rows = corpus(1, [1, 2, 3, 4, 8, 11, 12, 13, 14, 20, 21, 23, 24, 30, 40, 60, 120], 6)
    assert found(jaccard.join(docs(rows), boundary=boundary)) == brute_force(rows)


def test_long_lists_take_several_rounds(docs):
    """Sixty texts share a long passage, in pairs that link with each other only."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} " + " ".join(f"u{i // 2}_{j}" for j in range(6)) + f" {i % 2}")
            for i in range(60)]
    expected = brute_force(rows)
    assert len({c for *_, c in expected}) == 30
    assert found(jaccard.join(docs(rows))) == expected


def test_variants_that_link_through_their_base_only(docs):
    base = [f"b{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):
        spot = 2 * i
        rows.append((i, " ".join([*base[:spot], f"v{i}", f"z{i}", *base[spot + 2:]])))
    expected = brute_force(rows)
    assert {c for *_, c in expected} == {0}
    assert found(jaccard.join(docs(rows))) == expected


def test_few_large_sets_are_moved(docs, monkeypatch):
    """Twenty texts share half of their 3000 words; only the two that link are intersected."""
    shared = [f"p{i}" for i in range(1500)]
    rows = [(i, " ".join([*shared, *(f"u{i}_{j}" for j in range(1500))])) for i in range(20)]
    rows.append((20, rows[7][1].replace("u7_700 ", "other ")))
    intersected, linked = [], jaccard._linked

    def counted(pairs, *more):
        intersected.append(pairs.count())
        return linked(pairs, *more)

    monkeypatch.setattr(jaccard, "_linked", counted)
    assert found(jaccard.join(docs(rows))) == brute_force(rows)
    assert sum(intersected) == 1


def test_odd_rows(odd, none):
    rows = jaccard.join(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    for empty in (1, 2, 3):
        assert by[empty] == [(0, empty)]
    assert by[5][0][0] > 3000 and by[5] == by[6] and by[6][0][1] == 5
    assert by[8] == [(1, 8), (1, 8)]
    assert sorted(by[None]) == [(0, None), (0, None), (2, None)]
    assert jaccard.join(none).collect() == []


def test_light_sets_and_their_partners():
    for n in range(1, 30):
        assert jaccard.subset_sizes(n, n) == [jaccard.needed(n)]
        for m in range(1, n + 1):  # linked sets of m and n share this many tokens at least
            common = next(c for c in range(n + m) if 190 * c >= 90 * (n + m))
            if common <= m:
                assert jaccard.needed(n) in jaccard.subset_sizes(m, 30)
                assert common >= jaccard.needed(n)


def test_boundary_follows_the_cost():
    sizes = {n: 1000 for n in range(1, 45)}
    chosen = [jaccard.choose_boundary(sizes, met) for met in (0, 10, 1e3, 1e9)]
    assert chosen == sorted(chosen) and chosen[0] < chosen[2] < chosen[3]
    assert jaccard.choose_boundary({500: 10}, 50.0) == 0


def test_tokens_of_long_texts(docs):
    text = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, text), (2, text + " end"), (3, "w1 w2 w3")]
    assert found(jaccard.join(docs(rows))) == [(1, 199_998, 1), (2, 199_999, 1), (3, 1, 3)]


def test_the_index_is_moved_once(spark):
    """Tokens of one set leave; equal rows of different tasks come once."""
    index = spark.createDataFrame(
        [(1, 10, 0), (1, 11, 2), (2, 10, 1), (3, 12, 0), (3, 12, 0), (1, 10, 0)],
        "token long, `set` long, at int").repartition(3)
    classes = spark.createDataFrame([(s, 5, s, False) for s in (10, 11, 12)],
                                    "`set` long, n long, least long, clash boolean")
    members = jaccard._members(index, classes)
    assert sorted((r.token, r.set, r.at, r.n) for r in members.collect()) == [
        (1, 10, 0, 5), (1, 11, 2, 5)]
    plan = members._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("hashpartitioning(token#") == 1
