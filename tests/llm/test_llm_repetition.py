from collections import Counter

import duckdb
from oracle import differences

from orderloom.llm import queries, repetition


def _windows(words, size):
    times = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return {i + j for i in range(len(words) - size + 1)
            if times[tuple(words[i:i + size])] > 1 for j in range(size)}


def _longest(words):
    return next((n for n in range(len(words) - 1, 0, -1) if _windows(words, n)), 0)


def _maximal(words, least):
    found = set()
    for size in range(least, len(words)):
        places = {}
        for i in range(len(words) - size + 1):
            places.setdefault(tuple(words[i:i + size]), []).append(i)
        for at in places.values():
            before = {words[i - 1] if i else None for i in at}
            after = {words[i + size] if i + size < len(words) else None for i in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                found.add((size, len(at), at[0]))
    return found


def test_against_brute_force(rng):
    for _ in range(200):
        texts = [[rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 30))]
                 for _ in range(rng.randint(1, 4))]
        found = repetition.Repeats(texts)
        for i, words in enumerate(texts):
            assert found.longest_of_each()[i] == _longest(words)
            assert found.in_windows(3)[i] == len(_windows(words, 3))
            for least in (1, 3, 5):
                assert found.covered(least)[i] == len(_windows(words, least))
            assert {m[1:] for m in found.maximal(2) if m[0] == i} == _maximal(words, 2)


def test_measures_and_verdicts(docs):
    plain = " ".join(f"w{i}" for i in range(60))
    passage = " ".join(f"p{i}" for i in range(110))
    filler = " ".join(f"f{i}" for i in range(400))
    rows = {r.doc_id: r for r in repetition.repetition(docs([
        (1, plain), (2, "a b c " * 40), (3, "short"), (4, f"{passage} {filler} {passage}"),
        (5, f"{plain} {plain}"), (6, "x # y\n\nx # y\n x\n x \n  $")])).collect()}
    assert rows[1].kept and not rows[1].base_failed
    assert rows[2].base_failed and rows[2].n_repeat_words == 120
    assert rows[3].base_failed and not rows[3].kept
    assert not rows[4].base_failed and rows[4].longest_repeat == 110 and not rows[4].kept
    assert rows[5].n_covered_words == 120 and not rows[5].kept
    assert (rows[6].n_symbols, rows[6].n_dup_lines, rows[6].n_words) == (3, 1, 10)


def _numbered(letter, numbers):
    return " ".join(f"{letter}{i}" for i in numbers)


def test_covered_share_decides_alone(spark, docs, tmp_path):
    passages = [_numbered(letter, range(90)) for letter in "pqrst"]
    first, turned = passages[0], _numbered("p", [*range(45, 90), *range(45)])
    table = docs([
        (1, " ".join(f"s{n} {passages[n % 5]}" for n in range(10)) + " "
         + _numbered("f", range(1001))),
        (2, f"{first} {_numbered('f', range(420))} {turned}"),
        (3, f"{first} {_numbered('f', range(419))} {turned}")])
    rows = {r.doc_id: r for r in repetition.repetition(table).collect()}
    assert [(rows[i].n_words, rows[i].n_covered_words, rows[i].longest_repeat)
            for i in (1, 2, 3)] == [(1911, 900, 90), (600, 180, 45), (599, 180, 45)]
    assert not any(r.base_failed for r in rows.values())
    assert [rows[i].kept for i in (1, 2, 3)] == [False, True, False]
    table.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "op4_suffix_repetition"
    found = queries.QUERIES[name](spark, str(tmp_path))
    assert differences(con, queries.ORACLES[name], found) is None


def test_repeats_as_rows(docs):
    found = repetition.maximal_repeats(docs([(1, "x a b c y a b c z"), (2, None)]), least=2)
    assert [tuple(r) for r in found.collect()] == [(1, 3, 2, 1, "a b c")]


def test_nested_and_long_repeats():
    found = repetition.Repeats([["a"] * 300_000, ["b", "c"] * 1_000, []])
    assert found.covered(8).tolist() == [300_000, 2_000, 0]
    assert found.longest_of_each().tolist() == [299_999, 1_998, 0]
    assert len(repetition.Repeats([["a"] * 50]).maximal(8)) == 42


def test_pieces_of_a_long_text(monkeypatch):
    text = "one  two\u00a0three\n" * 50
    whole = list(repetition.words_of(text))
    monkeypatch.setattr(repetition, "PIECE", 3)
    assert list(repetition.words_of(text)) == whole == ["one", "two\u00a0three"] * 50
    assert list(repetition.words_of(None)) == []
    assert repetition.Repeats([whole]).covered(8).tolist() == [100]
    assert repetition.word_chars(text) == sum(map(len, whole))
