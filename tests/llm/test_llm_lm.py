import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from orderloom.llm import lattice, lm
from orderloom.llm.text import held_out, table

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load_pieces(PATH)


def _segmentations(word, known):
    if not word:
        return [[]]
    return [[word[:i], *rest] for i in range(1, len(word) + 1) if word[:i] in known
            for rest in _segmentations(word[i:], known)]


def test_sum_over_all_segmentations(vocabulary):
    pieces, log_p = vocabulary
    known = dict(zip(pieces, np.exp(log_p), strict=True))
    words = [b"the", b"nation", b"x", "né".encode(), b"", b"zz!"]
    found = lattice.Lattice(pieces, log_p).log_probabilities(words)
    for word, value in zip(words, found, strict=True):
        ways = _segmentations(b" " + word, known)
        assert math.isclose(value, math.log(sum(math.prod(map(known.get, w)) for w in ways)))


def test_expected_counts_by_enumeration(vocabulary):
    pieces, log_p = vocabulary
    known = dict(zip(pieces, np.exp(log_p), strict=True))
    words, times = [b"then", b"on"], np.array([3.0, 2.0])
    expected = Counter()
    for word, n in zip(words, times, strict=True):
        ways = _segmentations(b" " + word, known)
        chances = [math.prod(map(known.get, w)) for w in ways]
        for way, chance in zip(ways, chances, strict=True):
            for piece in way:
                expected[piece] += n * chance / sum(chances)
    found = lattice.Lattice(pieces, log_p).expected_counts(words, times)
    assert math.isclose(found.sum(), sum(expected.values()))
    assert all(math.isclose(found[pieces.index(p)], v) for p, v in expected.items())


def test_stretches_of_long_words(vocabulary, monkeypatch):
    model = lattice.Lattice(*vocabulary)
    words = [(w * 40).encode() for w in ("thenation", "été", "x")]
    whole = model.log_probabilities(words)
    for size in (1, 7, 30, 64):
        monkeypatch.setattr(lattice, "LONG", size)
        assert np.allclose(model.log_probabilities(words), whole)
    counted = model.expected_counts(words, np.ones(3))
    lengths = np.array([len(p) for p in vocabulary[0]])
    assert counted @ lengths >= sum(map(len, words))


def test_long_word_is_finite(vocabulary):
    assert np.isfinite(lattice.Lattice(*vocabulary).log_probabilities([b"q" * 20_000])).all()


def test_base_score_and_counts(spark):
    docs = table(spark, SF, "documents")
    found = lm.score(docs, ~held_out("doc_id", 10), PATH, chunk_bytes=50_000, rounds=1)
    texts = {r.doc_id: [*r.text.encode().lower().split(), None] for r in docs.collect()}
    learned = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in learned for w in texts[i])
    n, v = sum(counts.values()), len(counts)
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in texts[r.doc_id])
        assert (r.n_tokens, r.train_tokens) == (len(texts[r.doc_id]), n)
        assert r.n_known == sum(w in counts for w in texts[r.doc_id])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert -1e9 < r.score < 0 and -1e9 < r.word_score < 0


def test_tasks_grow_with_the_chunks(spark):
    docs = table(spark, SF, "documents")
    found = lm.score(docs, ~held_out("doc_id", 10), PATH, chunk_bytes=1000, rounds=0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    tasks = {int(n) for n in re.findall(r"RepartitionByExpression \[chunk#\d+L\], (\d+)", plan)}
    assert len(tasks) == 1 and tasks.pop() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == docs.count()


@pytest.mark.parametrize("rounds", [0, 2])
def test_score_by_enumeration(spark, docs, vocabulary, rounds):
    """Document scores against all segmentations of every word, spelled out."""
    texts = {1: "the nation the", 2: "then  On\tnote", 3: "", 4: None, 5: "née x", 6: "the zoo"}
    learned = [1, 2, 3]
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    pieces, log_p = vocabulary
    chance = dict(zip(pieces, np.exp(log_p), strict=True))

    def ways(word):
        return [(w, math.prod(map(chance.get, w))) for w in _segmentations(b" " + word, chance)]

    for _ in range(rounds):
        counts = dict.fromkeys(pieces, 0.1)
        for word in (w for i in learned for w in words[i]):
            found = ways(word)
            for way, p in found:
                for piece in way:
                    counts[piece] += p / sum(q for _, q in found)
        total = sum(counts.values())
        chance = {piece: n / total for piece, n in counts.items()}
    n = sum(len(words[i]) + 1 for i in learned)
    p_end = (len(learned) + 0.1) / (n + 0.2)
    rows = docs(list(texts.items()))
    found = lm.score(rows, rows["doc_id"].isin(learned), PATH, chunk_bytes=12, rounds=rounds)
    got = {r.doc_id: r.score for r in found.collect()}
    for i, of_text in words.items():
        expected = math.log10(p_end) + sum(
            math.log10((1 - p_end) * sum(p for _, p in ways(w))) for w in of_text)
        assert math.isclose(got[i], expected, rel_tol=1e-9)


def test_words_of_training_texts_are_likelier(spark, docs):
    rows = docs([(i, "quixotic zebras dance") for i in range(30)] + [(99, "quixotic zebras danse")])
    found = {r.doc_id: r.score for r in lm.score(
        rows, rows["doc_id"] < 30, PATH, rounds=1).collect()}
    assert found[99] < found[0] < 0


def test_nothing_to_learn_from(docs):
    rows = docs([(1, "a b"), (2, None)])
    found = {r.doc_id: r for r in lm.score(rows, rows["doc_id"] < 0, PATH).collect()}
    assert (found[1].train_tokens, found[1].base_score, found[2].n_tokens) == (0, 0.0, 1)
    assert found[1].score < found[2].score < 0
