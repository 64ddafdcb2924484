import pathlib
import subprocess
import sys

import numpy as np

from orderloom.llm import quality
from orderloom.llm.text import held_out, table

SF = "/root/testdata/sf0.1"
ROOT = pathlib.Path(__file__).parents[2]


def test_separates_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    vectors = quality.word_vectors(docs)
    net = quality.fit(docs, labels, vectors)
    rows = (quality.scores(docs, vectors, net).where(held_out("doc_id", 5))
            .join(labels, "doc_id").collect())
    good = [r.predicted for r in rows if r.quality == 1]
    poor = [r.predicted for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.15
    assert all(0 <= r.score <= 1 for r in rows)


def test_sums_do_not_depend_on_partitions(spark, docs):
    rows = docs([(i, f"the cat {i} sat on *** the mat") for i in range(60)])
    one, many = (quality.word_vectors(rows.repartition(n)) for n in (1, 7))
    assert np.array_equal(one, many)


def test_context_sums_by_hand():
    ids = quality.tokens("a b c")
    sums = quality.context_sums(["a b c", None, "", "a"])

    def random_vector(i):
        vector = np.zeros(quality.DIMENSIONS)
        vector[quality._PLACES[i]] = quality._SIGNS[i]
        return vector

    assert np.array_equal(sums[ids[0], :-1], random_vector(ids[1]) + random_vector(ids[2]))
    assert sums[ids[0], -1] == 2 and sums[ids[1], -1] == 1


def test_slices_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 50, n)) for n in (0, 1, 2, 700)]
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    whole = quality.context_sums(texts), quality.pooled(vectors, texts)
    ids = quality.tokens(texts[-1])
    found = vectors[ids]
    even = found / np.linalg.norm(found, axis=1, keepdims=True)
    assert np.allclose(whole[1][-1], [
        *found.mean(axis=0), *found.std(axis=0), np.linalg.norm(found.mean(axis=0)),
        np.log1p(700) / 10, len(set(ids)) / 700, (even[1:] * even[:-1]).sum() / 700], atol=1e-5)
    for size in (1, 3, 64):
        monkeypatch.setattr(quality, "_SLICE", size)
        assert np.array_equal(quality.context_sums(texts), whole[0])
        assert np.allclose(quality.pooled(vectors, texts), whole[1], atol=1e-6)


def test_memory_of_a_very_long_text():
    code = """
import resource
import numpy as np
from orderloom.llm import quality
text = "w1 x2 y33 " * 2_700_000
vectors = np.ones((quality.BUCKETS, quality.DIMENSIONS), np.float32)
quality.context_sums([text]), quality.pooled(vectors, [text])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    used = subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True,
                          capture_output=True, text=True).stdout
    assert int(used) < 800


def test_one_label_gives_no_network(spark, docs):
    rows = docs([(i, "some text") for i in range(9)])
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert quality.fit(rows, labels, np.zeros((quality.BUCKETS, quality.DIMENSIONS))) is None


def test_temperature_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    score = quality.train(x, y).score(x)
    for low in (0.1, 0.4, 0.7):
        near = (score >= low) & (score < low + 0.2)
        assert abs(score[near].mean() - y[near].mean()) < 0.1
