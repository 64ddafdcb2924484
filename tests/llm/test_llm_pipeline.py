import hashlib
import re
from collections import Counter

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import language, repetition
from orderloom.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, docs):
    plain = " ".join(f"the{i} nation{i} and thing{i} of that{i}" for i in range(30))
    base = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    added = docs([(-1, plain), (-2, plain), (-3, "***"), (-4, None), (-5, "a b " * 90),
                  (-6, " ".join(f"word{i}" for i in range(100)) + " " + item)])
    rows = base.unionByName(added)
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = cut_lineage(stage(spark, rows, SF), f"test-{name}")
        assert rows.columns == base.columns
        left.append({r.doc_id for r in rows.select("doc_id").collect() if r.doc_id < 0})
    assert not left[0] & {-3, -4} and left[0] >= {-1, -2, -5, -6}
    assert left[1] == {-1, -2, -6}
    assert left[2] == {-2, -6}
    assert left[3] == {-2}
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert last.count() == rows.count()


def _repeated(words, size):
    """Places of words in windows of `size` words that occur twice or more."""
    windows = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    times = Counter(windows)
    return {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(size)}


def _good(text):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    covered = _repeated(words, repetition.MIN_REPEAT_WORDS)
    return (len(words) >= 50 and 2 * len(_repeated(words, 3)) <= len(words)
            and len(covered) <= repetition.MAX_COVERED * len(words)
            and not _repeated(words, repetition.MAX_REPEAT_WORDS + 1))


def _fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42)
              for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _one_of_each(texts):
    """The smallest id of each component of fingerprints at two bits or fewer."""
    prints, kept, left = {i: _fingerprint(t) for i, t in texts.items()}, [], set(texts)
    while left:
        first = min(left)
        kept.append(first)
        queue = [first]
        left.discard(first)
        while queue:
            at = queue.pop()
            near = {i for i in left if (prints[i] ^ prints[at]).bit_count() <= 2}
            left -= near
            queue += near
    return kept


_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower_words(text):
    return list(_WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def _without_items(text, windows):
    """The text without hit passages; None if they are a twentieth of it or more."""
    places = _lower_words(text)
    words = [m[0] for m in places]
    hit = {i + j for size in {len(w) for w in windows} for i in range(len(words) - size + 1)
           if tuple(words[i:i + size]) in windows for j in range(size)}
    if hit and 20 * len(hit) >= len(words):
        return None
    out, done = "", 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out += text[done:places[i].start()]
        done = places[i].end()
    return out + text[done:]


def test_run_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    names, scores = language.predict(language.fit(docs), list(texts.values()))
    texts = {i: t for (i, t), name, score in zip(texts.items(), names, scores, strict=True)
             if name != "und" and score >= language.MIN_SCORE}
    texts = {i: t for i, t in texts.items() if _good(t)}
    texts = {i: texts[i] for i in _one_of_each(texts)}
    windows = set()
    for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = [m[0] for m in _lower_words(row.text or "")]
        windows |= {tuple(words[i:i + 13]) for i in range(max(1, len(words) - 12)) if words}
    cleaned = {i: _without_items(t, windows) for i, t in texts.items()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for i, text in cleaned.items():
        if text is not None:
            ids = library.encode(text, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False).encode()
            packed = b"".join(n.to_bytes(4, "little") for n in ids)
            expected[i] = (len(ids), hashlib.sha256(packed).hexdigest(),
                           hashlib.sha256(decoded).hexdigest())
    assert 0 < len(expected) < docs.count()
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == expected
