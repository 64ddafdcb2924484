import hashlib

from orderloom.llm import decontamination as dc


def _brute(items, words, window):
    windows = {}
    for name, text in items:
        own = dc.words_of(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i:i + size]), set()).add(name)
    hit, names = set(), set()
    for run, of in windows.items():
        for i in range(len(words) - len(run) + 1):
            if tuple(words[i:i + len(run)]) == run:
                hit.update(range(i, i + len(run)))
                names |= of
    return hit, names


def test_against_brute_force(rng):
    for _ in range(800):
        letters = "abcd"[:rng.randint(1, 4)]
        window = rng.choice([2, 3, 4])
        items = [(str(i), " ".join(rng.choices(letters, k=rng.randint(0, 7))))
                 for i in range(rng.randint(0, 5))]
        words = [w.encode() for w in rng.choices(letters + "x", k=rng.randint(0, 30))]
        spans, names = dc.Automaton(items, window).hits(words)
        assert ({i for a, b in spans for i in range(a, b)}, set(names)) == _brute(
            items, words, window)


def _tables(spark, docs):
    item = " ".join(f"q{i}" for i in range(20))
    filler = " ".join(f"f{i}" for i in range(400))
    items = spark.createDataFrame([(7, item), (10, "Two words"), (None, None), (3, "--")],
                                  "item_id long, text string")
    return items, docs([
        (1, "start, " + item.upper().replace(" ", "; ") + "! end"), (2, "two-WORDS"),
        (3, filler + " q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11"), (4, None),
        (5, f"{filler} {' '.join(f'q{i}' for i in range(5, 18))} tail")])


def test_digest(spark, docs):
    items, rows = _tables(spark, docs)
    found = {r.doc_id: r for r in dc.contamination(rows, items).collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert tuple(found[1])[1:] == (22, 20, 1, sha("7"), True)
    assert tuple(found[2])[1:] == (2, 2, 1, sha("10"), True)
    assert tuple(found[3])[1:] == (412, 0, 0, sha(""), False)
    assert tuple(found[4])[1:] == (0, 0, 0, sha(""), False)
    assert tuple(found[5])[1:] == (414, 13, 1, sha("7"), False)


def test_blocks_of_items_give_the_same(spark, docs):
    items, rows = _tables(spark, docs)
    whole = dc.contamination(rows, items).collect()
    assert sorted(dc.contamination(rows, items, block_words=1).collect()) == sorted(whole)


def test_clean_cuts_spans_and_drops_contaminated(spark, docs):
    items, rows = _tables(spark, docs)
    before = {r.doc_id: r for r in rows.collect()}
    after = {r.doc_id: r for r in dc.clean(rows, items).collect()}
    assert sorted(after) == [3, 4, 5]
    assert after[3] == before[3] and after[4] == before[4]
    assert after[5].text.endswith("f399  tail") and after[5].n_chars == len(after[5].text)
