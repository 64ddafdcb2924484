import zlib
from collections import Counter

from pyspark.sql import functions as F

from orderloom.llm import sharding
from orderloom.llm.queries import op10_virtual_slots
from orderloom.llm.text import table
from orderloom.session import work_folder


def _rows(docs, rng, count=3000):
    return docs([(i, "x" * rng.randint(0, 3000)) for i in range(count)])


def test_places_and_sizes(docs, rng):
    rows = sharding.shard_documents(_rows(docs, rng)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    sizes = Counter()
    for shard in range(16):
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sizes[shard] = sum(r.size for r in own)
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * max(sizes.values())


def test_rebalance_against_plain_python(spark, rng):
    weights = {s: rng.choice([0, 1, 5, 5, 300]) for s in range(60)}
    used = spark.createDataFrame([(s, w) for s, w in weights.items() if w],
                                 "virtual_slot int, bytes long")
    found = {r.virtual_slot: r.shard for r in sharding.rebalance(
        sharding.first_map(spark, 60, 4), used, 4).collect()}
    share, loads, moving, expected = sum(weights.values()) // 4, [0] * 4, [], {}
    for shard in range(4):
        total = 0
        ordered = sorted(range(shard, 60, 4), key=lambda s: (-weights[s], s))
        for i, slot in enumerate(ordered):
            total += weights[slot]
            if total <= share or i == 0 or not weights[slot]:
                expected[slot] = shard
                loads[shard] += weights[slot]
            else:
                moving.append((-weights[slot], slot))
    for less, slot in sorted(moving):
        expected[slot] = loads.index(min(loads))
        loads[expected[slot]] -= less
    assert found == expected


def test_versions_and_fewer_shards(spark):
    folder = work_folder(spark, "maps-test")
    sharding.store_map(sharding.first_map(spark, 32, 4), folder)
    used = spark.createDataFrame([(s, 10) for s in range(32)], "virtual_slot int, bytes long")
    sharding.store_map(sharding.rebalance(sharding.read_map(spark, folder), used, 3), folder)
    first, second = (dict(sharding.read_map(spark, folder, v).select("virtual_slot", "shard")
                          .collect()) for v in (1, 2))
    assert set(first.values()) == {0, 1, 2, 3} and set(second.values()) == {0, 1, 2}
    assert all(second[s] == first[s] for s in first if first[s] < 3)
    assert sharding.read_map(spark, folder).first().version == 2


def test_native_plan(docs):
    plan = sharding.sized_records(docs([(1, "a")])).select(F.col("virtual_slot"))
    assert "Python" not in plan._jdf.queryExecution().toString()


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode()
             for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    rows = op10_virtual_slots(spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        i: (len(t) + 1, zlib.crc32(t), "bytes", None) for i, t in texts.items()}
    assert len(rows) == len(texts)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert set(loads) == set(range(16))
    assert max(loads.values()) - min(loads.values()) < 0.01 * max(loads.values())
    for shard in loads:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(
            range(sum(r.shard == shard for r in rows)))
