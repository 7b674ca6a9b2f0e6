import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from surgeline.llm import mixing, sharding
from tests_llm_brute import water


def check_shards(rows, shards, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    sizes = [sum(r.size for r in by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= slack
    return by


def test_bytes_near_equal_with_a_hot_text(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text number {i} " + "x" * (i % 50)) for i in range(3000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    check_shards(out, 7, 300)
    again = sharding.shard(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5), 7).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in out} == {(r.doc_id, r.shard, r.slot) for r in again}
    # equal texts stay together unless a boundary has to fall among them
    assert len({r.shard for r in out if r.text == "same text"}) <= 4


def test_rows_equal_in_all(spark):
    out = sharding.shard(spark.createDataFrame([(1, "a")] * 100 + [(None, None)] * 50, "doc_id long, text string"), 5).collect()
    assert len(out) == 150
    check_shards(out, 5, 40)


def test_odd_rows(docs, none, clashing):
    for df in (docs, clashing):
        out = sharding.shard(df, 3)
        assert [c for c in df.columns if c not in ("size", "shard", "slot")] == [c for c in out.columns if c not in ("size", "shard", "slot")]
        rows = out.collect()
        assert len(rows) == 32
        assert all(r.size == 16 + len((r.text or "").encode()) for r in rows)
        check_shards(rows, 3, 60_000)
    assert sharding.shard(none, 3).collect() == []


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5], [1, 1, 1000, 7, 7], [0, 10, 3], [5]])
def test_targets_and_taken(spark, sizes):
    names = [chr(97 + i) for i in range(len(sizes) - 1)] + [None]
    rows = [(i * 10_000 + j, s, 1) for i, (s, n) in enumerate(zip(names, sizes)) for j in range(n)] + [(-i - 1, s, 0) for i, s in enumerate(names)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    want = water(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert len(out) == len(rows)
    for name, target, size in zip(names, want, sizes):
        own = [r for r in out if r.source == name]
        assert all(abs(r.target - target) < 1e-5 and r.source_size == size for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 1
        assert all(r.taken <= 3 * r.size for r in own)


def test_mix_of_odd_rows(docs, none, clashing):
    sized = docs.withColumn("size", mixing.word_count("text"))
    once, twice = (mixing.mix(df).select("doc_id", "taken", "target").collect() for df in (sized, sized.repartition(7)))
    assert sorted(once, key=str) == sorted(twice, key=str) and len(once) == 32
    other = mixing.mix(clashing.withColumn("words", mixing.word_count("text")), size="words")
    assert sorted(other.select("doc_id", "taken", "target").collect(), key=str) == sorted(once, key=str)
    mixed = mixing.mix(sized)
    whole = mixing.repeated(sized, mixed)
    times = mixed.agg(F.sum(F.col("copies") + ((F.col("part_words") > 0) & (2 * F.col("part_words") >= F.col("size"))).cast("int"))).first()[0]
    assert whole.columns == sized.columns and whole.count() == times
    assert mixing.mix(none.withColumn("size", F.lit(0))).collect() == []


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_mix_of_rows_without_an_id(spark, monkeypatch, broadcast):
    """Many rows share an id or have none; some are equal in everything."""
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", broadcast)
    rows = [(None, "hot", 3, "same")] * 90 + [(None, "hot", i % 4, f"t{i}") for i in range(90)] + [(7, "hot", 2, f"u{i % 5}") for i in range(40)]
    rows += [(i, "cold", 5, "x") for i in range(8)] + [(None, None, 4, "x")] * 30 + [(None, "none", 0, "x")] * 5
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text string")
    once, twice = (mixing.mix(d).collect() for d in (df, df.repartition(5)))
    assert sorted(once, key=str) == sorted(twice, key=str) and len(once) == len(rows)
    assert Counter((r.doc_id, r.source, r.size, r.text) for r in once) == Counter(rows)
    order = ["cold", "hot", "none", None]
    sizes = [sum(r[2] for r in rows if r[1] == s) for s in order]
    for s, total, target in zip(order, sizes, water(sizes, [1, 2, 3, 1])):
        own = [r for r in once if r.source == s]
        copies = math.floor(round(target, 6) / total) if total else 0
        rest, want = math.floor(round(target, 6) - copies * total + 0.5), Counter()
        for r in sorted(own, key=lambda r: (hashlib.md5(f"20260:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.size)):
            part = max(0, min(r.size, rest))
            rest -= part
            want[r.doc_id, r.size, copies * r.size + part] += 1
        assert Counter((r.doc_id, r.size, r.taken) for r in own) == want
