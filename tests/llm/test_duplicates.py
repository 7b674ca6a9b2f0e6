import hashlib
import os
import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from surgeline.llm import exact_dedup, near_dedup, substring_dedup
from tests_llm_brute import brute_classes, lcs_step


def brute_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append(r)
    return groups


def check_exact(df, **how):
    rows = df.select("doc_id", "text").collect()
    out = exact_dedup.exact_dedup(df, **how).collect()
    assert len(out) == len(rows)
    by_sha = defaultdict(list)
    for r in out:
        by_sha[r.text_sha256].append(r)
    groups = brute_groups(rows)
    assert len(by_sha) == len(groups)
    for text, members in groups.items():
        found = by_sha[hashlib.sha256(text.encode()).hexdigest()]
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        assert len(found) == len(members) and all(r.group_size == len(members) and r.keep_id == best.doc_id for r in found)
        assert sum(r.kept for r in found) == 1


def test_exact_groups(docs, none, clashing):
    check_exact(docs)
    check_exact(clashing)
    assert exact_dedup.exact_dedup(none).collect() == []
    kept = exact_dedup.deduplicated(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(brute_groups(docs.collect()))


def test_small_blocks_need_several_levels(docs):
    check_exact(docs, block=7)


def test_route_that_is_not_one_to_one_is_drawn_anew(docs):
    def route(block, turn):
        return F.length(block).cast("long") if turn < 1 else F.xxhash64(block)

    check_exact(docs, block=16, route=route)


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(share * len(out)))):
        i = rng.randrange(len(out))
        if rng.random() < 0.5:
            out[i] = f"w{rng.randrange(10**6)}"
        elif rng.random() < 0.5:
            del out[i]
        else:
            out.insert(i, f"w{rng.randrange(10**6)}")
    return out


def test_near_classes_against_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 30, 120]))]
        texts += [" ".join(words)] + [" ".join(edited(rng, words, rng.choice([0.01, 0.02, 0.05]))) for _ in range(6)]
    rows = list(enumerate(texts))
    out = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r.class_id for r in out}
    assert same_partition([got[i] for i, _ in rows], brute_classes(texts))
    for r in out:
        assert r.class_id == min(i for i, c in got.items() if c == r.class_id)


def test_near_hot_bucket_with_a_chain(spark):
    """Many near copies of one text, and a chain whose ends are not alike."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(100)]
    hot = [" ".join(edited(rng, words, 0.01)) for _ in range(150)]
    chain, step = [], [f"c{i}" for i in range(200)]
    for i in range(8):
        chain.append(" ".join(step))
        step = step[8:] + [f"d{i}_{j}" for j in range(8)]
    rows = list(enumerate(hot + chain))
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({got[i] for i in range(150)}) == 1
    assert {got[i] for i in range(150, 158)} == {150}


def test_near_odd_rows(docs, none, clashing):
    for df in (docs, clashing):
        out = {(r.doc_id, r.points): r for r in near_dedup.near_classes(df).collect()}
        assert sum(r.kept for r in near_dedup.near_classes(df).collect()) == near_dedup.near_deduplicated(df).count()
        assert {out[k].class_id for k in out if k[0] in (1, 2, 3)} == {1}
        for alone in (4, 5, 6):
            assert [r.class_size for k, r in out.items() if k[0] == alone] == [1]
        assert near_dedup.near_deduplicated(df).columns == df.columns
    assert near_dedup.near_classes(none).collect() == []
    assert near_dedup.near_deduplicated(none).collect() == []


def test_near_texts_just_under_the_threshold_are_not_paired(spark, monkeypatch):
    """Texts of which a common passage makes up four fifths meet in many buckets, but only alike ones are verified."""
    rng = random.Random(7)
    shared = [f"s{i}" for i in range(240)]
    texts = [" ".join(shared + [f"o{t}_{i}" for i in range(60)]) for t in range(120)]
    texts.append(" ".join(edited(rng, texts[0].split(), 0.005)))
    sizes, inner = [], near_dedup.written

    def counted(df, label):
        out = inner(df, label)
        if label == "near-tested":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", counted)
    out = near_dedup.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r.class_id for r in out}
    assert got == {i: 0 if i in (0, 120) else i for i in range(121)}
    assert 1 <= sum(sizes) <= 121


def test_parity_bits_never_differ_more_than_the_kmers(spark):
    rng = np.random.default_rng(3)
    pool, pairs = rng.integers(0, 2**63, 6000).astype(np.uint64), []
    for n in (1, 5, 63, 64, 65, 130, 900, 1030, 4000):
        for share in (1.0, 0.9, 0.6):
            m = max(1, int(n * rng.uniform(0.8, 1.25)))
            first, kept = rng.choice(6000, n, replace=False), max(1, int(share * min(n, m)))
            other = np.setdiff1d(np.arange(6000), first)
            a, b = pool[first], pool[np.concatenate([first[:kept], rng.choice(other, m - kept, replace=False)])]
            bits, held = near_dedup.parities(np.concatenate([a, b]), np.repeat([0, 1], [n, m]), 2)
            x, y = bits.view(np.int64)[: held[0]].tolist(), bits.view(np.int64)[held[0] :].tolist()
            assert [len(x), len(y)] == held.tolist() and all(64 * h >= k for h, k in zip(held, (n, m)))
            pairs.append((x, y, n + m - 2 * kept, len(pairs)))
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>, most long, i int")
    for r in df.select("*", near_dedup._differing(F.col("a"), F.col("b")).alias("d"), near_dedup._differing(F.col("b"), F.col("a")).alias("e")).collect():
        assert r.d == r.e and r.d % 2 == r.most % 2 and r.most // 3 <= r.d <= r.most


def test_labelled_kmers_count_repeats():
    value = np.array([1, 1, 1, 1, 1, 1, 1], np.uint64)
    kmer, owner = near_dedup.labelled(value, np.zeros(7, np.int64))
    assert len(set(kmer.tolist())) == 3
    assert near_dedup.similarity(kmer, kmer) == 1.0


def chain_score(x, y, chain, k, cost):
    total = k
    for j, i in zip(chain, chain[1:]):
        total += k - max(0, k - min(x[i] - x[j], y[i] - y[j])) - cost * (max(0, x[i] - x[j] - k) + max(0, y[i] - y[j] - k))
    return total


def brute_chain(x, y, k, cost):
    best = {}
    for i in sorted(range(len(x)), key=lambda i: (x[i], y[i])):
        best[i] = max([k] + [best[j] + chain_score(x, y, [j, i], k, cost) - k for j in best if x[j] < x[i] and y[j] < y[i]])
    return max(best.values())


def test_chain_is_as_good_as_the_quadratic_one():
    """With seeds that do not overlap the Fenwick tree finds the best chain itself."""
    rng = random.Random(8)
    for _ in range(60):
        true = [9 * v for v in sorted(rng.sample(range(60), rng.randint(2, 25)))]
        x = np.array(true + [9 * rng.randrange(60) for _ in range(5)])
        y = np.array([v + 18 for v in true] + [9 * rng.randrange(60) for _ in range(5)])
        found = substring_dedup.chains(x, y, max_gap=10**6)
        assert sorted(i for c in found for i in c) == list(range(len(x)))
        assert all((np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all() for c in found)
        assert abs(max(chain_score(x, y, c.tolist(), 8, 0.2) for c in found) - brute_chain(x, y, 8, 0.2)) < 1e-9


def test_banded_equals_longest_common_subsequence():
    rng = random.Random(9)
    for _ in range(50):
        a = np.array([rng.randrange(5) for _ in range(rng.randint(0, 12))])
        b = np.array([rng.randrange(5) for _ in range(rng.randint(0, 12))])
        row = [0] * (len(b) + 1)
        for v in a:
            row = lcs_step(row, v, b.tolist())
        assert substring_dedup.banded(a, b) == row[-1]


def test_passages(spark, docs, none, clashing):
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    shared, other = fresh(80), fresh(60)
    fuzzy = list(shared)
    fuzzy[30] = "changed"
    fuzzy.insert(55, "added")
    texts = {
        1: fresh(50) + shared + fresh(30), 2: fresh(10) + fuzzy + fresh(200), 3: shared, 4: fresh(300), 5: fresh(5) + other + fresh(5),
        6: other + fresh(100) + shared, 7: fresh(40),
    }
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    out = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = defaultdict(list)
    for r in out:
        spans[r.doc_id].append((r.start, r.end))
    assert set(spans) == {1, 2, 3, 5, 6}
    for i, (a, b) in {1: (50, 130), 2: (10, 91), 3: (0, 80), 5: (5, 65)}.items():
        covered = set().union(*[range(*s) for s in spans[i]])
        assert set(range(a, b)) <= covered and len(covered) <= b - a + 4
    assert len({v for s in spans[6] for v in range(*s)}) >= 140
    found = substring_dedup.passages(docs).collect()
    assert {r.doc_id for r in found} == {1, 2, 3}
    assert sorted(found, key=str) == sorted(substring_dedup.passages(clashing).collect(), key=str)
    assert substring_dedup.passages(none).collect() == []


def common_runs(a, b, least=50):
    """Maximal runs of at least ``least`` equal words of two texts, as (start in a, start in b, words)."""
    out = []
    for d in range(-len(b) + 1, len(a)):
        run = 0
        for i in range(max(0, d), min(len(a), len(b) + d) + 1):
            if i < min(len(a), len(b) + d) and a[i] == b[i - d]:
                run += 1
                continue
            if run >= least:
                out.append((i - run, i - run - d, run))
            run = 0
    return out


def check_runs(spark, texts):
    """Every word of a common run of two texts is in a passage of either text, but for the thinned ends."""
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    out = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    covered = defaultdict(set)
    for r in out:
        covered[r.doc_id] |= set(range(r.start, r.end))
        assert r.doc_id != r.other_doc_id
    found = 0
    for i, a in enumerate(texts):
        for j in range(i):
            for x, y, n in common_runs(a, texts[j]):
                found += 1
                assert set(range(x + 8, x + n - 8)) <= covered[i]
                assert set(range(y + 8, y + n - 8)) <= covered[j]
    return out, found


def test_passage_whose_fragments_stand_in_earlier_and_later_texts(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    shared = fresh(60)
    parts = [shared[i : i + 22] for i in (0, 13, 26, 38)]  # every seed of the passage stands in one of them
    before, after = ([fresh(40) + p + fresh(40) for p in parts] for _ in range(2))
    texts = [*before, fresh(30) + shared + fresh(70), fresh(90) + shared + fresh(10), *after]
    out, found = check_runs(spark, texts)
    assert found == 1
    assert {(r.doc_id, r.other_doc_id) for r in out} == {(4, 5), (5, 4)}


def test_families_of_overlapping_fragments_against_brute_force(spark):
    rng = random.Random(22)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    texts = []
    for _ in range(3):
        base = fresh(120)
        for _ in range(9):
            at, n = rng.randrange(70), rng.choice([20, 30, 55, 70, 90])
            texts.append(fresh(rng.randrange(60)) + base[at : at + n] + fresh(rng.randrange(60)))
    rng.shuffle(texts)
    assert check_runs(spark, texts)[1] > 10


def test_recall_of_passages_at_all_identities(spark):
    """Pairs of texts around a passage in which a share of the words was changed."""
    rng = random.Random(23)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    rows, wanted, kinds = [], defaultdict(list), {0.75: 0.75, 0.8: 0.85, 0.85: 0.95, 0.9: 1.0, 0.95: 1.0, "eighth": 1.0}
    for kind in kinds:
        for _ in range(20):
            a = fresh(80)
            at = range(4, 80, 8) if kind == "eighth" else rng.sample(range(80), round(80 * (1 - kind)))
            b = list(a)
            for i in at:
                b[i] = fresh(1)[0]
            wanted[kind].append((len(rows), len(rows) + 1))
            for passage in (a, b):
                rows.append((len(rows), " ".join(fresh(rng.randrange(40)) + passage + fresh(rng.randrange(40)))))
    found = {(r.doc_id, r.other_doc_id) for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for kind, least in kinds.items():
        assert sum(p in found for p in wanted[kind]) >= least * 20, kind


def test_reach_follows_the_words_wanted(spark):
    words = [f"w{i}" for i in range(22)]
    rows = [(1, " ".join(["a", "b", *words])), (2, " ".join([*words, "c"]))]
    out = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string"), min_words=20).collect()
    assert {(r.doc_id, r.start, r.end) for r in out} == {(1, 2, 24), (2, 0, 22)}


def test_a_line_that_texts_repeat_many_times(spark):
    """As many rounds as the logarithm of the texts, not as many as the line has places; every text is joined to every other."""
    rng = random.Random(8)
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    line, long_line = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("l", 14), ("m", 60)))
    rows = [(t, " ".join(f"{own(rng.randint(3, 9))} {line}" for _ in range(40)) + f" {own(30)} {long_line} {own(30)} {long_line}") for t in range(4)]
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_doc_id) for r in found if r.equal_words >= 60} == {(a, b) for a in range(4) for b in range(4) if a != b}


def compared(*texts):
    """Passages of the first text with the second, as tuples, and the most memory that was held meanwhile, in bytes."""
    cells = [substring_dedup.words([t])[0].astype(np.uint32).tobytes() for t in texts]
    batch = pa.RecordBatch.from_pylist([{"uid": 0, "other": 1, "words": cells[0], "other_words": cells[1]}])
    tracemalloc.start()
    found = [tuple(r.values()) for b in substring_dedup._compared(iter([batch]), 50, 0.7) for r in b.to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found, most


def test_memory_does_not_follow_the_common_seeds_of_two_texts():
    """Texts of one line have as many common seeds as the product of its places in both."""
    line = "all rights reserved "
    found, most = compared("one " + line * 300, "two other " + line * 250)
    assert (1, 751, 2, 752, 750) in [r[2:7] for r in found]
    assert most < 20e6, most


def test_memory_does_not_follow_the_copies_of_long_texts():
    """Chains go out before many are held, though a batch has the matches of many pairs."""
    places = pa.array([[{"pos": i, "other_pos": i + 1} for i in range(4000)]] * 100, pa.list_(pa.struct([("pos", pa.int32()), ("other_pos", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(range(100, 200)), places], names=["uid", "other", "matches"])
    tracemalloc.start()
    n = sum(len(x) for b in substring_dedup._chained(iter([batch])) for x in b.column("x").to_pylist())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400_000 and most < 16e6, most


def test_chains_by_places_are_those_of_all_matches(monkeypatch):
    rng = random.Random(41)
    for room in (20, 10**6):
        monkeypatch.setattr(substring_dedup, "FRAGMENTS", room)
        for _ in range(25):
            block = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
            one, two = ([w if rng.random() > 0.03 else rng.randrange(9) for w in block * rng.randint(1, 12)] for _ in range(2))
            one, two = (substring_dedup._sorted_seeds(np.array(w, np.uint32).tobytes()) for w in (one, two))
            xs, left, right, q = substring_dedup._matched(one, two)
            x = np.repeat(xs, right - left)
            y = np.concatenate([q[a:b] for a, b in zip(left, right)] + [np.empty(0, np.int64)])
            wanted = [(x[c].tolist(), y[c].tolist()) for c in substring_dedup.chains(x, y, 5) if x[c[-1]] + 5 - x[c[0]] >= 12]
            for many in (0, 10**6):
                monkeypatch.setattr(substring_dedup, "MANY", many)
                monkeypatch.setattr(substring_dedup, "DENSE", many)
                found = [(a.tolist(), b.tolist()) for a, b in substring_dedup._chains_of(xs, left, right, q, 50)]
                assert sorted(found) == sorted(wanted)


def test_few_seeds_are_kept_and_none_that_texts_share_is_lost(spark, monkeypatch):
    """Seeds of one text only stay behind in their blocks; those of several come back with all their places."""
    rng = random.Random(31)
    monkeypatch.setattr(substring_dedup, "BLOCK", 900)
    own = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    common = own(30)
    texts = [own(200) for _ in range(30)] + [own(40) + common + own(rng.randrange(9)) + common for _ in range(3)] + [["the"] * 20] * 2 + [["x"], []]
    kinds = [(i, " ".join(w)) for i, w in enumerate(texts)]
    read = spark.createDataFrame(kinds, "id long, text string").coalesce(2).mapInArrow(substring_dedup._read, "id long, part int, words binary")
    rows = substring_dedup.written(read.withColumn("uid", F.col("id")).withColumn("block", F.col("id") % 2 * 100 + F.col("part")), "passage-rows")
    got = [(r.uid, r.pos) for r in substring_dedup._repeated_seeds(rows).collect()]
    holders = defaultdict(set)
    for i, w in enumerate(texts):
        for p in range(len(w) - 4):
            holders[tuple(w[p : p + 5])].add(i)
    assert sorted(got) == [(i, p) for i, w in enumerate(texts) for p in range(len(w) - 4) if len(holders[tuple(w[p : p + 5])]) > 1]


def test_slices_change_nothing_and_only_what_is_read_stays(spark, monkeypatch):
    rng = random.Random(32)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    base = fresh(120)
    rows = [(i, " ".join(fresh(9) + base[a : a + 70] + fresh(9))) for i, a in enumerate([0, 10, 30])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, substring_dedup.passages(df).collect()))
    labels, inner = [], substring_dedup.written
    monkeypatch.setattr(substring_dedup, "written", lambda d, label: labels.append((label, inner(d, label))) or labels[-1][1])
    monkeypatch.setattr(substring_dedup, "SLICE", 40)
    monkeypatch.setattr(substring_dedup, "SLICES", 2)
    assert sorted(map(tuple, substring_dedup.passages(df).collect())) == whole and len(whole) >= 4
    assert sum(label == "passage-members" for label, _ in labels) > 1
    for gone in ("passage-found", "passage-held", "passage-members", "passage-words"):
        path = [t.inputFiles() for label, t in labels if label == gone]
        assert path and not any(os.path.exists(f.removeprefix("file://")) for files in path for f in files)


def test_stages_return_the_columns_they_were_given(clashing):
    """Columns whose names the stages use inside come back unchanged."""
    from surgeline.llm import mixing

    own = [c for c, kind in clashing.dtypes if kind == "string" and c not in ("text", "lang", "source")]
    for stage in (exact_dedup.deduplicated, near_dedup.near_deduplicated, lambda d: mixing.remixed(d, mixing.word_count("text"))):
        out = stage(clashing)
        assert out.columns == clashing.columns
        assert out.count() > 10 and {tuple(r) for r in out.select(*[F.col(f"`{c}`") for c in own]).distinct().collect()} == {("x",) * len(own)}
