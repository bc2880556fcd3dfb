import re
import time

import cases
import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from obligo.llm import simhash
from obligo.llm.simhash import candidate_links, components, fingerprint, forest, variants


def brute_fingerprint(value):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", cases.lower(value or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(labelled, distance=3):
    """Smallest label reachable per position; labelled: (label, fingerprint)."""
    root = list(range(len(labelled)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(labelled):
        for j, (_, b) in enumerate(labelled[:i]):
            if (a ^ b).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (label, _) in enumerate(labelled):
        if label is not None:
            least[find(i)] = min(least.get(find(i), label), label)
    return [least.get(find(i)) for i in range(len(labelled))]


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def expected(pairs):
    pairs = list(pairs)
    prints = [brute_fingerprint(t) for _, t in pairs]
    roots = brute_components([(i, p) for (i, _), p in zip(pairs, prints)])
    return sorted(((i, f"{p:016x}", r) for (i, _), p, r in zip(pairs, prints, roots)), key=str)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    assert got(simhash.near_dedup(spark, docs)) == expected((r[0], r[1]) for r in cases.ROWS)
    kept = simhash.kept_rows(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        [-7, 1, 2, 5, None], key=str)


def test_empty_table(spark):
    docs = cases.awkward(spark).limit(0)
    assert got(simhash.near_dedup(spark, docs)) == []
    assert simhash.kept_rows(spark, docs).count() == 0


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_brute_force(spark):
    assert got(simhash.query(spark, cases.SMALL)) == expected(cases.given(cases.SMALL))


def test_variants_meet_exactly_where_a_segment_differs_in_one_bit():
    rng = np.random.default_rng(1)
    for low, high in ((0, 3), (1, 2), (2, 1), (2, 2), (3, 0), (1, 1), (0, 5), (2, 5)):
        a = int(rng.integers(1 << 62))
        flips = [*rng.choice(32, low, replace=False), *(32 + rng.choice(32, high, replace=False))]
        b = a ^ sum(1 << int(x) for x in flips)
        shared = np.intersect1d(*variants(np.array([a, b], np.uint64)))
        assert bool(len(shared)) == (low <= 1 or high <= 1)


def linked_components(spark, prints):
    distinct = spark.createDataFrame(
        [(int(np.int64(np.uint64(p))),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(
        spark, candidate_links(distinct, 3)).collect()}
    return [roots.get(int(np.int64(np.uint64(p))), int(np.int64(np.uint64(p)))) for p in prints]


def test_no_connection_is_lost_in_dense_groups_and_chains(spark):
    rng = np.random.default_rng(2)
    prints = {int(x) for x in rng.integers(1 << 63, size=300)}
    centre = int(rng.integers(1 << 62))
    for _ in range(400):  # a dense group, wider than the distance
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(5))))
    chain = int(rng.integers(1 << 62))
    for _ in range(60):
        chain ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        prints.add(chain)
    prints = sorted(prints)
    want = brute_components([(i, p) for i, p in enumerate(prints)])
    roots = linked_components(spark, prints)
    groups = {}
    for label, root in zip(want, roots):
        groups.setdefault(root, set()).add(label)
    assert all(len(x) == 1 for x in groups.values())
    assert len(groups) == len(set(want))


def test_hot_variants_are_split_and_lose_no_link(spark, monkeypatch):
    """Many fingerprints share a segment; some are near others in the other one."""
    monkeypatch.setattr(simhash, "HOT", 100)
    rng = np.random.default_rng(7)
    high = [int(x) for x in rng.integers(1 << 32, size=6000)]
    for _ in range(1500):
        high.append(high[rng.integers(len(high))] ^ sum(
            1 << int(b) for b in rng.choice(32, rng.integers(1, 4), replace=False)))
    prints = np.unique(np.array([(h << 32) | 0xABCDEF for h in high], np.uint64))
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3):
            parent[find(int(j))] = find(i)
    want = [find(i) for i in range(len(prints))]
    roots = linked_components(spark, prints.tolist())
    assert len(set(zip(want, roots))) == len(set(want)) == len(set(roots)) > 4000


def test_members_of_a_hot_variant_are_deferred_also_across_batches():
    rng = np.random.default_rng(8)
    fps = np.unique(rng.integers(1 << 62, size=500))
    keys = np.sort(np.r_[np.full(300, 7), np.full(20, 9), np.full(len(fps) - 320, 11)])
    table = pa.RecordBatch.from_pydict({"key": keys, "fp": fps})
    for size in (1, 7, 64, 1000):
        batches = [table.slice(i, size) for i in range(0, len(keys), size)]
        out = pa.Table.from_batches(simhash.verifier(3, 30)(batches)).to_pandas()
        late = out[out.deferred].b.value_counts()
        assert set(late.index) == set(fps[keys != 9]) and (late == 4).all()


def test_parts_meet_where_the_other_segment_is_near():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a = int(rng.integers(1 << 62))
        n = int(rng.integers(1, 4))
        b = a ^ sum(1 << int(x) for x in rng.choice(32, n, replace=False))
        pair = np.array([a, b], np.uint64)
        shared = np.intersect1d(*variants(pair)[:, 32:])  # the upper segment is equal
        under = [set(simhash.part_keys(shared, np.full(len(shared), f)).ravel().tolist())
                 for f in pair]
        assert len(shared) == 32 and len(under[0] & under[1]) >= 32


def test_a_large_sparse_variant_takes_little_more_than_linear_time():
    rng = np.random.default_rng(10)
    took = []
    for n in (20_000, 80_000):
        fps = np.unique(rng.integers(1 << 31, size=n, dtype=np.int64) << 32)
        table = pa.RecordBatch.from_pydict({"key": np.full(len(fps), 32), "fp": fps})
        began = time.time()
        late = pa.Table.from_batches(simhash.verifier(3, 4096)([table])).to_pandas()
        late = late.sort_values("a")
        again = pa.RecordBatch.from_pydict({"key": late.a.to_numpy(), "fp": late.b.to_numpy()})
        list(simhash.verifier(3, None)([again]))
        took.append(time.time() - began)
    assert took[1] < 12 * took[0]


def test_links_grow_with_members_not_with_pairs():
    rng = np.random.default_rng(3)
    prints = np.unique(np.array(
        [sum(1 << int(b) for b in rng.choice(30, 2)) for _ in range(400)], np.uint64))
    assert len(forest(prints, 3)) <= len(prints) - 1


def test_long_text_counts_every_shingle():
    words = " ".join(f"w{i}" for i in range(70_000))
    assert fingerprint(words.encode()) != fingerprint(words[:300_000].encode())
    assert fingerprint(b"A b\tC") == brute_fingerprint("a B c")


def test_distance_beyond_the_method_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_dedup(spark, cases.documents(spark, ["a"]), distance=4)
