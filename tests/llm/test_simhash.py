import random

import numpy as np
import pytest
import xxhash

from corpusflow.llm import simhash
from tests.llm.cases import documents, odd_rows, prose


def bits(text, k=4):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(items, linked):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def mutated(text, share, rnd):
    return " ".join(w if rnd.random() > share else w + "x" for w in text.split())


@pytest.mark.parametrize("shard", [simhash.SHARD, 20])  # one shard; many leaves and blocks
def test_components_against_brute_force(spark, shard):
    rnd = random.Random(6)
    rows = [(i, prose(i, rnd.choice([3, 8, 40, 200])), None, None) for i in range(80)]
    rows += [(100 + i, mutated(rows[i % 20][1], 0.01, rnd).upper(), None, None) for i in range(100)]
    rows += [(300 + i, mutated(prose(1, 300), 0.004, rnd), None, None) for i in range(60)] + odd_rows()
    found = simhash.grouped(documents(spark, rows), shard=shard).collect()
    prints = [bits(t) for _, t, _, _ in rows]
    roots = grouped(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, *_), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    key = lambda x: (x[0] is None, x[0], x[1])
    got = sorted(((r["doc_id"], r["fp"].hex(), r["rep"]["doc_id"]) for r in found), key=key)
    assert got == sorted(((row[0], f"{p:016x}", least.get(r)) for row, p, r in zip(rows, prints, roots, strict=True)), key=key)
    assert len(set(roots)) < len(rows) - 60


def test_tree_excludes_no_pair_and_local_search_is_exact():
    rnd = np.random.default_rng(1)
    fps = rnd.integers(0, 2**63, (4000, 1)).astype(np.uint64)
    fps[2000:] = fps[:2000] ^ (np.uint64(1) << rnd.integers(0, 64, (2000, 1)).astype(np.uint64))
    tree = simhash.Tree(fps[:500], 4, 4)
    home, (rows, leaves) = tree.homes(fps), tree.visits(fps)
    seen = set(zip(rows.tolist(), leaves.tolist(), strict=True))
    assert all((i, home[i + 2000]) in seen and (i + 2000, home[i]) in seen for i in range(2000))
    assert tree.leaves == 16 and len(rows) < 0.8 * 16 * len(fps)
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i])[:, 0] <= 4)]
    root = simhash.Local(fps, len(fps), 4).root
    assert all(root[i] == root[j] for i, j in near) and len(set(root)) == len(fps) - len(near)


def test_longer_fingerprints_tell_similarity():
    rnd = random.Random(9)
    for share in (0.02, 0.05, 0.1):
        a = prose(50, 2000)
        b = mutated(a, share, rnd)
        hashes = [simhash.shingle_hashes(t, 5) for t in (a, b)]
        sets = [set(h.tolist()) for h in hashes]
        similar = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        fa, fb = (simhash._matrix([simhash.fingerprint(h, 16)], 16) for h in hashes)
        expected = 1024 * np.arccos(2 * similar / (1 + similar)) / np.pi
        assert abs(int(simhash._distance(fa, fb)[0]) - expected) < 50


def test_stars_find_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(40)]  # and a chain
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    linked = {frozenset(e) for e in edges}
    roots = grouped(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert found == {n: nodes[r] for n, r in zip(nodes, roots, strict=True)}


def test_one_of_each_keeps_the_first(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, prose(i, 120), None, None) for i in range(40)]
    rows += [(100 + i, mutated(rows[i][1], 0.005, rnd), None, None) for i in range(20)] + [(i, rows[i][1], None, None) for i in range(5)]
    documents(spark, rows).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    # with fingerprints long enough for a similarity of words
    kept = simhash.one_of_each(docs, radius=166, shingle=5, words=16, ratio=0.8, coarse=(4, 64))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/odd")
    assert simhash.one_of_each(spark.read.parquet(f"{tmp_path}/odd")).count() == 9  # five empty ones and three equal ones become two
    documents(spark, []).write.parquet(f"{tmp_path}/none")
    assert simhash.one_of_each(spark.read.parquet(f"{tmp_path}/none")).count() == 0
    assert simhash.grouped(documents(spark, [])).count() == 0


def test_one_of_each_holds_when_splits_change(spark, tmp_path, monkeypatch):
    rows = [(i, prose(i // 2, 40), "en", None) for i in range(200)]
    documents(spark, rows).repartition(8).write.parquet(f"{tmp_path}/docs")
    whole, size = simhash.grouped, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)

    def other_splits(*args, **settings):
        groups = simhash.settle(whole(*args, **settings))
        spark.conf.set(size, "1k")  # as if executors had joined or been lost since the first scan
        return groups

    monkeypatch.setattr(simhash, "grouped", other_splits)
    try:
        kept = [r["doc_id"] for r in simhash.one_of_each(spark.read.parquet(f"{tmp_path}/docs")).collect()]
    finally:
        spark.conf.set(size, before)
    assert sorted(kept) == list(range(0, 200, 2))


def test_one_of_each_against_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, prose(i, 150), None, None) for i in range(60)]
    rows += [(100 + i, mutated(rows[i % 60][1], 0.01, rnd), None, None) for i in range(90)]
    documents(spark, rows).write.parquet(f"{tmp_path}/docs")
    fps = {i: int.from_bytes(simhash.fingerprint(simhash.shingle_hashes(t, 4)), "big") for i, t, _, _ in rows}
    group = {i: i for i in fps}
    for i in sorted(fps):
        for j in fps:
            if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(spark.read.parquet(f"{tmp_path}/docs")).collect())
    assert kept == sorted(set(group.values())) and 60 <= len(kept) < 150
