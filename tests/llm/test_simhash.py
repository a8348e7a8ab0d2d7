from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from edgelog.llm import simhash as S
from edgelog.llm.components import components

from .helpers import awkward, none


def brute_print(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def smallest(n, pairs):
    root = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_documents_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [brute_print(text) for _, text in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = smallest(len(rows), pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.report(docs).collect()}
    assert got == {rows[i][0]: (f"{prints[i]:016x}", rows[root[i]][0]) for i in range(len(rows))}


def test_awkward_rows(spark):
    got = S.components_of(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].fp == by_id[4].fp == by_id[5].fp == 0
    assert by_id[4].component_id == by_id[5].component_id == 3
    assert by_id[None].component_id == by_id[2].component_id == 1
    kept = S.deduplicate(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 6, 7, 8]
    assert S.components_of(none(spark)).count() == 0


def test_null_and_repeated_ids_in_mixed_components(spark):
    rows = [(1, "a b c d"), (None, "a b c d"), (None, "e f g h"), (7, "i j k l"), (2, "i j k l"), (7, "m n o p"), (None, None), (9, "")]
    left = S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(1, "a b c d"), (None, "e f g h"), (2, "i j k l"), (7, "m n o p"), (9, "")], key=repr)


def chains(seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = list(rng.integers(0, 2**63, 50, dtype=np.int64))
    for base in out[:15]:
        now = int(base)
        for _ in range(90):
            for _ in range(int(rng.integers(1, 5))):
                now ^= 1 << int(rng.integers(0, 63))
            out.append(now)
    return np.unique(np.array(out, np.int64))


@pytest.mark.parametrize("limit", [2048, 2])
def test_no_link_is_lost_in_hot_keys(spark, limit):
    fps = chains(limit)
    near = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= 2
    root = S.stars(*np.nonzero(np.triu(near, 1)), len(fps))
    nodes = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    made = S.groups(nodes, limit)
    assert max(len(r.fps) for r in made.collect()) <= max(limit, 256)
    found = {r.node: r.root for r in components(made.mapInArrow(S._link, "u long, v long")).collect()}
    assert [found.get(int(f), int(f)) for f in fps] == [int(fps[r]) for r in root]


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_bit_slices_find_all_pairs(radius):
    fps = np.concatenate([chains(1)[:150], chains(2)[:3], chains(1)[:64]])
    sizes = np.array([150, 3, 64])
    a, b = S.linked_lanes(fps, sizes, radius)
    group = np.repeat(np.arange(3), sizes)
    near = (np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= radius) & (group[:, None] == group)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*map(list, np.nonzero(np.triu(near, 1)))))


def test_majority_of_many(spark):
    hashes = np.random.default_rng(3).integers(0, 2**64, 2000, dtype=np.uint64)
    counts = np.array([0, 1, 2, 255, 256, 1000, 486])
    at, want = 0, []
    for n in counts:
        part = [int(h) for h in hashes[at : at + n]]
        want.append(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in part) > n))
        at += n
    assert S.majority(hashes, counts).tolist() == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1100)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
