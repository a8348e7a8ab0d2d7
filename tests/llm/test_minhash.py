from __future__ import annotations

import re

import numpy as np

import corpus_pipeline as P
from edgelog.llm import minhash as M, simhash

from .helpers import awkward, none

DOCS = "doc_id long, text string"


def changed(rng, words, n):
    words = list(words)
    for at in (np.arange(n) * (len(words) // max(n, 1)) + 7).tolist():
        words[at] = f"new{rng.integers(10**9)}"
    return words


def alike(a, b):
    left, right = ({" ".join(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return len(left & right) / len(left | right)


def one_of_each(rows):
    """Smallest id of every component of texts at 0.8 or more, each pair compared on its whole sets."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = [re.findall(r"[^\x20\x09-\x0D]+", low(t)) for _, t in rows]
    sets = [{" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for shingle in s or {None}:
            where.setdefault(shingle, []).append(i)
    pairs = {(a, b) for held in where.values() for n, a in enumerate(held) for b in held[n + 1 :]}
    for a, b in pairs:
        if top(a) != top(b) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            root[top(a)] = top(b)
    return {min(rows[i][0] for i in range(len(rows)) if top(i) == r) for r in map(top, range(len(rows)))}


def test_large_groups_are_whole(spark, monkeypatch):
    """Copies of one text whose links mostly lie beside any center, in keys of many blocks."""
    monkeypatch.setattr(M, "BLOCK", 32)
    monkeypatch.setattr(M, "NEAR", 58)  # sketches alone may pass over one pair in 5000
    rng = np.random.default_rng(4)
    rows = []
    for places in (19, 21):
        base = [f"w{i}" for i in rng.integers(0, 50_000, 1500)]
        for _ in range(60):
            words = list(base)
            for at in rng.choice(1500, places, replace=False).tolist():
                words[at] = f"new{rng.integers(10**9)}"
            rows.append((len(rows), " ".join(words)))
    want = one_of_each(rows)
    assert 10 < len(rows) - len(want) < len(rows) - 10
    left = {r.doc_id for r in M.deduplicate(spark.createDataFrame(rows, DOCS)).collect()}
    assert left == want


def test_proposals_go_on_until_none_is_left(spark, monkeypatch):
    """A node's nearest are refuted first; what lies behind them is still found."""
    monkeypatch.setattr(M, "NEAR", 40)
    monkeypatch.setattr(M, "BLOCK", 4)
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in rng.integers(0, 50_000, 400)]
    rows = []
    for n in (0, 9, 9, 9, 9, 9, 5, 13, 13, 13, 8, 8, 8):
        rows.append((len(rows), " ".join(changed(rng, [*base[len(rows) :], *base[: len(rows)]], n))))
    left = {r.doc_id for r in M.deduplicate(spark.createDataFrame(rows, DOCS)).collect()}
    assert left == one_of_each(rows)


def test_near_copies_at_four_fifths_go(spark, sf):
    rng = np.random.default_rng(1)
    texts, near = [], set()
    for _ in range(60):
        base = [f"w{i}" for i in rng.integers(0, 20000, 300)]
        texts.append(base)
        for n in (1, 3, 6):
            texts.append(changed(rng, base, n))
            assert alike(base, texts[-1]) >= 0.8
            near.add(len(texts) - 1)
        texts.append(changed(rng, base, 12))
        assert alike(base, texts[-1]) < 0.75
    hot = [f"w{i}" for i in rng.integers(0, 20000, 300)]
    texts.append(hot)
    for _ in range(48):
        texts.append(changed(rng, hot, 2))
        near.add(len(texts) - 1)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], DOCS)
    left = {r.doc_id for r in P.near(spark, docs, sf).collect()}
    assert left == set(range(len(texts))) - near


def test_fingerprints_propose_what_lies_within_two_bits(spark, monkeypatch):
    """Without any MinHash key, copies within the radius of simhash still go, and no others."""
    keyed = M._met
    monkeypatch.setattr(M, "_met", lambda nodes: keyed(nodes).limit(0))
    rng = np.random.default_rng(8)
    rows, near, far = [], set(), 0
    for n in [1] * 12 + [2] * 4 + [0, 8, 8]:
        base = [f"w{i}" for i in rng.integers(0, 50_000, 1500)]
        copy = [*changed(rng, base, n), "end"]  # one shingle more, even where no word differs
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
        prints = [simhash.majorities([simhash.shingle_hashes(t, 5)])[0].view(np.uint64) for _, t in rows[-2:]]
        if int(prints[0] ^ prints[1]).bit_count() <= simhash.RADIUS:
            near.add(rows[-1][0])
        else:
            far += 1
    assert len(near) > 3 and far
    left = {r.doc_id for r in M.deduplicate(spark.createDataFrame(rows, DOCS)).collect()}
    assert left == set(range(len(rows))) - near


def test_rows_without_or_with_repeated_ids(spark):
    kept = M.deduplicate(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 6, 7, 8]
    assert M.deduplicate(none(spark)).count() == 0
    rows = [(1, "a b c d"), (None, "a b c d"), (None, "e f g h"), (7, "i j k l"), (2, "i j k l"), (7, "m n o p"), (9, ""), (None, None)]
    left = M.deduplicate(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(1, "a b c d"), (None, "e f g h"), (2, "i j k l"), (7, "m n o p"), (9, "")], key=repr)


def test_sets_of_many_nodes_leave_the_texts_where_they_lie(spark, monkeypatch, capsys):
    docs = awkward(spark).union(spark.range(10, 400).selectExpr("id", "concat('a b c d e ', id % 90)", "'en'", "'a'", "1", "'x'"))
    base = docs.select("doc_id", M._node("text").alias("node"), "text")
    wanted = base.filter("doc_id % 3 = 1").select("node").distinct()
    few = {(bytes(r.node), bytes(r.hashes)) for r in M._sets_of(wanted, base).collect()}
    whole = sorted(map(str, M.deduplicate(docs).collect()))
    monkeypatch.setattr(M, "FEW", 0)
    many = M._sets_of(wanted, base)
    assert {(bytes(r.node), bytes(r.hashes)) for r in many.collect()} == few and len(few) == wanted.count()
    many.explain()
    plan = capsys.readouterr().out
    assert plan.index("Join") < plan.rindex("MapInArrow")
    bits = M._bitmap(wanted)
    assert sum(M._marked(batch, bits).num_rows for batch in base.select("node", "text").toArrow().to_batches()) == base.join(wanted, "node", "left_semi").count() < base.count()
    assert sorted(map(str, M.deduplicate(docs).collect())) == whole
