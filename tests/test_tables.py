"""How tables lie on disk: snapshots, coverage as intervals, clustered and indexed archives."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog.operators import archive
from edgelog.plans.main import main
from edgelog.sinks import archive_layout as A, snapshots as S, writers as W
from edgelog.sources import readers
from tests.helpers import plan, rows

VALUES = "id string, v int, index_name string"


def _put(spark, base, batch, *values, writer="w", run=0):
    W.routed_upsert(spark.createDataFrame(list(values), VALUES), base, batch, writer=writer, run=run)


def _same(spark, base, target):
    """The reader of a snapshot gives what a ranking of every batch gives."""
    want = W.latest(W.read_routed(spark, base), ["index_name", "id"]).drop("writer", "run", "batch")
    got = S.newest_rows(spark, base, target)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_snapshots_equal_a_ranking_of_all_batches(spark, tmp_path):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    _put(spark, base, 0, ("a", 1, "x"), ("b", 1, "x"), ("a", 5, "y y=%"))
    _same(spark, base, target)  # no snapshot yet
    assert S.refresh(spark, base, target) == [("x",), ("y y=%",)]
    _same(spark, base, target)
    assert S.refresh(spark, base, target) == []
    _put(spark, base, 1, ("a", 2, "x"), ("c", 1, "x"))
    _put(spark, base, 0, ("b", 9, "x"), writer="other", run=3)  # a later run wins whatever its batch
    _put(spark, base, 0, ("new", 0, "z"), writer="third")
    _same(spark, base, target)
    assert S.refresh(spark, base, target) == [("x",), ("z",)]
    _same(spark, base, target)
    _put(spark, base, 2, ("b", 3, "x"))
    _same(spark, base, target)
    main(["refresh-snapshot", base, target], spark)
    _same(spark, base, target)
    assert {r.id: r.v for r in S.newest_rows(spark, base, target).where("index_name = 'x'").collect()} == {"a": 2, "b": 9, "c": 1}


def test_a_batch_that_runs_again_is_read_again(spark, tmp_path):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    _put(spark, base, 0, ("a", 1, "x"), ("b", 1, "x"))
    _put(spark, base, 1, ("a", 2, "x"))
    S.refresh(spark, base, target)
    _put(spark, base, 1, ("b", 7, "x"))
    _same(spark, base, target)
    assert S.refresh(spark, base, target) == [("x",)]
    _same(spark, base, target)
    assert rows(S.newest_rows(spark, base, target), ["id", "v"]) == [("a", 1), ("b", 7)]


def test_a_refresh_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    _put(spark, base, 0, ("a", 1, "x"))
    S.refresh(spark, base, target)
    _put(spark, base, 1, ("a", 2, "x"))
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        S.refresh(spark, base, target)
    monkeypatch.undo()
    assert S.marks(spark, target).version == 1
    _same(spark, base, target)
    S.refresh(spark, base, target)
    _same(spark, base, target)


def test_only_touched_folders_are_read_and_the_snapshot_is_not_shuffled(spark, tmp_path, monkeypatch):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    for index in "pqr":
        _put(spark, base, 0, *[(f"{i}", i, index) for i in range(50)])
    S.refresh(spark, base, target)
    _put(spark, base, 1, ("3", 99, "q"))
    read = []
    batches = S._batches
    monkeypatch.setattr(S, "_batches", lambda sp, b, p, wanted, schema: read.extend(wanted) or batches(sp, b, p, wanted, schema))
    assert S.refresh(spark, base, target) == [("q",)]
    assert [(f.part, f.batch) for f in read] == [(("q",), 1)]
    _put(spark, base, 2, ("4", 98, "q"))
    found = S.newest_rows(spark, base, target)
    text = plan(found.where("index_name <> ''"))
    assert f"{base}/index_name=q/writer=w/run=0/batch=1" not in "".join(f for f in found.inputFiles())
    assert "LeftAnti" in text
    _same(spark, base, target)


def test_clashing_and_composite_keys(spark, tmp_path):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    frame = lambda *r: spark.createDataFrame(list(r), "k1 string, k2 int, _new_k1 string, day string, kind string")
    for batch, data in enumerate(([("a", 1, "p", "1", "u"), ("a", None, "q", "1", "u")], [("a", None, "r", "1", "u"), (None, 2, "s", "2", "v")])):
        W.routed_upsert(frame(*data), base, batch, part=["day", "kind"], writer="w")
        if batch == 0:
            S.refresh(spark, base, target, ["k1", "k2"], ["day", "kind"])
    got = S.newest_rows(spark, base, target, ["k1", "k2"], ["day", "kind"])
    assert rows(got, ["k1", "k2", "_new_k1"]) == sorted([("p", "a", 1), ("r", "a", None), ("s", None, 2)], key=repr)


# ---- coverage ----------------------------------------------------------------------

COVER = "firm_name string, start bigint, end bigint, run bigint"


def _brute(ranges, firm):
    out = {}
    for f, a, e, run in ranges:
        if f == firm and a is not None and e is not None:
            for t in range(a, e, 60):
                out[t] = max(out.get(t, 0), run)
    return out


def test_intervals_are_disjoint_and_newest(spark):
    ranges = [(None, 0, 600, 1), (None, 300, 900, 3), (None, 300, 420, 2), ("a", 0, 60, 5), ("a", 60, 120, 5), ("a", 30 * 60, 30 * 60, 9), (None, 900, 960, 3), (None, 2000, 1000, 8), ("a", None, 60, 9)]
    found = W.coverage_intervals(spark.createDataFrame(ranges, COVER)).collect()
    assert sorted(((r.firm_name, r.start, r.end, r.run) for r in found), key=repr) == sorted([(None, 0, 300, 1), (None, 300, 960, 3), ("a", 0, 120, 5)], key=repr)


def test_rows_that_count_for_any_mix_of_rebuilds(spark):
    import random

    rng = random.Random(5)
    ranges = [(rng.choice([None, "a", "b"]), s := 60 * rng.randrange(200), s + 60 * rng.choice([1, 5, 40, 3000]), run) for run in range(1, 25)]
    data = [(f, 60 * t, run) for f in ("a", "b", "c", None) for t in range(0, 3300, 7) for run in (0, *range(1, 25, 5), 7, 12)]
    df = spark.createDataFrame(data, "firm_name string, from_time bigint, run bigint")
    whole, own = _brute(ranges, None), {f: _brute(ranges, f) for f in ("a", "b")}
    want = [(f, t, run) for f, t, run in data if run == max(whole.get(t, 0), own.get(f, {}).get(t, 0))]
    got = W.effective_band(df, spark.createDataFrame(ranges, COVER))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    none = W.effective_band(df, spark.createDataFrame([], COVER))
    assert rows(none) == rows(df.where("run = 0"))


def test_coverage_does_not_grow_with_the_length_of_a_range(spark):
    year = 365 * 86400
    ranges = [(None, 0, year, 1), (None, 86400, year, 2), ("a", 0, 600, 3)]
    assert W.coverage_intervals(spark.createDataFrame(ranges, COVER)).count() == 3
    df = spark.createDataFrame([("a", 0, 3), ("a", 600, 1), ("b", 90000, 2), ("b", 90000, 1), ("b", year, 0)], "firm_name string, from_time bigint, run bigint")
    got = W.effective_band(df, spark.createDataFrame(ranges, COVER))
    assert rows(got) == rows(df.where("NOT (from_time = 90000 AND run = 1)"))
    assert "sequence(" in plan(got)


# ---- archive -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("archive") / "a")
    W.write_archive(fixture.archive(spark, sf), base, 0, writer="w")
    return base


def _groups(path, holds):
    """Row groups that a test on least and greatest values cannot rule out, and all of them."""
    kept = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(names.index(n)).statistics for n in ("firm_name", "log_minute")}
            total += 1
            kept += holds(stats)
    return kept, total


def test_a_firm_and_a_minute_read_few_row_groups(spark, sf, stored, tmp_path):
    target = str(tmp_path / "z")
    A.cluster(spark, stored, target, file_rows=60)
    a, b = (W.read_routed(spark, p, ["table_suffix"]).drop("writer", "run", "batch") for p in (stored, target))
    assert rows(a) == rows(b)
    firm = lambda s: s["firm_name"].min <= "WS" <= s["firm_name"].max
    minute = lambda s: s["log_minute"].min <= "202401010901" <= s["log_minute"].max
    for holds in (firm, minute, lambda s: firm(s) and minute(s)):
        kept, total = _groups(target, holds)
        assert total > 8 and kept < 0.7 * total
    both, total = _groups(target, lambda s: firm(s) and minute(s))
    assert both < 0.35 * total


def test_morton_code_takes_bits_in_turn(spark):
    df = spark.range(1 << 8).selectExpr("CAST(id % 16 AS INT) AS a", "CAST(id div 16 AS INT) AS b")
    for r in df.withColumn("z", A._interleaved(F.col("a"), F.col("b"))).collect():
        want = sum(((r.a >> i & 1) << (2 * i + 1)) + ((r.b >> i & 1) << (2 * i)) for i in range(8))
        assert r.z == want


def test_an_index_of_keys_rules_files_out_and_no_row(spark, sf, stored, tmp_path):
    target, index = str(tmp_path / "z"), str(tmp_path / "i")
    A.cluster(spark, stored, target, file_rows=60)
    table = W.read_routed(spark, target, ["table_suffix"])
    files = len(table.inputFiles())
    assert A.index_keys(spark, target, index) == files and A.index_keys(spark, target, index) == 0
    some = table.select("row_key").first()[0]
    for text, fewer in (("0#!BS#", False), ("#!BS#", True), (some, True), (some[3:25], True), ("!W", False), ("", False), ("no such text", True)):
        found = A.scan_containing(spark, target, index, text)
        assert rows(found) == rows(archive.archive_key_contains(table, text)), text
        if fewer:
            assert files - len(A.ruled_out(spark, index, text)) < files, text
    W.write_archive(fixture.archive(spark, sf).limit(3), target, 1, writer="w")
    assert A.scan_containing(spark, target, index, "#").count() == table.count() + 3
    assert A.index_keys(spark, target, index) > 0
    assert A.scan_containing(spark, target, index, "#!").count() == table.count() + 3


def test_index_names_stand_for_themselves(spark):
    df = spark.createDataFrame([("a%b",), ("axb",), ("a_b",), ("a\\b",), ("abc",)], "index_name string")
    names = lambda n: [r[0] for r in readers.index_wildcard(df, n).collect()]
    assert names("a%b") == ["a%b"] and names("a_b") == ["a_b"] and names("a\\b") == ["a\\b"]
    assert names("a*") == ["a%b", "axb", "a_b", "a\\b", "abc"]


def test_small_files_do_not_make_as_many_tasks(spark, stored, tmp_path, monkeypatch):
    """Rows are dealt by the rows a task sorts, not by file; no table is heaped in one task for its span."""
    dealt = []
    by_range = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *by: dealt.append((n, plan(df))) or by_range(df, n, *by))
    A.cluster(spark, stored, str(tmp_path / "z"), file_rows=10)
    (tasks, how), = dealt
    assert tasks == 1 and "SortMergeJoin" not in how
    assert max(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/z/**/*.parquet", recursive=True)) == 10
    table = W.read_routed(spark, str(tmp_path / "z"), ["table_suffix"])
    assert rows(table.drop("writer", "run", "batch")) == rows(W.read_routed(spark, stored, ["table_suffix"]).drop("writer", "run", "batch"))
