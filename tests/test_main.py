from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.operators import rank
from edgelog.plans.main import main
from tests.helpers import rows


@pytest.fixture(scope="module")
def lines_dir(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "lines")
    log.selectExpr(f"{fixture.wire_sql(L.VENDOR_37)} AS value").coalesce(1).write.text(path)
    return path


def test_archive_then_check_and_rank(spark, log, lines_dir, tmp_path):
    out, c = str(tmp_path / "out"), str(tmp_path / "c")
    for job in ("archive-stream", "band-stream", "detail-stream"):
        main([job, "--path", lines_dir, "--out", out, "--checkpoint", f"{c}/{job}"], spark)
    archive = f"{out}/archive"
    # Long ago by the clock, so the archive is monthly and the rollups are in the error index.
    assert {r[0] for r in spark.read.parquet(archive).select(F.col("table_suffix").cast("string")).distinct().collect()} == {"202401"}
    day = ("202401010000", "202401020000")
    main(["check-band", archive, out, f"{out}/check", *day], spark)
    report = spark.read.parquet(f"{out}/check")
    assert {r.is_normal for r in report.collect()} <= {"Y", "N"}
    assert report.agg(F.sum("archive_req_count")).first()[0] == log.count()
    assert report.agg(F.sum("band_req_count")).first()[0] == log.where("body_bytes_sent <> '-'").count()
    main(["rebuild-band", archive, out, *day], spark)
    check = ["check-band", archive, out, f"{out}/check2", *day]
    main(check, spark)
    assert rows(spark.read.parquet(f"{out}/check2")) == rows(report)
    main(["rank-archive", archive, f"{out}/top", *day, "--top", "5"], spark)
    assert rows(spark.read.parquet(f"{out}/top")) == rows(rank.top_union(rank.url_hour(log), 5))
    main(["export-logs", f"{out}/detail", f"{out}/pkg", "1704067200", "1704081600", "--indices", "vendor-ws-*"], spark)
    assert spark.read.text(f"{out}/pkg").count() == log.where("firm_name = 'WS' AND body_bytes_sent <> '-'").count()


def test_sql_and_rank_streams(spark, log, lines_dir, tmp_path):
    out, c = str(tmp_path / "out"), str(tmp_path / "c")
    query = "SELECT domain, count(*) AS n FROM logs GROUP BY domain"
    main(["sql-stream", "--path", lines_dir, "--out", out, "--checkpoint", f"{c}/sql", "--sql", query], spark)
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == log.where("body_bytes_sent <> '-'").count()
    main(["rank-stream", "--path", lines_dir, "--out", f"{out}/r", "--checkpoint", f"{c}/rank", "--top", "2"], spark)
    top = spark.read.parquet(f"{out}/r/rank")
    assert rows(top, ["domain", "request", "traffic"]) == rows(rank.top_union(rank.url_hour(log), 2), ["domain", "request", "traffic"])
