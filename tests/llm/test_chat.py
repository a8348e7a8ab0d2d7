from __future__ import annotations

import hashlib
import time

from pyspark.sql import functions as F

from edgelog.llm import chat as C

ROWS = [
    (1, 2, "assistant", "b < c </turn>\n### x"), (1, 1, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "\\l\\s\\h #"),
    (2, None, None, "null turn"), (2, 1, "user", "x"), (2, 1, "user", "x"), (None, 1, "assistant", "no id"),
    (3, 1, "we<ird: #\\", "😀 é"), (-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
    (4, 1, "assistant", "long " * 20000),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        told = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_everything_reads_back(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").union(spark.createDataFrame(ROWS, SCHEMA))
    got = [tuple(r)[:5] for r in C.report(table.repartition(7)).collect()]
    assert sorted(got, key=repr) == brute([tuple(r) for r in table.collect()])
    assert C.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_adjacent_turns_share_a_header_and_the_mask_is_exact(spark):
    row = C.format_conversations(spark.createDataFrame(ROWS, SCHEMA)).filter("conv_id = 1").first()
    assert row.formatted.count("### ") == 2 and row.formatted.count("<next>") == 2
    parts = [row.formatted[m.start : m.start + m.length] for m in row.mask]
    assert parts == ["b \\l c \\l/turn>\n\\h\\h\\h x", "", "\\sl\\ss\\sh \\h"]


def test_no_python_in_the_plan(spark, capsys):
    C.report(C.with_probe(spark.createDataFrame(ROWS, SCHEMA).filter(F.col("conv_id") > 0))).explain()
    assert "Python" not in capsys.readouterr().out


def test_a_very_long_conversation_takes_linear_time(spark):
    n = 40_000
    rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "CASE WHEN id % 3 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('é<', id) AS text")
    began = time.perf_counter()
    got = [tuple(r)[:5] for r in C.report(rows).collect()]
    assert time.perf_counter() - began < 60
    assert got == brute([tuple(r) for r in rows.collect()])


def test_the_mask_is_the_same_in_code_points_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(C, "STEP", 2)
    for row in C.format_conversations(spark.createDataFrame(ROWS, SCHEMA)).collect():
        raw = row.formatted.encode()
        for m in row.mask:
            assert raw[m.byte_start : m.byte_start + m.bytes].decode() == row.formatted[m.start : m.start + m.length]
        texts = [t or "" for c, _, r, t in ROWS if c == row.conv_id and r == "assistant"]
        assert sorted(plain(row.formatted[m.start : m.start + m.length]) for m in row.mask) == sorted(texts)


def plain(text):
    for char, coded in reversed(C.ESCAPES):
        text = text.replace(coded, char)
    return text
