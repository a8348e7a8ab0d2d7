"""Chat formatting with Spark expressions only.

A conversation is one string: turns in order, adjacent turns of one role under one header.

    ### role<says>text<next>text</turn>

In roles and texts ``\\`` becomes ``\\s``, ``<`` becomes ``\\l`` and ``#`` becomes ``\\h``, so
none of the template's marks can occur in them, and the way back is exact. The loss mask
is a list of code point ranges of the string that cover the texts of the trained role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAD, SAYS, NEXT, END = "### ", "<says>", "<next>", "</turn>\n"
#: Fixed values of the template: character and its escape, in the order of escaping.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
TRAINED = "assistant"
#: Texts whose places are summed one by one.
STEP = 256


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def collected(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: escaped role and text structs in turn order; ties go by role, then text."""
    role, text = (escape(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("role", "text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", role, text)))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def merged(turns: Column) -> Column:
    """Adjacent turns of one role as one struct of the role and all their texts, linear in the turns."""
    places = F.sequence(F.lit(1), F.size(turns))
    role = lambda i: F.try_element_at(turns, i)["role"]
    starts = F.filter(places, lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))
    ends = F.filter(places, lambda i: (i == F.size(turns)) | (role(i) != role(F.least(i + 1, F.size(turns)))))

    def run(start: Column, end: Column) -> Column:
        texts = F.transform(F.slice(turns, start, end - start + 1), lambda t: t["text"])
        return F.struct(role(start).alias("role"), texts.alias("texts"))

    return F.zip_with(starts, ends, run)


MASK = "array<struct<start: int, length: int, byte_start: int, bytes: int>>"


def _sizes(blocks: Column) -> Column:
    """Per text: what stands before it, its own length, and what ends the last text of a block, in code points and bytes."""

    def size(b: Column, t: Column, i: Column) -> Column:
        first, fixed = i == 0, len(HEAD) + len(SAYS)
        return F.struct(
            F.when(first, F.length(b["role"]) + fixed).otherwise(len(NEXT)).alias("before"), F.length(t).alias("length"),
            F.when(first, F.octet_length(b["role"]) + fixed).otherwise(len(NEXT)).alias("byte_before"), F.octet_length(t).alias("bytes"),
            F.when(i == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("after"), (b["role"] == TRAINED).alias("trained"),
        )

    return F.flatten(F.transform(blocks, lambda b: F.transform(b["texts"], lambda t, i: size(b, t, i))))


def _ranges(sizes: Column) -> Column:
    """The places of every text of the trained role in the string.

    ``sizes`` must be a column by itself. Running sums go over ``STEP`` texts at a time and then over
    those, as an array that grows text by text is copied each time.
    """

    def step(done: Column, t: Column) -> Column:
        start, byte = done["end"] + t["before"], done["byte_end"] + t["byte_before"]
        here = F.array(F.struct(start.alias("start"), t["length"].alias("length"), byte.alias("byte_start"), t["bytes"].alias("bytes")))
        return F.struct(
            (start + t["length"] + t["after"]).alias("end"), (byte + t["bytes"] + t["after"]).alias("byte_end"),
            F.when(t["trained"], F.concat(done["mask"], here)).otherwise(done["mask"]).alias("mask"),
        )

    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("byte_end"), F.expr(f"cast(array() as {MASK})").alias("mask"))
    starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(STEP))).otherwise(F.expr("cast(array() as array<int>)"))
    parts = F.transform(starts, lambda i: F.aggregate(F.slice(sizes, i, STEP), none, step))

    def after(done: Column, part: Column) -> Column:
        moved = F.transform(
            part["mask"],
            lambda m: F.struct(
                (m["start"] + done["end"]).alias("start"), m["length"].alias("length"), (m["byte_start"] + done["byte_end"]).alias("byte_start"), m["bytes"].alias("bytes"),
            ),
        )
        return F.struct(
            (done["end"] + part["end"]).alias("end"), (done["byte_end"] + part["byte_end"]).alias("byte_end"), F.concat(done["masks"], F.array(moved)).alias("masks"),
        )

    empty = F.struct(F.lit(0).alias("end"), F.lit(0).alias("byte_end"), F.expr(f"cast(array() as array<{MASK}>)").alias("masks"))
    return F.flatten(F.aggregate(parts, empty, after)["masks"])


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, mask``: one row per conversation.

    ``rows`` has ``conv_id, turn, role, text``. Null roles and texts count as empty, a null
    turn comes first, rows without a conversation form one of their own. Repeated rows
    are turns. ``mask`` lists start (from 0) and length, in code points of ``formatted``,
    of every text of the trained role, and the same in bytes of UTF-8. Other columns are not
    read; no rows give none.

    A conversation is a row and so must fit a task, its string 2 GB; time is linear in its turns up
    to some 100,000 of them.
    """
    blocks = collected(rows).select("conv_id", merged(F.col("turns")).alias("blocks"))

    def block(b: Column) -> Column:
        return F.concat(F.lit(HEAD), b["role"], F.lit(SAYS), F.array_join(b["texts"], NEXT), F.lit(END))

    sized = blocks.select("conv_id", "blocks", _sizes(F.col("blocks")).alias("sizes"))
    return sized.select("conv_id", F.array_join(F.transform("blocks", block), "").alias("formatted"), _ranges(F.col("sizes")).alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: structs of role and text, unescaped."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def turns(b: Column) -> Column:
        halves = F.split(b, SAYS)
        role = unescape(F.substr(halves[0], F.lit(len(HEAD) + 1)))
        return F.transform(F.split(halves[1], NEXT), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def under_mask(raw: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order; ``raw``, a column by itself, has the bytes of the string."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(raw, m["byte_start"] + 1, m["bytes"]).cast("string"))), "")


def report(rows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted string and its mask."""
    made = format_conversations(rows).select("conv_id", "formatted", "mask", F.col("formatted").cast("binary").alias("raw"))
    read = made.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), under_mask(F.col("raw"), F.col("mask")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -7, whose texts are full of marks."""
    said = r"\### Assistant: </turn> ok"
    probe = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return rows.select("conv_id", "turn", "role", "text").union(probe)
