"""Chat formatting: collapse of cumulative snapshots, then rendering.

A chat log often holds a conversation many times, each copy a few turns longer.
Every turn gets the rolling hash of all turns up to it; a conversation whose last
rolling hash is found before the last turn of another one is a prefix of it and
is anti-joined away. Equal conversations are kept once (smallest conv_id). The
maximal conversations are rendered with role markers.

The rolling hash is the XOR of position-dependent turn hashes (two of 64 bits), so
it can be put together from blocks of turns. The turns are sorted by range over all
tasks, by conversation, number and content; a task's rows are cut into blocks of
``BLOCK``. A conversation that holds a third of all rows is many blocks, whatever its turn
numbers are (one number for all, or none), each windowed alone, with one row per
block to chain them.
Rendering too is per part of ``PART`` turns; almost every conversation is one part.

Defined cases: rows that repeat all of conv_id, turn, role and text count once;
turns with the same number follow by role, then by sha256 of the text, NULLs first, a NULL turn
number comes last; a NULL conv_id is a conversation; a NULL role is rendered as
``unknown`` and a NULL text as empty, and both differ from the empty string when
conversations are compared; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fingerprint, stage, table

BLOCK = 1024
PART = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _hashed(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
                                fingerprint(F.col("role"), F.col("text"), seed=1).alias("t1"),
                                fingerprint(F.col("role"), F.col("text"), seed=2).alias("t2"),
                                F.unhex(F.sha2("text", 256)).alias("key"))


def numbered_turns(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, turn, t1, t2, pos from 1, n_turns, p1, p2): every turn once, with its rolling prefix hash.

    Only hashes of role and text (t1, t2) are shuffled here, not the texts.
    """
    turns = _hashed(conversations).select("conv_id", "turn", "t1", "t2", "role", "key").distinct()
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("key")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    # The task in the upper bits, the row's place in it in the 33 lower ones.
    turns = turns.withColumn("rn", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    turns = turns.withColumn("block", F.col("at") - F.col("rn") + F.floor(F.col("rn") / F.lit(block)))
    turns = stage(turns.drop("role", "key", "at"), "chat-turns")

    chain = Window.partitionBy("conv_id").orderBy("block")
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    sizes = (turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("first"))
             .withColumns({"offset": F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1,
                           "n_turns": F.sum("n").over(Window.partitionBy("conv_id"))})
             .select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "offset", "n_turns"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    placed = turns.join(sizes, same).drop("c", "b").withColumn("pos", F.col("offset") + F.col("rn"))
    placed = stage(placed.withColumns({"h1": F.xxhash64("pos", "t1", "t2"), "h2": F.xxhash64("t2", "t1", "pos")})
                   .drop("offset"), "chat-placed")
    none = F.lit(0).cast("long")
    base = (placed.groupBy("conv_id", "block")
            .agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
            .select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                    F.coalesce(F.bit_xor("x1").over(before), none).alias("b1"),
                    F.coalesce(F.bit_xor("x2").over(before), none).alias("b2")))
    rolling = (Window.partitionBy("conv_id", "block").orderBy("rn")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (placed.join(base, same)
            .select("conv_id", "turn", "t1", "t2", "pos", "n_turns",
                    F.col("b1").bitwiseXOR(F.bit_xor("h1").over(rolling)).alias("p1"),
                    F.col("b2").bitwiseXOR(F.bit_xor("h2").over(rolling)).alias("p2")))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): the conversations that no longer one begins with, equal ones once."""
    whole = (turns.filter("pos = n_turns").groupBy("pos", "p1", "p2")
             .agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("first"),
                  F.count(F.lit(1)).alias("copies")))
    proper = turns.filter("pos < n_turns").select("pos", "p1", "p2").distinct()
    return (whole.join(proper, ["pos", "p1", "p2"], "left_anti")
            .select("first.conv_id", F.col("pos").alias("n_turns"), "copies"))


def format_chats(conversations: DataFrame, part: int = PART, block: int = BLOCK) -> DataFrame:
    """(conv_id, part, n_turns, copies, rendered) of the maximal conversations.

    Marker openings inside a text are split by a blank so that no text can pose as a turn.
    """
    turns = stage(numbered_turns(conversations, block), "chat-prefixes")
    best = maximal_conversations(turns).select(F.col("conv_id").alias("c"), "copies")
    kept = (turns.join(best, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("c", F.col("turn").alias("__turn"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"),
                    "pos", "n_turns", "copies"))
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("__turn"))
            & (F.col("t1") == F.col("__t1")) & (F.col("t2") == F.col("__t2")))
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                    F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(CLOSE + "\n"))
    # The texts meet their places only now; a set, as a turn that is logged twice has one place.
    return (_hashed(conversations).join(kept, same)
            .groupBy("conv_id", F.floor((F.col("pos") - 1) / F.lit(part)).alias("part"))
            .agg(F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"),
                 F.array_sort(F.collect_set(F.struct("pos", line.alias("line")))).alias("lines"))
            .select("conv_id", "part", "n_turns", "copies",
                    F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered")))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP9_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns,
             list({{'r': role, 't': text}} ORDER BY turn NULLS LAST, role NULLS FIRST, sha256(text) NULLS FIRST) AS turns,
             string_agg('{OPEN}' || coalesce(role, 'unknown') || chr(10) ||
                        replace(coalesce(text, ''), '<|', '< |') || '{CLOSE}' || chr(10), ''
                        ORDER BY turn NULLS LAST, role NULLS FIRST, sha256(text) NULLS FIRST) AS rendered
      FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT md5(turns[1:k]::VARCHAR) AS prefix
      FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM c)),
m AS (SELECT md5(turns::VARCHAR) AS whole, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY 1)
SELECT c.conv_id, 0::BIGINT AS part, c.n_turns, m.copies, c.rendered
FROM m JOIN c ON c.conv_id IS NOT DISTINCT FROM m.conv_id WHERE m.whole NOT IN (SELECT prefix FROM p)"""
