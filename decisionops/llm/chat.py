"""Chat formatting by cumulative-snapshot collapse (native operations only).

Chat services log a conversation again after every turn, so the log holds many
conversations that are prefixes of longer ones.  Every conversation gets a
rolling hash over its turns; its value after turn k names the prefix of k
turns.  A conversation whose last value is a proper-prefix value of any other
one is a snapshot and is removed by an anti-join; equal conversations keep
the smallest id.  What is left is rendered once.

Group sizes: a conversation is one output row, so its turns meet in one row;
its prefixes are rows of hashes, so the work is linear in its turns.  A common
first turn or a common conversation only meets in partial aggregates (minimum,
distinct), never in one task.

Cases: a null role or text counts as empty; turns are ordered by (turn, role,
text) with a null turn first; repeated equal rows of a conversation count
once; rows with a null conv_id form one conversation with a null id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

# ChatML-like markers.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def prefix_hashes(convs: DataFrame) -> DataFrame:
    """key, n_turns, k, h1, h2: the rolling hash after turn k of every conversation (key, turns)."""
    turns = convs.select("key", F.size("turns").alias("n_turns"), F.posexplode("turns").alias("at", "t"))
    so_far = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def rolling(seed: str) -> Column:
        return F.bit_xor(F.xxhash64(F.lit(seed), "at", F.sha2("t.role", 256), F.sha2("t.text", 256))).over(so_far)

    return turns.select("key", "n_turns", (F.col("at") + 1).alias("k"), rolling("first").alias("h1"),
                        rolling("second").alias("h2"))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(
        F.lit(TURN_START), t["role"], F.lit("\n"), t["text"], F.lit(TURN_END + "\n"))))


def maximal_conversations(log: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies (equal conversations, itself included), turns."""
    rows = log.select("conv_id", F.struct(F.col("turn").alias("turn"), text_or_empty("role").alias("role"),
                                          text_or_empty("text").alias("text")).alias("t"))
    lone = F.concat_ws("|", F.coalesce(F.col("t.turn").cast("string"), F.lit("-")),
                       F.sha2("t.role", 256), F.sha2("t.text", 256))
    key = F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.concat(F.lit("n"), lone))
    rows = rows.withColumn("key", key)
    # null ids: how often the equal row occurs is kept, as each is a conversation
    convs = stored(rows.groupBy("key", "conv_id").agg(
        F.sort_array(F.collect_set("t")).alias("turns"),
        F.when(F.col("conv_id").isNull(), F.count(F.lit(1))).otherwise(F.lit(1)).alias("rows")), "chat_conversations")
    hashes = stored(prefix_hashes(convs), "chat_prefixes")
    whole = hashes.where("k = n_turns").join(convs.select("key", "conv_id", "rows"), "key")
    first = F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id", "key"))
    own = whole.groupBy("h1", "h2").agg(first.alias("first"), F.sum("rows").alias("n_copies"))
    prefixes = hashes.where("k < n_turns").select("h1", "h2").distinct()
    kept = own.join(prefixes, ["h1", "h2"], "left_anti").select("first.key", "n_copies")
    return convs.join(kept, "key").select("conv_id", F.size("turns").cast("long").alias("n_turns"), "n_copies", "turns")


def format_chats(log: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, rendered, n_chars of every maximal conversation."""
    out = maximal_conversations(log).withColumn("rendered", render(F.col("turns")))
    return out.select("conv_id", "n_turns", "n_copies", "rendered",
                      F.length("rendered").cast("long").alias("n_chars"))


SQL_FORMAT_CHATS = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations),
t AS (SELECT DISTINCT conv_id, lone, turn, role, text FROM r),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS rendered
  FROM t GROUP BY conv_id, lone),
m AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, rendered FROM c GROUP BY n_turns, rendered)
SELECT conv_id, n_turns, n_copies, rendered, CAST(length(rendered) AS BIGINT) AS n_chars
FROM m WHERE NOT EXISTS (SELECT 1 FROM c l WHERE l.n_turns > m.n_turns AND starts_with(l.rendered, m.rendered))"""
