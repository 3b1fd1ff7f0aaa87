"""Chat formatting with cumulative-snapshot collapse.

Conversations are often logged again after each turn. Every turn gets the hash of the conversation up to it; a conversation
whose hash is a proper prefix of a longer one is removed by an anti-join, of equal ones the smallest id stays, and
only what is left is rendered. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

# The marks of a rendered turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


#: Parts of the prefix hash, 60 bits each, cut from the SHA-256 of a turn.
PARTS = ("h1", "h2", "h3", "h4")


def _turn_hash(place: Column) -> list[Column]:
    """240 bits of the SHA-256 of a turn at its place, in four numbers."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat_ws(":", place.cast("string"), F.length(role).cast("string"), role, text), 256)
    return [F.conv(F.substring(sha, 1 + 15 * k, 15), 16, 10).cast("long") for k in range(len(PARTS))]


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place (1 for the first turn), last (no turn follows) and the rolling prefix hash of each turn.

    The rolling hash is a running exclusive or of the hashes of turns at their places: a stream of turns sorted once, with one
    turn of look-ahead. No frame reaches to the end of a conversation.
    """
    order = [F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    in_order = Window.partitionBy("conv_id").orderBy(*order)
    placed = turns.withColumns({"place": F.row_number().over(in_order), "last": F.lead("conv_id").over(in_order).isNull()})
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = placed.select("conv_id", "place", "last", *[h.alias(p) for p, h in zip(PARTS, _turn_hash(F.col("place")))])
    return hashed.select("conv_id", "place", "last", *[F.bit_xor(p).over(so_far).alias(p) for p in PARTS])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that stay, with n_turns and ``copies`` (equal conversations, itself included)."""
    rolled = materialize(prefixes(turns), "turn-prefixes")
    key = [F.col("place").alias("n_turns"), *PARTS]
    # Equal conversations are one class before anything is joined, so a much logged opening is one row on either side.
    classes = rolled.where("last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    longer = rolled.where("not last").select(*key).distinct()
    return classes.join(longer, ["n_turns", *PARTS], "left_anti").select("conv_id", "n_turns", "copies")


def format_chats(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, n_turns, copies and text (all turns rendered in order) of each maximal conversation.

    Null roles and texts count as empty; turns of a conversation without a number come last; turns that tie or repeat are
    ordered by role and text and all stay. Rows with a null conv_id belong to no conversation and go. An empty table gives
    no rows; other columns are not read. A rendered conversation is one row, as its reader needs it.
    """
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    kept = materialize(maximal_conversations(turns), "maximal-conversations")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    shown = F.concat(F.lit(TURN_START), role, F.lit("\n"), text, F.lit(TURN_END), F.lit("\n"))
    line = F.struct(F.col("turn").isNull().alias("last"), F.col("turn"), role.alias("role"), text.alias("text"), shown.alias("shown"))
    lines = turns.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    rendered = lines.select("conv_id", F.array_join(F.transform("lines", lambda x: x["shown"]), "").alias("text"))
    return kept.join(rendered, "conv_id").select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "copies", "text")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of all logged ones, rendered, as ``format_chats`` defines them."""
    return format_chats(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH placed AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), shown AS (
  SELECT conv_id, place, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown FROM placed
), chained AS (
  SELECT conv_id, place, string_agg(shown, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix,
         max(place) OVER (PARTITION BY conv_id) AS n_turns
  FROM shown
), classes AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS copies, prefix AS text
  FROM chained WHERE place = n_turns GROUP BY n_turns, prefix
)
SELECT conv_id, n_turns, copies, text FROM classes c
WHERE NOT EXISTS (SELECT 1 FROM chained p WHERE p.place < p.n_turns AND p.place = c.n_turns AND p.prefix = c.text)
"""
