"""Preference pairs as prompt and masked completions, in DataFrame operations.

Two conversations, chosen and rejected, are compared turn by turn. The longest
common prefix of turns is rendered once as the prompt; what follows on either
side is that side's completion. A turn is one segment of the result, so a
conversation of any length is never gathered into one row or task; in the
order of ``position`` the segments of ``prompt`` and of one side make one
training sample. ``train`` is the mask: only the assistant's turns of a
completion are trained on, never the prompt.

Where conversations come with one side only, :func:`with_swapped_reply` makes
the other: every conversation is a chosen side, and its rejected side goes with
it up to the assistant's last turn, where the last reply of another
conversation stands. Replies are put in the order of their digest, so that
equal ones are neighbours, and each conversation takes the reply that stands as
far behind its own as the most frequent reply is frequent: no conversation gets
a reply equal to its own, unless more than half of all replies are equal.

Defined cases: positions count a conversation's turns in the order of (turn,
role, text), so repeated turn numbers are separate turns; null roles and texts
equal each other and are rendered empty; the rows with a null conversation id
are one conversation; equal conversations are all prompt, with no completion; a
pair with one side only has no prompt; a conversation without a reply of the
assistant, or whose swapped reply is equal to its own, is all prompt; an empty
table gives no rows; texts may be of any length. Only the
four turn columns are read, others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.operators.rownum import global_row_number
from wardstar.session import materialize

from .common import quoted

OPEN, BETWEEN, CLOSE = "<|", "|>\n", "\n"
NO_ID = "\0none"


def positions(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, key, position, role, text): turns numbered from 1 in each
    conversation. Rows are numbered once over the whole table by a range
    shuffle and the conversation's first number is taken off, so a long
    conversation is spread over tasks. ``key`` is never null."""
    conv = F.col(quoted(conv_col))
    turns = df.select(conv.alias("conv_id"), F.coalesce(conv.cast("string"), F.lit(NO_ID)).alias("key"),
                      F.col(quoted(turn_col)).alias("turn"), F.col(quoted(role_col)).alias("role"),
                      F.col(quoted(text_col)).alias("text"))
    numbered = materialize(global_row_number(turns, ["key", "turn", "role", "text"], out="n"), "turns")
    first = numbered.groupBy("key").agg(F.min("n").alias("n0"))
    return numbered.join(first, "key").select(
        "conv_id", "key", (F.col("n") - F.col("n0") + 1).alias("position"), "role", "text")


def pair_by_first_turn(turns: DataFrame) -> DataFrame:
    """(key, pair_id, side): conversations that begin with the same turn are
    paired in the order of their id, the first of two being the chosen one. A
    conversation left over is a pair with a chosen side only. Ids are numbered
    as in :func:`positions`, so one very common first turn is no single task."""
    one = turns.where("position = 1").select(
        "conv_id", "key", F.xxhash64("role", "text", F.col("text").isNull(), F.length("text")).alias("first"))
    numbered = materialize(global_row_number(one, ["first", "conv_id"], out="n"), "first-turns")
    low = numbered.groupBy("first").agg(F.min("n").alias("n0"))
    at = numbered.join(low, "first").select("conv_id", "key", "first",
                                            (F.col("n") - F.col("n0")).alias("i"))
    placed = at.select("conv_id", "key", F.struct("first", F.expr("i div 2").alias("k")).alias("slot"),
                       F.when(F.col("i") % 2 == 0, "chosen").otherwise("rejected").alias("side"))
    named = placed.where("side = 'chosen'").select("slot", F.col("conv_id").alias("pair_id"),
                                                   F.col("key").alias("pair_key"))
    return placed.join(named, "slot").select("key", "pair_id", "pair_key", "side")


def render(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(OPEN), F.coalesce(role, empty), F.lit(BETWEEN),
                    F.coalesce(text, empty), F.lit(CLOSE))


def with_swapped_reply(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(pair_key, pair_id, side, conv_id, position, role, text): the turns of
    both sides of every conversation, as :func:`format_samples` takes them. A
    swapped turn has the ``conv_id`` that it comes from."""
    turns = materialize(turns, "placed-turns")
    mine = F.coalesce(F.col("role") == trained_role, F.lit(False))
    # a null text is the least of all: equal to itself alone
    digest = F.md5(F.coalesce(F.concat(F.lit("t"), "text"), F.lit("n")))
    last = turns.where(mine).groupBy("key").agg(F.max(F.struct("position", "conv_id", "role", "text")).alias("r"))
    replies = last.select("key", "r.*", digest.alias("digest"), F.md5("key").alias("by"))
    ordered = materialize(global_row_number(replies, ["digest", "by", "key"], out="n", total_col="total"), "replies")
    most = ordered.groupBy("digest").count().agg(F.max("count")).first()[0] or 0  # one number
    taken = (F.col("n") - 1 + most) % F.col("total") + 1
    donors = ordered.select(F.col("n").alias("taken"), F.col("conv_id").alias("d_conv"),
                            F.col("role").alias("d_role"), F.col("text").alias("d_text"))
    swapped = ordered.select("key", F.col("conv_id").alias("pair_id"), "position", taken.alias("taken")) \
        .join(donors, "taken").select(F.col("key").alias("pair_key"), "pair_id", F.lit("rejected").alias("side"),
                                      F.col("d_conv").alias("conv_id"), "position", F.col("d_role").alias("role"),
                                      F.col("d_text").alias("text"))
    sides = [F.col("key").alias("pair_key"), F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"),
             "conv_id", "position", "role", "text"]
    branch = ordered.select("key", F.col("position").alias("branch"))
    before = turns.join(branch, "key", "left").where("branch IS NULL OR position < branch")
    return turns.select(*sides).unionByName(before.select(*sides).withColumn("side", F.lit("rejected"))) \
        .unionByName(swapped)


def format_preferences(turns: DataFrame, pairs: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(pair_id, conv_id, part, position, role, rendered, train), one row per
    turn; ``part`` is prompt, chosen or rejected.

    ``turns`` as from :func:`positions`, ``pairs`` as from
    :func:`pair_by_first_turn`: every conversation is one side of one pair.
    """
    sided = turns.join(pairs, "key").select("pair_key", "pair_id", "side", "conv_id", "position", "role", "text")
    return format_samples(sided, trained_role).drop("sample_id", "segment")


def format_samples(sided: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(sample_id, pair_id, conv_id, part, segment, position, role, rendered,
    train), one row per turn of a sample. The segments 0, 1, ... of the prompt
    and then of one side, joined, are what a model reads; ``sample_id`` is never
    null."""
    sided = materialize(sided, "sided-turns")
    # a position differs if one side lacks it or the turns are not equal
    per_position = sided.groupBy("pair_key", "position").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("role", "text")).alias("low"), F.max(F.struct("role", "text")).alias("high"))
    differs = (F.col("n") < 2) | ~F.col("low").eqNullSafe(F.col("high"))
    cut = per_position.groupBy("pair_key").agg(F.min(F.when(differs, F.col("position"))).alias("cut"))
    shared = F.col("cut").isNull() | (F.col("position") < F.col("cut"))
    part = F.when(shared, "prompt").otherwise(F.col("side"))
    segment = F.col("position") - F.when(shared, 1).otherwise(F.col("cut"))
    return sided.join(cut, "pair_key").where(~shared | (F.col("side") == "chosen")).select(
        F.col("pair_key").alias("sample_id"), "pair_id", "conv_id", part.alias("part"), segment.alias("segment"),
        "position", "role", render(F.col("role"), F.col("text")).alias("rendered"),
        (~shared & F.coalesce(F.col("role") == trained_role, F.lit(False))).alias("train"))
