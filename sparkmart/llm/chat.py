"""Chat formatting of reply trees.

Messages point to the message they reply to.  Self-joins that double the reach
of each pointer give every message's distance to its root and the sum of scores
on the way, in as many rounds as the depth has binary digits.  Branches (paths
from a root to a message without replies) are ranked by mean score; the same
pointer tables then list the messages of the chosen ones, and each becomes one
formatted conversation with a loss mask over the assistant's texts.

The template is ``<|role|>``, line feed, text, ``</s>``, line feed.  Inside roles
and texts a backslash and the characters that can begin a control string become
a backslash and a letter, so no text can hold a mark and all can be read back.
Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint

# character -> letter after the backslash; the backslash itself comes first
ESCAPES = {"\\": "b", "<": "l", "[": "s", "|": "p"}
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "</s>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit("\\" + e[1])), ESCAPES.items(), text)


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: every backslash begins a pair, and the backslash's own pair goes last."""
    return reduce(lambda t, e: F.replace(t, F.lit("\\" + e[1]), F.lit(e[0])), reversed(ESCAPES.items()), text)


def _same(left: str, left_node: str, right: str) -> Column:
    return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id")) & (F.col(f"{left}.{left_node}") == F.col(f"{right}.msg_id"))


def _jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables k = 0, 1, ... of (conv_id, msg_id, up): the 2^k-th message above,
    for messages that have one; and, of messages that reach a root, (conv_id,
    msg_id, n, total): how many messages the way has and the sum of their scores.
    Each round joins only the messages that are not at their root yet."""
    first = nodes.select("conv_id", "msg_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("n"), F.col("score").alias("total"))
    parents = nodes.select("conv_id", "msg_id")
    step = reliable_checkpoint(
        first.alias("a").join(parents.alias("b"), _same("a", "up", "b"), "left")
        .select("a.conv_id", "a.msg_id", F.col("b.msg_id").alias("up"), "a.n", "a.total"))     # a missing parent: a root
    tables, reach, most = [], 1, step.count()
    done, climbing = step.where("up IS NULL"), step.where("up IS NOT NULL")
    while reach <= most and climbing.limit(1).count():
        tables.append(climbing)
        step = reliable_checkpoint(
            climbing.alias("a").join(climbing.unionByName(done).alias("b"), _same("a", "up", "b"))
            .select("a.conv_id", "a.msg_id", F.col("b.up").alias("up"),
                    (F.col("a.n") + F.col("b.n")).alias("n"), (F.col("a.total") + F.col("b.total")).alias("total")))
        done, climbing = done.unionByName(step.where("up IS NULL")), step.where("up IS NOT NULL")
        reach *= 2
    return tables, done.select("conv_id", "msg_id", "n", "total")


def chosen_paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(conv_id, leaf_id, rank, mean_score, place, role, text): the messages of the
    ``best`` branches of every tree (None: all), place 0 being the root."""
    nodes = reliable_checkpoint(
        messages.groupBy("conv_id", "msg_id")
        .agg(F.min(F.struct("parent_id", "role", "text", "score")).alias("m"))
        .where("msg_id IS NOT NULL").select("conv_id", "msg_id", "m.*"))
    tables, ways = _jump_tables(nodes.withColumn("score", F.coalesce("score", F.lit(0.0))))
    replied = nodes.where("parent_id IS NOT NULL").select("conv_id", F.col("parent_id").alias("msg_id")).distinct()
    leaves = ways.alias("a").join(replied.alias("b"), _same("a", "msg_id", "b"), "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc("mean_score"), "leaf_id")
    leaves = (leaves.select("conv_id", F.col("msg_id").alias("leaf_id"), "n", (F.col("total") / F.col("n")).alias("mean_score"))
              .withColumn("rank", F.row_number().over(order)))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    kept = ["conv_id", "leaf_id", "rank", "mean_score"]
    on_path = reliable_checkpoint(leaves.select(*kept, F.col("leaf_id").alias("at"), (F.col("n") - 1).alias("place")))
    for k, table in enumerate(tables):
        above = (on_path.alias("a").join(table.alias("b"), _same("a", "at", "b"))
                 .select(*[f"a.{c}" for c in kept], F.col("b.up").alias("at"), (F.col("a.place") - (1 << k)).alias("place")))
        on_path = reliable_checkpoint(on_path.unionByName(above))
    return (on_path.alias("a").join(nodes.alias("b"), _same("a", "at", "b"))
            .select(*[f"a.{c}" for c in kept], "a.place", "b.role", "b.text"))


def format_conversations(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(conv_id, leaf_id, rank, mean_score, formatted, loss_spans) of the ``best``
    branches of every reply tree (None: all of them).

    ``messages`` has conv_id, msg_id, parent_id, role, text and score.  A message
    whose parent is null or missing is a root; messages on or below a cycle are
    on no path and are left out, as are rows with a null msg_id.  Of rows that
    repeat a msg_id the least (parent, role, text, score) counts.  Ties in score
    go to the smaller leaf.  Null roles and texts are empty, null scores 0; a
    null conv_id is a conversation of its own.  ``loss_spans`` holds (begin,
    finish) of each assistant text in ``formatted``, in code points.  A
    conversation is one row, so one task holds its text.
    """
    turns = chosen_paths(messages, best)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (turns.withColumn("head", F.concat(F.lit(OPEN), escape(role), F.lit(AFTER_ROLE)))
             .withColumn("body", escape(text))
             .withColumn("turn", F.concat("head", "body", F.lit(CLOSE))))
    so_far = Window.partitionBy("conv_id", "leaf_id").orderBy("place")
    turns = (turns.withColumn("finish", (F.sum(F.length("turn")).over(so_far) - len(CLOSE)).cast("long"))
             .withColumn("begin", F.col("finish") - F.length("body"))
             .withColumn("span", F.when(role == LEARNED_ROLE, F.struct("begin", "finish"))))
    return (turns.groupBy("conv_id", "leaf_id")
            .agg(F.first("rank").alias("rank"), F.first("mean_score").alias("mean_score"),
                 F.sort_array(F.collect_list(F.struct("place", "turn", "span"))).alias("turns"))
            .select("conv_id", "leaf_id", "rank", "mean_score",
                    F.array_join(F.col("turns.turn"), "").alias("formatted"),
                    F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, CLOSE)
    return F.transform(
        F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, AFTER_ROLE) + len(AFTER_ROLE))).alias("text")))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substr(formatted, s["begin"].cast("int") + 1, (s["finish"] - s["begin"]).cast("int")))), "")


def as_messages(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as reply chains: each turn replies to the
    one before it; ties in turn go by role and text, null turns come first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.select("conv_id", "turn", "role", "text")
            .withColumn("msg_id", F.row_number().over(order).cast("long"))
            .select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                    "role", "text", F.lit(0.0).alias("score")))
