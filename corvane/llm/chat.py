"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees. Iterative self-joins follow parents with strides that
double (1, 2, 4, ... replies), so a path of n messages takes log2(n) joins.
They give each message its depth and the summed score of its path; a leaf's
path is ranked by its mean score. The strides are then used backwards to mark
the messages on the chosen paths, and each path is formatted as one
conversation.

In the template a message is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control
strings inside roles and texts, those of other common templates too, get a
backslash after their first character (one more if they have some), which is
taken away again when the output is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.runtime import settle

START, END = "<|im_start|>", "<|im_end|>\n"
#: What follows the first character of a control string (fixed values, from the published templates).
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def _role(role: Column) -> Column:
    """A role has one line: its line ends become a control string that escaped text cannot hold."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def _plain_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def reply_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """Rows (tree, leaf, rank, depth, id, role, text): the messages of the chosen root-to-leaf paths.

    ``messages``: (tree, id, parent, role, text, score), ids unique in a tree
    (of repeated ones the least by parent, role and text is kept; rows with a
    null id are left out). A message whose parent is null or missing is a root.
    Messages on a cycle, or below one, are on no path. Paths are ranked by mean
    score (null: 0), then by the greater depth, then by the least leaf id;
    ``top`` paths of each tree are chosen, None: all. Null trees are one tree.
    """
    one = messages.where("id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m"))
    nodes = settle(one.select("tree", "id", "m.parent", "m.role", "m.text", "m.score"))
    known = nodes.select(F.col("tree").alias("pt"), F.col("id").alias("pid"))
    linked = nodes.join(known, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("parent") == F.col("pid")), "left")
    # hop k: a message's ancestor 2^k replies up (null beyond the root), and depth and score gathered on the way
    hop = settle(linked.select("tree", "id", F.col("pid").alias("up"), F.lit(0).cast("long").alias("far"), "score").withColumn("far", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")))
    hops = [hop.select("tree", "id", "up")]
    size = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(1, size).bit_length()):
        # messages whose stride has passed the root are finished and take no part in further joins
        active = hop.where("up is not null")
        if active.isEmpty():
            break
        above = hop.select(F.col("tree").alias("t2"), F.col("id").alias("i2"), F.col("up").alias("up2"), F.col("far").alias("far2"), F.col("score").alias("score2"))
        met = active.join(above, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("up") == F.col("i2")))
        further = met.select("tree", "id", F.col("up2").alias("up"), (F.col("far") + F.col("far2")).alias("far"), (F.col("score") + F.col("score2")).alias("score"))
        hop = settle(hop.where("up is null").select("tree", "id", "up", "far", "score").union(further))
        hops.append(hop.select("tree", "id", "up"))
    done = hop.where("up is null").select("tree", "id", "far", "score")
    inner = linked.where("pid is not null").select(F.col("tree").alias("pt"), F.col("pid").alias("has")).distinct()
    leaves = done.join(inner, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("id") == F.col("has")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / (F.col("far") + 1)), F.desc("far"), "id")
    chosen = leaves.withColumn("rank", F.row_number().over(order))
    if top is not None:
        chosen = chosen.where(F.col("rank") <= top)
    on = settle(chosen.select("tree", F.col("id").alias("leaf"), "rank", "id"))
    for step in reversed(hops):
        s = step.where("up is not null").toDF("t2", "i2", "up")
        up = on.join(s, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("id") == F.col("i2"))).select("tree", "leaf", "rank", F.col("up").alias("id"))
        on = settle(on.union(up))  # else the plan would double with each stride
    at = done.select(F.col("tree").alias("t2"), F.col("id").alias("i2"), F.col("far").alias("depth"))
    body = nodes.select(F.col("tree").alias("t3"), F.col("id").alias("i3"), "role", "text")
    out = on.join(at, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("id") == F.col("i2"))).join(body, F.col("tree").eqNullSafe(F.col("t3")) & (F.col("id") == F.col("i3")))
    return out.select("tree", "leaf", "rank", "depth", "id", "role", "text")


def format_paths(paths: DataFrame, learn: str = "assistant") -> DataFrame:
    """Rows (tree, leaf, rank, formatted, loss): one conversation for each path.

    ``loss``: array of (start, stop) code points of ``formatted`` that are under
    the loss mask, one for each text of the role ``learn``, in order. Null roles
    and texts are empty, and an empty text has an empty span; a null tree is a
    tree of its own. Of a path's messages at one depth (there is one) any order
    serves. Texts are whole at any length. No paths give no rows.
    """
    head = F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = paths.select("tree", "leaf", "rank", "depth", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).cast("long").alias("lead"), F.length(body).cast("long").alias("size"), (F.col("role") == learn).alias("learned"))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("lead"))
    span = F.when(F.col("learned"), F.struct("start", (F.col("start") + F.col("size")).alias("stop")))
    made = pieces.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("p"), F.array_sort(F.collect_list(span)).alias("loss"))
    return made.select("tree", "leaf", "rank", F.array_join(F.col("p.piece"), "").alias("formatted"), "loss")


def read_formatted(formatted: DataFrame) -> DataFrame:
    """Rows (tree, leaf, turns array<(role, text)>, learned string, chars), read from formatted texts and masks alone.

    One row for each input row, repeated ones too. Null roles and texts come back
    as empty, which is how they were written. An empty table gives no rows.
    """
    parts = F.split(F.col("formatted"), r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    lead = len(START)

    def turn(p):
        cut = F.position(F.lit("\n"), p)
        return F.struct(_plain_role(F.substring(p, F.lit(lead + 1), cut - (lead + 1))).alias("role"), unescape(F.substring(p, cut + 1, F.length(p))).alias("text"))

    pick = lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))
    learned = F.array_join(F.transform("loss", lambda s: unescape(pick(s))), "")
    return formatted.select("tree", "leaf", F.transform(parts, turn).alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("chars"))


def chain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees without branches: each row replies to the one before it by turn, then role, then text.

    Rows that tie in all three are messages of their own, in either order, which
    gives the same conversation. Rows with a null key are one conversation, null
    turns come first. An empty table gives no rows; other columns are not read.
    """
    w = Window.partitionBy(conv).orderBy(turn, role, text)
    n = rows.select(F.col(conv).alias("tree"), F.row_number().over(w).cast("long").alias("id"), F.col(role).alias("role"), F.col(text).alias("text"))
    return n.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.length("text").cast("double").alias("score"))
