"""Reply trees as conversations: root-to-leaf paths, ranked by score, each formatted as one text with a loss mask.

Ancestors are found by self-joins that double their reach each round, so a chain of n turns takes about log2(n) joins on
unique node ids. The same tables of ancestors, from the farthest to the nearest, then give the nodes of each chosen path.

A turn is written as ``<|turn|>role``, a newline, the text and ``<|end|>`` with a newline. Roles are URL-encoded. In texts
a backslash is put after the first character of every string that looks like a control string of a chat template, with any
number of backslashes inside already; reading takes one away, so every text comes back.

A parent that does not exist makes its child a root; nodes on a cycle, which no root reaches, are an error. NULL texts and
roles are empty, NULL scores 0. Ties between branches go to the smaller leaf id. Empty tables give no paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
_REST = r"\|[A-Za-z_]+\|>|/?s>|/?INST\]|/?<SYS>>|</SYS>>"
_ROUNDS = 50


def paths(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """root, leaf, rank, path_score, position (from 0 at the root) and node of every node on a chosen branch.

    ``nodes`` has node (unique), parent and score. A branch's score is the sum of its nodes' scores; rank 1 is the
    highest of a root's branches, and with ``best`` only so many are kept.
    """
    nodes = saved(nodes.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select(F.col("node").alias("parent"))
    step = nodes.join(known, "parent", "left_semi").select("node", F.col("parent").alias("up"))
    # Per node: the farthest ancestor so far, the steps to it, and the scores from the node up to just below it.
    reach = saved(
        nodes.join(step, "node", "left").select(
            "node",
            F.coalesce("up", "node").alias("top"),
            F.col("up").isNotNull().cast("int").alias("steps"),
            F.when(F.col("up").isNotNull(), F.col("score")).otherwise(0.0).alias("gain"),
        )
    )
    # Nodes that reached a root rest; the others take as many steps again as they have taken.
    done, moving, levels, taken = reach.filter("steps = 0"), reach.filter("steps = 1"), [], 1
    while not moving.isEmpty():
        if len(levels) > _ROUNDS:
            raise ValueError("the replies form a cycle")
        levels.append(moving.select("node", F.col("top").alias("up")))
        above = done.union(moving).select(F.col("node").alias("top"), F.col("top").alias("higher"), F.col("steps").alias("more"), F.col("gain").alias("extra"))
        moved = saved(
            moving.join(above, "top").select(
                "node", F.col("higher").alias("top"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("gain") + F.col("extra")).alias("gain")
            )
        )
        taken *= 2
        done, moving = done.union(moved.filter(F.col("steps") < taken)), moved.filter(F.col("steps") == taken)
    reach = done
    roots = nodes.select(F.col("node").alias("top"), F.col("score").alias("first"))
    order = Window.partitionBy("root").orderBy(F.desc("path_score"), "leaf")
    leaves = (
        reach.join(nodes.select(F.col("parent").alias("node")), "node", "left_anti")
        .join(roots, "top")
        .select(F.col("top").alias("root"), F.col("node").alias("leaf"), "steps", (F.col("gain") + F.col("first")).alias("path_score"))
        .withColumn("rank", F.row_number().over(order))
    )
    if best is not None:
        leaves = leaves.filter(F.col("rank") <= best)
    leaves = saved(leaves)
    members = leaves.select("leaf", F.col("leaf").alias("node"), F.lit(0).alias("back"))
    for k in reversed(range(len(levels))):
        further = members.join(levels[k], "node").select("leaf", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        members = saved(members.union(further))
    return members.join(leaves, "leaf").select("root", "leaf", "rank", "path_score", (F.col("steps") - F.col("back")).alias("position"), "node")


def format_paths(path_nodes: DataFrame, turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """root, leaf, rank, path_score, formatted and loss_spans of every path.

    ``turns`` has node, role and text. ``loss_spans`` holds (start, length) in code points, from 0, of the texts of the
    trained role, as they are written.
    """
    role, text = F.coalesce("role", F.lit("")), escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), F.url_encode(role), F.lit("\n"))
    key = ["root", "leaf", "rank", "path_score"]
    before = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    written = (
        path_nodes.join(turns.select("node", head.alias("head"), text.alias("text"), (role == trained_role).alias("trained")), "node")
        .withColumn("size", F.length("head") + F.length("text") + len(CLOSE))
        .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head"))
    )
    part = F.struct("position", F.concat("head", "text", F.lit(CLOSE)).alias("part"), F.when(F.col("trained"), F.struct("start", F.length("text").cast("long").alias("length"))).alias("span"))
    parts = F.array_sort("parts")
    return written.groupBy(*key).agg(F.collect_list(part).alias("parts")).select(
        *key,
        F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("formatted"),
        F.filter(F.transform(parts, lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, CLOSE.replace("|", r"\|")), lambda p: p != "")
    body = lambda p: F.substr(p, F.lit(len(OPEN) + 1))
    cut = lambda p: F.instr(body(p), "\n")
    return F.transform(
        parts,
        lambda p: F.struct(
            F.url_decode(F.substr(body(p), F.lit(1), cut(p) - 1)).alias("role"),
            unescaped(F.substr(body(p), cut(p) + 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", "$1$2$3")
