"""Chat formatting of reply trees.

Messages form trees (each names its parent).  Root-to-leaf paths are enumerated by self-joins that double: a round joins
every message's link to an ancestor with that ancestor's own link, so the number of joins grows with the logarithm of the
deepest tree and a message is one row in each round, whatever its depth.  The paths of a conversation are ranked by the sum
of their messages' scores; the best `branches` are written out from their leaves by the same links, backwards, one row a
message, and formatted, each as one conversation.

Format: every turn is `<turn ROLE>TEXT</turn>` and a line end.  Inside roles and texts a backslash precedes every
backslash, `<` and `>`, so no text can hold a control string and reading back is exact.  `loss` holds the code-point spans
of the assistants' escaped texts in the formatted string.

Defined results: null texts and roles are empty; a message whose parent is absent is a root; messages whose ancestors run
in a circle belong to no conversation; a null conv_id is a conversation of its own; equal rows are separate turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

FORMATTED_SCHEMA = "conv_id long, branch int, formatted string, loss array<struct<start: long, end: long>>"

_ESCAPE = re.compile(r"[\\<>]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn {escape(role)}>", escape(text)
        if role == learn:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</turn>\n"]
        at += len(head) + len(body) + len("</turn>\n")
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; format_turns() undone."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def linear(rows: DataFrame) -> DataFrame:
    """A table of turns as reply trees without branches: conv_id, node, parent, role, text, score."""
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(by).cast("long")
    return rows.select("conv_id", node.alias("node"), "role", "text").select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def links(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(for each k the links conv_id, node, up to the ancestor 2**k above; conv_id, node, score, depth: the sum and number of the
    messages from the root to each message).  Messages without a root are in circles and have no depth."""
    m = messages.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = m.select(F.col("conv_id").alias("c"), F.col("node").alias("p")).distinct()
    linked = m.join(there, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("p")), "left")
    state = written(linked.select("conv_id", "node", F.col("p").alias("up"), "score", F.lit(1).cast("long").alias("depth")), "chat-links")
    most = m.groupBy("conv_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    up, reach = [], 1
    while reach <= most and state.where("up IS NOT NULL").limit(1).count():  # beyond that only circles are left
        up.append(state.where("up IS NOT NULL").select("conv_id", "node", "up"))
        above = state.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("depth").alias("further"))
        step = state.where("up IS NOT NULL").join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n")))
        longer = step.select("conv_id", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"), (F.col("depth") + F.col("further")).alias("depth"))
        state = written(state.where("up IS NULL").unionAll(longer), "chat-links")
        reach *= 2
    return up, state.where("up IS NULL").drop("up")


def chosen_paths(messages: DataFrame, branches: int) -> DataFrame:
    """conv_id, branch, node, depth (1: the root) of the messages of the `branches` best paths of each conversation (ties: the
    smaller leaf)."""
    up, placed = links(messages)
    inner = messages.where("parent IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("parent").alias("p")).distinct()
    leaves = placed.join(inner, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("p")), "left_anti")
    best = Window.partitionBy("conv_id").orderBy(F.col("score").desc(), "node")
    path = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches).select("conv_id", "branch", "node", "depth")
    # every distance from a leaf is one sum of powers of two, so each ancestor is reached once
    for k in reversed(range(len(up))):
        path = written(path, "chat-path")
        link = up[k].toDF("c", "n", "above")
        higher = path.join(link, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))).select("conv_id", "branch", F.col("above").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        path = path.unionAll(higher)
    return path


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """FORMATTED_SCHEMA for the `branches` best paths of each conversation."""
    at = chosen_paths(messages, branches).withColumnRenamed("depth", "pos")
    said = messages.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = at.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))).groupBy("conv_id", "branch").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in f["turns"]]
            yield pd.DataFrame({"conv_id": f["conv_id"].astype("Int64"), "branch": f["branch"], "formatted": [x for x, _ in made], "loss": [[{"start": s, "end": e} for s, e in x] for _, x in made]})

    return turns.mapInPandas(write, FORMATTED_SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    import hashlib

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for f in frames:
            rows = []
            for text, loss in zip(f["formatted"], f["loss"]):
                turns = parse(text)
                learnt = "".join(unescape(text[x["start"] : x["end"]]) for x in loss)
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(text)))
            out = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out.insert(0, "conv_id", f["conv_id"].astype("Int64").to_numpy())
            yield out

    return formatted.mapInPandas(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(rows: DataFrame) -> DataFrame:
    """Formats a table of turns (conv_id, turn, role, text), stores it, and returns digests() of what is read back."""
    return digests(written(format_conversations(linear(rows)), "chat"))
