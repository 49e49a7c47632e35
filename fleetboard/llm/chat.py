"""Chat formatting of reply trees.

Messages reply to messages. Every path from a root to a leaf is a possible conversation. Paths
are found by iterative self-joins that double: after round ``i`` each message knows its
``2**i``-th ancestor, so trees of depth ``d`` take about ``log2(d)`` rounds. Leaves carry the
mean score of their path and are ranked by it within their tree. Chosen paths are then listed,
halving: a stretch of a path that is longer than ``2**i`` splits there. No array of a path or
tree is ever built.

A path becomes one conversation of ``<s>role``, a line break, the text, ``</s>`` and a line break
per turn. Control strings inside texts get a backslash behind their first character, and those
that have backslashes there one more, so that taking one away gives the text back. Conversations
longer than ``PIECE_CHARS`` go on in further rows (``part``), always whole turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetboard.llm.common import cut, numbered, text_batches

START, END = "<s>", "</s>"
#: Strings that mean something to templates; the first two are ours.
CONTROL = (START, END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Characters of a formatted row before the next turn starts a new one.
PIECE_CHARS = 1_000_000

_rest = "|".join(re.escape(c[1:]) for c in CONTROL)
_first = "".join(sorted({re.escape(c[0]) for c in CONTROL}))
_ESCAPE = re.compile(rf"([{_first}])(\\*)(?={_rest})")
_UNESCAPE = re.compile(rf"([{_first}])\\(\\*)(?={_rest})")
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` gives it back.

    A control string may begin inside another's first characters ("<<s>"), so this is by
    looking ahead: only the first character is taken.
    """
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as written, and where its (escaped) text begins and ends in it."""
    head, body = f"{START}{_escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted row."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        found.append((_unescape_role(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


def _tag(column: str) -> Column:
    """A tree's name as text, NULL apart from all others."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def _numbered_by(group: str, rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``nth``, from 1 within their group. Sorted by ranges, so that one group may have any share of the rows."""
    placed = numbered(rows, [group, *order], purpose)
    first = cut(placed.groupBy(F.col(group).alias("_group")).agg(F.min("g").alias("_first")), f"{purpose}-first")
    met = placed.join(first, F.col(group).eqNullSafe(F.col("_group")))
    return met.withColumn("nth", F.col("g") - F.col("_first") + 1).drop("g", "_group", "_first")


def paths(messages: DataFrame, *, best: int | None = None) -> DataFrame:
    """Turns of the chosen paths of ``messages`` (tree, node, parent, role, text, score).

    Gives tree, rank (1: highest mean score; ties to the smallest leaf), leaf, position (from
    0), node, role, text. ``best`` limits the paths of a tree. A message whose parent is NULL or
    missing is a root. A NULL score counts as 0. Of rows that repeat a node the least by parent,
    role and text stays; rows with a NULL node are left out; so are messages on or below a
    cycle, which no root reaches.
    """
    said = messages.where("node IS NOT NULL").groupBy(_tag("tree").alias("tag"), "node").agg(
        F.min(F.struct("tree", "parent", "role", "text", "score")).alias("m")
    ).select("tag", "node", "m.*")
    said = cut(said, "messages")
    links = said.select("tag", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    there = links.select("tag", F.col("node").alias("parent"), F.lit(True).alias("there"))
    step = cut(
        links.join(there, ["tag", "parent"], "left")
        .select("tag", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("length")),
        "step0",
    )
    # open i: messages that have a 2**i-th ancestor (up), the score and number of those before
    # it. The others have met their root, and only go on to be met.
    total = step.count()
    opened, rooted = [step.where("up IS NOT NULL")], step.where("up IS NULL")
    while (1 << (len(opened) - 1)) <= total and not opened[-1].isEmpty():
        known = opened[-1].unionAll(rooted)
        further = known.select(
            "tag", F.col("node").alias("up"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("length").alias("longer")
        )
        step = cut(
            opened[-1].join(further, ["tag", "up"]).select(
                "tag", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"),
                (F.col("length") + F.col("longer")).alias("length"),
            ),
            f"step{len(opened)}",
        )
        opened.append(step.where("up IS NOT NULL"))
        rooted = rooted.unionAll(step.where("up IS NULL"))
    parents = links.select("tag", F.col("parent").alias("node")).distinct()
    leaves = rooted.join(parents, ["tag", "node"], "left_anti")
    by_score = leaves.withColumn("worse", -(F.col("score") / F.col("length")))
    chosen = _numbered_by("tag", by_score, ["worse", "node"], "leaves").withColumn("rank", F.col("nth").cast("int")).drop("nth", "worse")
    if best is not None:
        chosen = chosen.where(F.col("rank") <= best)
    # A stretch: from ``node`` upwards, ``length`` messages; ``top`` counts those above its end.
    stretch = chosen.select("tag", "rank", F.col("node").alias("leaf"), "node", "length", F.lit(0).cast("long").alias("top"))
    for i in reversed(range(len(opened))):
        half = F.lit(1 << i).cast("long")
        long = stretch.where(F.col("length") > half).join(opened[i].select("tag", "node", "up"), ["tag", "node"])
        lower = F.struct("node", half.alias("length"), (F.col("top") + F.col("length") - half).alias("top"))
        upper = F.struct(F.col("up").alias("node"), (F.col("length") - half).alias("length"), F.col("top"))
        split = long.select("tag", "rank", "leaf", F.inline(F.array(lower, upper)))
        stretch = stretch.where(F.col("length") <= half).unionAll(split)
        # Both halves of the union read the stretches, so these are written each time.
        stretch = cut(stretch, f"stretch{i}")
    turns = stretch.select("tag", "rank", "leaf", "node", F.col("top").alias("position"))
    return turns.join(said.select("tag", "node", "tree", "role", "text"), ["tag", "node"]).select(
        "tree", "rank", "leaf", "position", "node", "role", "text"
    )


def format_paths(turns: DataFrame, *, loss_role: str = "assistant", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Conversations of ``paths``: tree, rank, part, text, loss (start and end of texts to learn).

    Offsets count characters of the row's text. NULL roles and texts are empty.
    """
    text_batches(turns.sparkSession)
    rows = turns.select("tree", "rank", "position", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition("tree", "rank").sortWithinPartitions("tree", "rank", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, size, texts, loss = None, 0, 0, [], []
        out: list[tuple] = []

        def done() -> pa.RecordBatch:
            columns = list(zip(*out))
            kinds = [tree_kind, pa.int32(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "rank", "part", "text", "loss"]
            )
            out.clear()
            return made

        for batch in batches:
            tree_kind = batch.schema.field(0).type
            for tree, rank, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (tree, rank) or size >= piece_chars:
                    if texts:
                        out.append((*key, part, "".join(texts), loss))
                    part = part + 1 if key == (tree, rank) else 0
                    key, size, texts, loss = (tree, rank), 0, [], []
                turn, a, b = format_turn(role, text)
                if role == loss_role:
                    loss.append({"start": size + a, "end": size + b})
                texts.append(turn)
                size += len(turn)
            if out:
                yield done()
        if texts:
            out.append((*key, part, "".join(texts), loss))
            yield done()

    kind = turns.schema["tree"].dataType.simpleString()
    return dealt.mapInArrow(run, f"tree {kind}, rank int, part long, text string, loss array<struct<start:long,end:long>>")


def digests(written: DataFrame) -> DataFrame:
    """Of formatted conversations, read back: tree, rank, turns, SHA-256 of turns and of the loss texts.

    Rows of a conversation are read one after the other, so long ones take no more memory.
    """
    dealt = written.repartition("tree", "rank").sortWithinPartitions("tree", "rank", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        key, state, tree_kind = None, None, None

        def row(state: list) -> list:
            n, turns, chars, loss, size = state
            return [*key, n, turns.hexdigest(), chars, loss.hexdigest(), size]

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = [tree_kind, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["tree", "rank", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            tree_kind = batch.schema.field(0).type
            out = []
            for tree, rank, _, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (tree, rank):
                    if state:
                        out.append(row(state))
                    key, state = (tree, rank), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if out:
                yield batch_of(out)
        if state:
            yield batch_of([row(state)])

    kind = written.schema["tree"].dataType.simpleString()
    return dealt.mapInArrow(
        run, f"tree {kind}, rank int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def threads(rows: DataFrame, *, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations of numbered turns as reply trees: each turn replies to the one before it."""
    said = rows.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{turn}`").alias("_turn"), "role", "text")
    placed = _numbered_by("tree", said, ["_turn", "role", "text"], "turns").withColumnRenamed("nth", "node")
    return placed.select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )
