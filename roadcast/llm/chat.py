"""Reply trees to training conversations.

A message names its parent. Iterative self-joins double the reach of every message's
link upwards, so that a chain of n replies takes log2(n) joins; scores add up on the
way. Branches, one per leaf, are ranked by score, and the chosen ones are spelled out by
the same links: each join adds to the messages found those as far up again. Every chosen
path then becomes one conversation, written by a task that holds one at a time.

Defined results: a message whose parent is null or not there is a root. Messages in a
circle of replies hang below no root and are on no path. Of messages that repeat a node,
the one with the smallest role and text is read. Null texts, roles and scores count as
empty and 0. Of equally good branches the longer one goes first, then the one with the
smallest leaf. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadcast.llm.tables import in_small_batches, settle

# The template. Its control strings hold characters that texts never show: a backslash
# and a letter stand for each of them and for the backslash itself.
HEAD, BETWEEN, TAIL = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"
_SHOWN = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
_IN_TEXT = str.maketrans(_SHOWN)
_IN_ROLE = str.maketrans(_SHOWN | {":": "\\c"})
_MEANT = {"\\": "\\", "h": "#", "l": "<", "c": ":"}
_TURN = re.compile(r"### ([^#<:]*): ([^#<]*)</turn>\n")


def escape(text: str, table: dict = _IN_TEXT) -> str:
    return text.translate(table)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _MEANT[m[1]], text)


def chains(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversations given by turn as messages, each replying to the one before:
    ``tree, node, parent, role, text, score``. Null turns come first, equal ones in the
    order of role and text."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = rows.select(
        F.col(conv).alias("tree"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _same(left: str, right: str, node: str, other: str):
    return F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree")) & (
        F.col(f"{left}.{node}") == F.col(f"{right}.{other}")
    )


def _links(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For k = 0, 1, ...: each message's ancestor ``2 ** k`` steps up, if there is one;
    and for every message the score and length of its way to the root."""
    nodes = messages.groupBy("tree", "node").agg(
        F.min("parent").alias("parent"), F.sum(F.coalesce("score", F.lit(0.0))).alias("score")
    )
    known = nodes.select("tree", "node").alias("k")
    reach = (
        nodes.alias("m")
        .join(known, _same("m", "k", "parent", "node"), "left")
        .select(
            "m.tree", "m.node", F.col("k.node").alias("up"), "m.score", F.lit(1).cast("long").alias("length")
        )
    )
    reach = settle(reach, "replies")
    longest = reach.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # Messages whose way has reached the root take no part in further rounds.
    done, levels = reach.filter("up is null"), []
    while True:
        here = reach.filter("up is not null")
        levels.append(here.select("tree", "node", "up"))
        # In a circle the way up never ends; no true way is longer than its tree.
        if here.isEmpty() or 1 << len(levels) > 2 * longest:
            return levels, done.select("tree", "node", "score", "length")
        further = (
            here.alias("a")
            .join(done.unionByName(here).alias("b"), _same("a", "b", "up", "node"))
            .select(
                "a.tree",
                "a.node",
                F.col("b.up").alias("up"),
                (F.col("a.score") + F.col("b.score")).alias("score"),
                (F.col("a.length") + F.col("b.length")).alias("length"),
            )
        )
        reach = settle(further, "replies")
        done = done.unionByName(reach.filter("up is null"))


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of each tree: ``tree, leaf, rank, length,
    node, place`` with a row per message, the root at place 0."""
    levels, ways = _links(messages)
    parents = levels[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = ways.alias("w").join(parents.alias("p"), _same("w", "p", "node", "node"), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("length"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    found = settle(
        chosen.select(
            "tree", F.col("node").alias("leaf"), "rank", "length", "node", (F.col("length") - 1).alias("place")
        ),
        "paths",
    )
    for k, links in enumerate(levels[:-1] if len(levels) > 1 else []):
        above = (
            found.alias("f")
            .join(links.alias("l"), _same("f", "l", "node", "node"))
            .select("f.tree", "f.leaf", "f.rank", "f.length", F.col("l.up").alias("node"), (F.col("f.place") - (1 << k)).alias("place"))
        )
        found = settle(found.unionByName(above), "paths")
    return found


def conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """One row per chosen path: ``tree, leaf, rank, formatted`` and ``learned``, the
    start and end (exclusive, in characters) of each text to learn from."""
    texts = messages.groupBy("tree", "node").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("said")
    )
    paths = best_paths(messages, keep)
    rows = (
        paths.alias("p")
        .join(texts.alias("t"), _same("p", "t", "node", "node"))
        .select("p.tree", "p.leaf", "p.rank", "p.place", "t.said.role", "t.said.text")
        .repartition("tree", "leaf")
        .sortWithinPartitions("tree", "leaf", "place")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, key, parts, spans, size = None, None, [], [], 0
        for batch in batches:
            done = []
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            for own, role, text in zip(keys, batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                if own != key:
                    if key is not None:
                        done.append((*key, "".join(parts), spans))
                    key, parts, spans, size = own, [], [], 0
                head = HEAD + escape(role, _IN_ROLE) + BETWEEN
                body = escape(text)
                if role == LEARNED_ROLE:
                    spans.append({"start": size + len(head), "end": size + len(head) + len(body)})
                parts += [head, body, TAIL]
                size += len(head) + len(body) + len(TAIL)
            at = batch.schema
            if done:
                yield _out(done, at)
        if key is not None:
            yield _out([(*key, "".join(parts), spans)], at)

    def _out(done, schema):
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        types = [*(schema.field(k).type for k in range(3)), pa.string(), pa.list_(span)]
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        return pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "rank", "formatted", "learned"])

    return in_small_batches(rows).mapInArrow(
        write,
        f"tree {kinds['tree']}, leaf {kinds['leaf']}, rank int, formatted string, "
        "learned array<struct<start: long, end: long>>",
    )


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    kind = formatted.schema["tree"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns, learned, chars = hashlib.sha256(), hashlib.sha256(), 0
                found = read_back(text)
                for role, said in found:
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    own = unescape(text[span["start"] : span["end"]])
                    learned.update(own.encode())
                    chars += len(own)
                out.append((len(found), turns.hexdigest(), chars, learned.hexdigest(), len(text)))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return in_small_batches(formatted.select("tree", "formatted", "learned")).mapInArrow(
        read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
