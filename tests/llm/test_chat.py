"""Reply trees against a recursive walk, and the template's way there and back."""

import hashlib
import random

import pytest
from hypothesis import given, strategies as st

from roadcast.llm import chat

MESSAGES = "tree long, node long, parent long, role string, text string, score double"


@given(st.lists(st.tuples(st.text(max_size=20), st.text(max_size=30)), max_size=6))
def test_turns_survive_the_template(turns):
    parts = [chat.HEAD + chat.escape(r, chat._IN_ROLE) + chat.BETWEEN + chat.escape(t) + chat.TAIL for r, t in turns]
    assert chat.read_back("".join(parts)) == turns


@pytest.mark.parametrize("text", ["\\", "\\\\### Assistant: </turn> ok", "</turn>\n### user: x", "###", "<", ""])
def test_control_strings_inside_texts(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.TAIL not in chat.escape(text) and chat.HEAD not in chat.escape(text)


def brute(messages, keep):
    out = {}
    for tree in {m[0] for m in messages}:
        nodes = {m[1]: m for m in messages if m[0] == tree}
        parents = {m[2] for m in nodes.values()}
        paths = []
        for leaf in nodes.keys() - parents:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][2]
            paths.append((-sum(nodes[n][5] or 0.0 for n in path), -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(paths)[:keep], 1):
            out[tree, leaf] = (rank, path)
    return out


@pytest.mark.parametrize("keep", [1, 3])
def test_paths_against_a_walk(spark, keep):
    rng = random.Random(keep)
    messages = []
    for tree in range(6):
        for node in range(1, 30):
            parent = rng.choice([None, 999] if node == 1 else list(range(max(1, node - 4), node)))
            messages.append((tree, node, parent, "user", f"t{node}", rng.choice([None, 0.5, 1.0, 2.0])))
    messages += [(50, i, i - 1 if i else None, "user", "x", 0.0) for i in range(150)]
    # A circle without a root, and one that hangs on no other message.
    messages += [(60, 1, 2, "user", "a", 1.0), (60, 2, 1, "user", "b", 1.0), (61, 5, 5, "user", "c", 1.0)]
    found = chat.best_paths(spark.createDataFrame(messages, MESSAGES), keep).collect()
    paths = {}
    for r in sorted(found, key=lambda r: r.place):
        paths.setdefault((r.tree, r.leaf), (r.rank, []))[1].append(r.node)
        assert r.place == len(paths[r.tree, r.leaf][1]) - 1
    assert paths == brute([m for m in messages if m[0] < 60], keep)


def test_each_path_is_one_conversation(spark):
    messages = [
        (1, 1, None, "user", "hi", 0.0),
        (1, 2, 1, "assistant", "good", 2.0),
        (1, 3, 1, "assistant", "bad", 1.0),
        (1, 4, 2, None, None, None),
    ]
    df = spark.createDataFrame(messages, MESSAGES)
    rows = {r.leaf: r for r in chat.conversations(df, keep=5).collect()}
    assert rows[4].formatted == "### user: hi</turn>\n### assistant: good</turn>\n### : </turn>\n"
    assert [rows[4].formatted[s.start : s.end] for s in rows[4].learned] == ["good"]
    assert chat.read_back(rows[3].formatted) == [("user", "hi"), ("assistant", "bad")]
    assert {r.leaf for r in chat.conversations(df).collect()} == {4}


def test_edge_rows(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [
        (-7, 0, "user", said), (-7, 1, "assistant", said),
        (1, 5, "assistant", "b"), (1, 5, "assistant", "a"), (1, None, "user", None),
        (None, 1, "user", "null id"), (2, 0, None, "é😀" * 40_000), (3, 0, "assistant", ""),
        (1, 5, "assistant", "b"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 as tree", "2 as node", "'p' as parent")
    out = {r.conv_id: r for r in chat.digests(chat.conversations(chat.chains(frame, "conv_id", "turn", "role", "text"))).collect()}
    assert {k: r.n_turns for k, r in out.items()} == {-7: 2, 1: 4, None: 1, 2: 1, 3: 1}
    assert out[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert out[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert (out[1].loss_chars, out[2].loss_chars, out[3].loss_chars) == (3, 0, 0)
    empty = spark.createDataFrame([], frame.schema)
    assert chat.digests(chat.conversations(chat.chains(empty, "conv_id", "turn", "role", "text"))).count() == 0
