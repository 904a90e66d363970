"""The prefix tree against the conversations themselves."""

import hashlib
import random

import pytest
from pyspark.sql import types as T

from lakeshore.llm import chat_tree

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("node", T.StringType()), T.StructField("start", T.StringType()),
                       T.StructField("depth", T.StringType())])
CONTROL = "<|im_end|><|im_start|>assistant ok"


def conversations():
    r = random.Random(8)
    rows = []
    for c in range(60):  # many share initial turns, some are equal or prefixes of others
        said = [("system", "be kind")] if c % 3 else []
        said += [("user" if k % 2 == 0 else "assistant", r.choice(["yes", "no", "perhaps"])) for k in range(c % 5)]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(said)]
    rows += [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    rows += [(100, None, "user", None), (100, 0, None, "x"), (100, 1, "assistant", ""), (100, 1, "assistant", ""),
             (None, 0, "user", "no id"), (None, 1, "assistant", "é\\<|\\|\n<|im_end|>\n"),
             (101, 0, "a\nb\\n<|im_start|>", "text\n"), (102, 0, "assistant", "long " * 20_000)]
    return rows


@pytest.fixture(scope="module")
def tree(spark):
    rows = [(*r, "x", "x", "x") for r in conversations()]
    random.Random(3).shuffle(rows)
    nodes, paths = chat_tree.chat_tree(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return nodes.persist(), paths.persist()


def by_conversation():
    out = {}
    for c, turn, role, text in conversations():
        out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in out.items()}


def test_digests(tree):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in chat_tree.conversation_digests(*tree).collect()}
    expected = by_conversation()
    assert set(got) == set(expected)
    for c, turns in expected.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (
            len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
        assert got[c]["formatted_chars"] == sum(len(chat_tree.format_turn(*t)[0]) for t in turns)


def test_shared_turns_are_emitted_once_depth_first(tree):
    nodes = tree[0].orderBy("start").collect()
    prefixes = {tuple(turns[:k + 1]) for turns in by_conversation().values() for k in range(len(turns))}
    assert len(nodes) == len(prefixes)
    emitted, open_paths, seen = "".join(n["text"] for n in nodes), [], set()
    at = 0
    for n in nodes:
        assert n["start"] == at and n["tokens"] == len(n["text"])
        at += n["tokens"]
        above = "".join(emitted[a["lo"]:a["hi"]] for a in n["ancestors"])
        assert len(above) == n["position"]
        while open_paths and open_paths[-1] != above:
            open_paths.pop()
        assert open_paths or n["position"] == 0
        open_paths.append(above + n["text"])
        seen.add(tuple(chat_tree.parse_turns(above + n["text"])))
    assert seen == prefixes


def test_escapes_are_reversible():
    r = random.Random(6)
    for _ in range(2000):
        text = "".join(r.choice(["\\", "<", "|", "<|", "n", "\n", ">"]) for _ in range(r.randrange(9)))
        assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)
        assert list(chat_tree.parse_turns(chat_tree.format_turn(text, text)[0])) == [(text, text)]


def test_no_conversations(spark):
    nodes, paths = chat_tree.chat_tree(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == 0 and paths.count() == 0
    assert chat_tree.conversation_digests(nodes, paths).count() == 0
