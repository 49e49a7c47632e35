import hashlib

import pytest
from fleetboard.llm import chat
from hypothesis import given
from hypothesis import strategies as st

HARD = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "s>", "/s>", "<s", "\n", "a", "é", "INST]"]), max_size=12).map("".join)


@given(HARD, HARD)
def test_escaping_is_reversible(role, text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    turn, a, b = chat.format_turn(role, text)
    assert chat.read_turns(turn + turn) == [(role, text)] * 2
    assert chat.unescape(turn[a:b]) == text


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], f"{c}.{t} </s>[INST] \\ {'é' * c}") for c in range(6) for t in range(1 + 5 * c)]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(50, 3, "user", None), (50, 3, "assistant", ""), (50, None, None, "x"), (50, 9, "assistant", "end"), (None, 0, "user", "n"), (51, 0, "a\nb\\", "\n")]
    rows += [(60, t, "assistant", f"long {t}") for t in range(137)]
    rows += [(61, 1, "user", "twice")] * 2
    docs = [(*r, "t", 1) for r in rows]
    return spark.createDataFrame(docs, "conv_id long, turn long, role string, text string, tree string, rank int").repartition(4)


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    out = []
    for c, turns in by.items():
        low = lambda v: (v is not None, v if v is not None else 0)
        turns.sort(key=lambda r: (low(r.turn), r.role is not None, r.role or "", r.text is not None, r.text or ""))
        said = [(r.role or "", r.text or "") for r in turns]
        learn = "".join(t for role, t in said if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(said), sha("".join(f"{a}\n{b}\n" for a, b in said)), len(learn), sha(learn)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece_chars", [1, 200, 1_000_000])
def test_conversations_come_back(conversations, piece_chars):
    turns = chat.paths(chat.threads(conversations))
    written = chat.format_paths(turns, piece_chars=piece_chars)
    got = chat.digests(written).drop("rank", "formatted_chars").collect()
    assert sorted(map(tuple, got), key=repr) == expected(conversations.collect())


def test_loss_covers_the_assistant_only(conversations):
    rows = chat.format_paths(chat.paths(chat.threads(conversations.where("conv_id = -1")))).collect()
    (row,) = rows
    assert [chat.unescape(row.text[s.start : s.end]) for s in row.loss] == ["</s>[INST] ok [/INST]"]
    assert row.text.count(chat.END) == 2


def test_paths_of_trees(spark):
    """Every root-to-leaf path, best mean score first; cycles and NULL nodes are left out."""
    m = [
        ("a", 1, None, 0.0), ("a", 2, 1, 5.0), ("a", 3, 1, 1.0), ("a", 4, 2, -9.0), ("a", 5, 3, 3.0), ("a", 6, 3, 3.0),
        ("a", 7, 99, None), ("b", 1, None, 1.0), ("c", 1, 2, 1.0), ("c", 2, 1, 1.0), ("c", 3, 2, 1.0), ("a", None, 1, 7.0), (None, 1, None, 0.5), (None, 2, 1, 0.5),
        ("b", 1, None, 1.0),
    ]
    messages = spark.createDataFrame([(t, n, p, "user", f"{t}{n}", s) for t, n, p, s in m], "tree string, node long, parent long, role string, text string, score double")
    found = {}
    for r in chat.paths(messages).collect():
        found.setdefault((r.tree, r.rank), []).append((r.position, r.node))
    got = {k: [n for _, n in sorted(v)] for k, v in found.items()}
    assert got == {
        ("a", 1): [1, 3, 5], ("a", 2): [1, 3, 6], ("a", 3): [7], ("a", 4): [1, 2, 4], ("b", 1): [1], (None, 1): [1, 2],
    }
    best = chat.paths(messages, best=1).select("tree", "leaf").distinct().collect()
    assert {(r.tree, r.leaf) for r in best} == {("a", 5), ("b", 1), (None, 2)}


def test_empty_table(conversations):
    turns = chat.paths(chat.threads(conversations.limit(0)))
    assert chat.digests(chat.format_paths(turns)).count() == 0
