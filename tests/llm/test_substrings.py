import hashlib
import random

import pytest
from fleetboard.llm import substrings

LAST = substrings.LAST


def plain(rows, window):
    split = lambda t: (t or "").encode().split()
    first = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (LAST if i is None else i):
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs, window):
    rows = substrings.remove_repeats(docs, window=window, digest_only=True).drop("spans").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("window", [1, 7, 50])
def test_against_all_windows(docs, texts, window):
    assert found(docs, window) == plain(texts, window)


def test_passages_in_ever_other_surroundings(spark, prose):
    own = random.Random(5)
    passages = [prose(n, 900 + n) for n in (50, 51, 60, 75, 120)]
    rows = []
    for i in range(60):
        parts = [prose(own.randrange(30), 1000 + i)]
        for _ in range(own.randrange(4)):
            words = own.choice(passages).split(" ")
            a = own.randrange(0, 15)
            parts += [" ".join(words[a : len(words) - own.randrange(15)]), prose(own.randrange(4), own.random())]
        rows.append((i, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs, 50) == plain(rows, 50)
    assert found(docs, 20) == plain(rows, 20)


def test_spans_and_kept_text(spark, prose):
    passage = prose(55, 3)
    docs = spark.createDataFrame([(1, passage), (2, f"a b  {passage}\nc"), (3, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert [(s.start, s.end) for s in got[2].spans] == [(2, 57)] and got[2].kept == "a b c"
    assert got[1].spans == [] and got[1].kept == passage and got[3].kept == "a b"


def test_empty_table_and_window_bound(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(no_docs, window=0)


@pytest.mark.parametrize("window", [61, 100, 130])
def test_windows_longer_than_a_mask(spark, prose, window):
    own = random.Random(window)
    base = prose(500, 31).split(" ")
    rows = [(i, " ".join([prose(own.randrange(9), i), *base[own.randrange(200) : 300 + own.randrange(200)], prose(3, i + 99)])) for i in range(14)]
    rows += [(20, " ".join(["same"] * 400)), (21, " ".join(["same"] * 250)), (22, " ".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, window) == plain(rows, window)


def test_no_join_key_is_met_beside_an_aggregate(docs, monkeypatch):
    """Each skewed side meets a stored table, so that adaptive execution may split it."""
    stored = []
    real = substrings.cut
    monkeypatch.setattr(substrings, "cut", lambda df, purpose: stored.append(purpose) or real(df, purpose))
    substrings.remove_repeats(docs, window=7).count()
    assert {"shared", "earliest", "masks"} <= set(stored)
