import hashlib
from itertools import pairwise

import numpy as np
import pytest
from fleetboard.llm import phrases


def plain_phrases(data):
    seen, now = set(), b""
    for i in range(len(data)):
        now += data[i : i + 1]
        if now not in seen:
            seen.add(now)
            now = b""
    return seen


def test_parse_takes_the_shortest_new_phrase(texts):
    for _, t in texts:
        known = {}
        phrases.parse((t or "").encode(), known)
        assert set(known) == plain_phrases((t or "").encode())


def expected(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for (i, t), (_, after) in pairwise([*order, order[0]]):
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        f, e, a = map(phrases.fingerprint_of, (t, edited, after))
        near = lambda x, y: phrases.likeness(phrases.read(x), phrases.read(y))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, near(f, e), near(f, a)))
    return sorted(out, key=repr)


def test_pairs_against_one_list(docs, texts):
    assert sorted(map(tuple, phrases.edited_pairs(docs).collect()), key=repr) == expected(texts)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_documents(spark, texts, n):
    rows = [(i, t) for i, t in texts if i in (3, 4)][:n]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows) if rows else []
    assert sorted(map(tuple, phrases.edited_pairs(docs).collect()), key=repr) == want


def test_likeness_is_exact_for_small_sets_and_near_for_large(prose):
    a, b = prose(40, 1), prose(40, 1) + " " + prose(10, 2)
    sets = [plain_phrases(t.encode()) for t in (a, b)]
    assert max(map(len, sets)) > 20
    own = [phrases.signature(phrases.hashes(s)) for s in sets]
    exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    if max(map(len, sets)) <= phrases.SIZE:
        assert phrases.likeness(*own) == pytest.approx(exact)
    big = [plain_phrases((prose(4000, 3) + prose(n, 4)).encode()) for n in (500, 4000)]
    close = phrases.likeness(*(phrases.signature(phrases.hashes(s)) for s in big))
    assert abs(close - len(big[0] & big[1]) / len(big[0] | big[1])) < 0.15
    none = np.zeros(0, np.uint32)
    assert phrases.likeness(none, none) == 1 and phrases.likeness(none, own[0]) == 0
