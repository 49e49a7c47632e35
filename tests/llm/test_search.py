import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fleetboard.llm import search


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, queries, k):
    """All documents scored: (item, rank, id, score)."""
    counts = [(i, Counter(split(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    documents, length = len(counts), sum(sum(c.values()) for _, c in counts)
    having = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in queries:
        wanted.setdefault(item, set()).update(split(text))
    found = []
    for item, terms in wanted.items():
        scores = []
        for i, c in counts:
            norm = 50 + 50 * sum(c.values()) * documents // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * having[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * norm))
                for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i, score))
        for rank, (_, _, i, score) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, i, score))
    return found


@pytest.fixture(scope="module")
def queries(prose):
    said = [(i, prose(5 + 9 * i, 100 + i)) for i in range(6)] + [(10, "ko"), (11, "KO lu, ko"), (12, None), (13, "—"), (14, "never0met")]
    return said + [(15, "same lu"), (15, "ba"), (None, "lu koda"), (None, "x")]


def key(r):
    return tuple((v is None, v) for v in r)


@pytest.mark.parametrize("k, shard", [(50, 1 << 15), (3, 4), (1, 1), (7, 10)])
def test_ranks_against_scoring_everything(spark, docs, texts, queries, monkeypatch, k, shard):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    items = spark.createDataFrame([(*q, "t", 1) for q in queries], "item_id long, text string, term string, rank int")
    found = search.search(docs, items, k=k).collect()
    assert sorted(map(tuple, found), key=key) == sorted(plain(texts, queries, k), key=key)


def test_blocks_of_queries_and_text_ids(spark, texts, queries):
    named = [(None if i is None else f"d{i:03}", t) for i, t in texts]
    docs = spark.createDataFrame(named, "doc_id string, text string")
    items = spark.createDataFrame([(str(i), t) for i, t in queries], "item_id string, text string")
    found = search.search(docs, items, k=5, block_terms=20).collect()
    assert sorted(map(tuple, found), key=key) == sorted(plain(named, [(str(i), t) for i, t in queries], 5), key=key)


def random_shard(seed, docs=3000, terms=40):
    own = random.Random(seed)
    rows = []
    for i in range(docs):
        counts = Counter(min(int(own.expovariate(0.12)), terms - 1) for _ in range(own.randrange(1, 25)))
        rows.append((i, sum(counts.values()), sorted(counts), [counts[t] for t in sorted(counts)]))
    ids, n, numbers, times = zip(*rows)
    table = pa.table({
        "id": pa.array(ids), "n": pa.array(n), "terms": pa.array(numbers, pa.list_(pa.int32())), "times": pa.array(times, pa.list_(pa.int32())),
    })
    return search.Shard(table, docs, sum(n)), rows, sum(n)


@pytest.mark.parametrize("seed", range(4))
def test_limited_accumulators_are_exact_and_fewer(seed):
    shard, rows, length = random_shard(seed)
    having = Counter(t for r in rows for t in r[2])
    weights = {t: search.weight(len(rows), n) for t, n in having.items()}
    terms = sorted(weights.items(), key=lambda x: (-x[1], x[0]))
    scores = np.zeros(len(rows), np.int64)
    for i, n, numbers, times in rows:
        norm = 50 + 50 * n * len(rows) // length
        scores[i] = sum(weights[t] * (10**9 * tf // (1000 * tf + 20 * norm)) for t, tf in zip(numbers, times))
    best = np.lexsort((np.arange(len(rows)), -scores))
    made = []
    limited = search.Shard._limited
    for k in (1, 10, 50):
        places, found = shard.best(terms, k, 0)
        assert places.tolist() == best[:k].tolist() and found.tolist() == scores[best[:k]].tolist()
        # With the floor that better documents elsewhere set, those on it stay.
        floor = int(scores[best[k // 2]])
        places, found = shard.best(terms, k, floor)
        above = [b for b in best[:k] if scores[b] >= floor]
        assert places.tolist()[: len(above)] == above
        shard._limited = lambda *a: made.append(limited(*a)) or made[-1]
        shard.best(terms, k, 0)
    stopped = [m for m in made if m is not None]
    assert stopped and min(map(len, stopped)) < (scores > 0).sum()


def test_no_documents_or_queries(docs, no_docs, spark):
    items = spark.createDataFrame([(1, "ko lu")], "item_id long, text string")
    assert search.search(no_docs, items).collect() == []
    assert search.search(docs.where("text IS NULL"), items).collect() == []
    assert search.search(docs, items.limit(0)).collect() == []
    found = search.search(docs, items)
    assert found.columns == ["item", "rank", "id", "score"] and dict(found.dtypes)["rank"] == "int"
