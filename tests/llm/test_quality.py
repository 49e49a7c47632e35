import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fleetboard.llm import quality


@pytest.fixture(scope="module")
def labelled(spark, prose):
    rows, marks = [], []
    for i in range(240):
        good = i % 3 > 0
        text = prose(60 + i, i) if good else (" ".join([f"w{i % 7}"] * 80) if i % 2 else prose(60, i).upper().replace(" ", "!! "))
        rows.append((i, text, 0.5, "c"))
        marks.append((i, int(good)))
    marks += [(None, 1), (0, None), (1, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, c0 string"), spark.createDataFrame(marks, "doc_id long, quality int")


def test_learns_what_the_labels_mark(labelled):
    docs, labels = labelled
    got = quality.scores(docs, labels).collect()
    assert len(got) == 240 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 20
    right = [r.predicted == int(r.doc_id % 3 > 0) for r in held]
    assert np.mean(right) > 0.95


def test_held_out_labels_change_nothing(labelled, spark):
    docs, labels = labelled
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out("doc_id"), 1 - labels["quality"]).otherwise(labels["quality"]))
    rows = lambda l: sorted((r.doc_id, r.score) for r in quality.scores(docs, l).collect())
    assert rows(labels) == rows(flipped)


def test_scores_every_kind_of_row(labelled, docs, no_docs):
    _, labels = labelled
    got = quality.scores(docs, labels).collect()
    assert len(got) == docs.count()
    blank = {r.score for r in got if r.doc_id in (50, 51)}
    assert len(blank) == 1 and all(0 <= r.score <= 1 for r in got)
    assert quality.scores(no_docs, labels).count() == 0
    assert {r.score for r in quality.scores(docs, labels.limit(0)).collect()} == {0.5}


def test_keep_good_keeps_columns_and_whole_rows(labelled):
    docs, labels = labelled
    kept = quality.keep_good(docs, labels, threshold=0.3)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.scores(docs, labels, threshold=0.3).collect() if r.predicted}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == want and {r.score for r in rows} == {0.5}


def test_flat_trees_walk_as_one_row_would():
    own = np.random.default_rng(1)
    x = own.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    trees = quality.Trees.grow(x, y, trees=30, depth=3)

    def walk(row):
        margin = trees.base
        for column, limit, value in zip(trees.column, trees.limit, trees.value):
            node = 0
            while node < len(column):
                node = 2 * node + (2 if row[column[node]] > limit[node] else 1)
            margin += value[node - len(column)]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == (y > 0)).mean() > 0.97


def test_statistics_do_not_depend_on_the_batch(texts):
    values = [t for _, t in texts]
    whole = quality.statistics(pa.array(values, pa.string()))
    assert np.isfinite(whole).all()
    alone = np.vstack([quality.statistics(pa.array([v], pa.string())) for v in values])
    assert np.allclose(whole, alone)
    part = quality.statistics(pa.array(values, pa.string()).slice(5, 9))
    assert np.allclose(part, whole[5:14])


def test_a_labelled_id_on_a_third_of_all_rows_counts_once(labelled, spark, monkeypatch):
    docs, labels = labelled
    hot = spark.createDataFrame([(1000, f"copy {i} " * (i % 9 + 1), 0.5, "c") for i in range(120)], docs.schema)
    marks = spark.createDataFrame([(1000, 1)] * 50 + [(1000, 0)], labels.schema)
    seen = []
    monkeypatch.setattr(quality.Trees, "grow", classmethod(lambda cls, x, y, **_: seen.append((len(x), int(y.sum())))))
    quality.learn(docs, labels)
    quality.learn(docs.unionAll(hot), labels.unionAll(marks))
    # One row more, with its least label.
    held = zlib.crc32(b"1000") % 5 == 0
    assert seen[1] == (seen[0][0] + (not held), seen[0][1])


def test_statistics_against_plain_python(prose):
    texts = [prose(40, 1), "A b, a! 12 b b\n\nEnd. of it\nEnd. of it", "", None, "x", "é é é ñ", "a|b {c} <d> 5% ? !", prose(300, 2) + "\n" + prose(5, 3)]
    found = quality.statistics(pa.array(texts))
    for row, text in zip(found, texts):
        body = (text or "").encode()
        words = [w for w in re.split(rb"[\x20\x09-\x0d]+", body) if w]
        lines = [line for line in body.split(b"\n") if line]
        share = lambda chars: sum(b in chars for b in body) / max(1, len(body))  # noqa: B023, E731
        each = max(1, len(words))
        sizes = [len(w) for w in words]
        mean = sum(sizes) / each
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        want = {
            "log_bytes": math.log1p(len(body)), "upper": share(range(65, 91)), "lower": share(range(97, 123)), "digit": share(range(48, 58)),
            "space": share(b" "), "newline": share(b"\n"), "other": share(range(128, 256)), "stop": share(b".,"), "mark": share(b"!?"),
            "bar": share(b"|"), "angle": share(b"<>{}[]()=/\\"), "sign": share(b"#$%&*+@^_~"), "word_mean": mean,
            "word_spread": math.sqrt(max(0, sum(s * s for s in sizes) / each - mean**2)), "word_longest": math.log1p(max(sizes, default=0)),
            "one_letter": sum(s <= 2 for s in sizes) / each, "distinct": len(set(words)) / each,
            "same_next": sum(a == b for a, b in zip(words, words[1:])) / each,
            "top_share": max((words.count(w) for w in set(words)), default=0) / each,
            "triples_distinct": len(set(triples)) / max(1, len(triples)), "ends_stop": sum(w[-1:] in (b".", b",") for w in words) / each,
            "line_mean": math.log1p(len(body) / max(1, len(lines))), "lines_distinct": len(set(lines)) / max(1, len(lines)),
            "line_words": math.log1p(len(words) / max(1, len(lines))), "log_words": math.log1p(len(words)),
        }
        assert list(want) and set(want) == set(quality.NAMES)
        assert dict(zip(quality.NAMES, row)) == pytest.approx(want)


def test_one_round_of_boosting_against_all_cuts():
    own = np.random.default_rng(8)
    x = np.column_stack([own.integers(0, 9, 200), own.integers(0, 5, 200), own.normal(size=200)]).astype(float)
    y = ((x[:, 0] > 4) ^ (own.random(200) < 0.1)).astype(float)
    made = quality.Trees.grow(x, y, trees=1, depth=1, rate=0.3)
    base = math.log((y.sum() + 0.5) / (200.5 - y.sum()))
    p = 1 / (1 + math.exp(-base))
    gradient, weight = p - y, np.full(200, p * (1 - p))
    part = lambda rows: gradient[rows].sum() ** 2 / (weight[rows].sum() + 1.0)
    every = {}
    for c in range(3):
        for limit in np.unique(np.quantile(x[:, c], np.linspace(0, 1, 65)[1:-1])):
            left = x[:, c] <= limit
            if weight[left].sum() >= 2 and weight[~left].sum() >= 2:
                every[c, limit] = part(left) + part(~left) - part(np.ones(200, bool))
    column, limit = int(made.column[0][0]), float(made.limit[0][0])
    assert every[column, limit] == pytest.approx(max(every.values())) and column == 0
    left = x[:, column] <= limit
    value = lambda rows: -0.3 * gradient[rows].sum() / (weight[rows].sum() + 1.0)
    assert made.score(x) == pytest.approx(1 / (1 + np.exp(-(base + np.where(left, value(left), value(~left))))))
