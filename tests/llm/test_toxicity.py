import numpy as np
import pyarrow as pa
import pytest
from fleetboard.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark, prose):
    rows, marks = [], []
    for i in range(400):
        bad = i % 8 == 0
        words = prose(50 + i % 40, i).split(" ")
        if bad:
            words[7:7] = ["vile", "scorn" + "aeiou"[i % 5] + "x", "vile!"]
        rows.append((i, " ".join(words), 1))
        if i % 2 == 0:
            marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs, spark.createDataFrame([*marks, (None, 1), (2, None)], "doc_id long, toxic int")


def test_finds_the_toxic_texts(corpus):
    docs, labels = corpus
    got = toxicity.scores(docs, labels).collect()
    assert len(got) == 400 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held if r.predicted} == {r.doc_id for r in held if r.doc_id % 8 == 0}


def test_held_out_labels_change_nothing(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out("doc_id"), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    rows = lambda l: sorted((r.doc_id, r.score) for r in toxicity.scores(docs, l).collect())
    assert rows(labels) == rows(flipped)


def test_every_kind_of_row(corpus, docs, no_docs):
    _, labels = corpus
    got = toxicity.scores(docs, labels).collect()
    assert len(got) == docs.count() and len({r.score for r in got if r.doc_id in (50, 51, 52)}) == 1
    assert toxicity.scores(no_docs, labels).count() == 0
    assert all(r.score < 0.01 for r in toxicity.scores(docs, labels.limit(0)).collect())


def test_the_risk_is_corrected_where_it_turns_negative():
    """Toxic texts hidden among the unlabelled do not drag their features down."""
    bad, clean = np.array([1, 2]), [np.array([10 + i]) for i in range(10)]
    model = toxicity.fit([bad] * 20, [bad] * 10 + clean * 9, prior=0.1)
    assert set(model.known) == {1, 2}
    assert model.constant < 0 and model.constant + model.weight.sum() > 0
    assert toxicity.fit([], clean, 0.2).constant == pytest.approx(np.log(0.25))


def test_features_do_not_depend_on_the_batch(texts):
    values = [t for _, t in texts]
    text, feature = toxicity.document_features(pa.array(values, pa.string()))
    for i, v in enumerate(values):
        _, own = toxicity.document_features(pa.array([v], pa.string()))
        assert np.array_equal(feature[text == i], own)
    some = np.unique(feature)[::3]
    text, place = toxicity.document_features(pa.array(values, pa.string()), some)
    assert len(text) and all(some[p] in feature for p in place)


def test_gradients_against_differences():
    own = np.random.default_rng(3)
    features, n_p, n_u, prior = 6, 9, 20, 0.2

    def places(n):
        hit = own.random((n, features)) < 0.4
        return (*np.nonzero(hit), n), hit.astype(float)

    (toxic, x_p), (free, x_u) = places(n_p), places(n_u)
    for scale in (0.1, 1.0, 3.0):
        at = own.normal(0, scale, features + 1)
        positive, negative, by_positive, by_negative = toxicity.risks(at, toxic, free, prior)

        def plain(at):
            z_p, z_u = x_p @ at[:-1] + at[-1], x_u @ at[:-1] + at[-1]
            as_toxic, as_clean = lambda z: np.log(1 + np.exp(-z)), lambda z: np.log(1 + np.exp(z))
            return prior * as_toxic(z_p).mean(), as_clean(z_u).mean() - prior * as_clean(z_p).mean()

        assert (positive, negative) == pytest.approx(plain(at))
        for i in range(features + 1):
            step = np.zeros(features + 1)
            step[i] = 1e-6
            up, down = plain(at + step), plain(at - step)
            assert by_positive[i] == pytest.approx((up[0] - down[0]) / 2e-6, abs=1e-7)
            assert by_negative[i] == pytest.approx((up[1] - down[1]) / 2e-6, abs=1e-7)


def test_features_against_plain_python(prose):
    import re

    import xxhash

    texts = [prose(40, 1), "Vile SCORNAX né, né-12 éééééé", "", None, "abcdefg abcdxyz"]
    text_of, feature = toxicity.document_features(pa.array(texts))
    for i, text in enumerate(texts):
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        want = set()
        for word in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower):
            want.add(xxhash.xxh32_intdigest(word.encode()))
            want |= {xxhash.xxh32_intdigest(word[:n], seed=n) for n in (4, 5) if len(word) > n}
        assert set(feature[text_of == i].tolist()) == want


def test_a_toxic_id_on_a_third_of_all_rows_counts_once(corpus, spark, monkeypatch):
    docs, labels = corpus
    hot = spark.createDataFrame([(5000, f"vile {i} copy", 1) for i in range(200)], docs.schema)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda toxic, free, prior: seen.append((len(toxic), len(free))))
    toxicity.learn(docs, labels)
    toxicity.learn(docs.unionAll(hot), labels.unionAll(spark.createDataFrame([(5000, 1)] * 30, labels.schema)))
    assert seen[1] == (seen[0][0] + 1, seen[0][1] + 1) or seen[1] == seen[0]
