import math

import numpy as np
import pytest
from fleetboard.llm import mixing
from fleetboard.llm.common import cut


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, " ".join(["alpha", "beta", "gamma"][i % 3 :] + [f"w{i % 4}"] * (i % 9))) for i in range(90)]
    rows += [(i, "delta epsilon zeta " * 5 + f"w{i % 4}") for i in range(90, 120)] + [(200, None), (201, ""), (7, rows[7][1]), (None, "alpha x"), (None, None)]
    labelled = [(i, "two" if 90 <= i < 120 else "one") for i in range(0, 120, 2)] + [(None, "one"), (8, None)]
    docs = spark.createDataFrame([(*r, 5, "q") for r in rows], "doc_id long, text string, copies int, rate string")
    return docs, spark.createDataFrame(labelled, "id long, domain string")


def totals(found):
    rows = found.collect()
    k = len(rows[0].posterior)
    return [sum(r.rate * r.n * r.rows * r.posterior[i] for r in rows) for i in range(k)]


@pytest.mark.parametrize("weights", [{"one": 1, "two": 1}, {"one": 1, "two": 3}, {"one": 4, "two": 1}])
def test_expected_words_meet_the_targets(corpus, weights):
    found, domains = mixing.rates(*corpus, weights=weights, tokens=900.0)
    assert domains == ["one", "two"]
    want = [900 * weights[d] / sum(weights.values()) for d in domains]
    assert totals(found) == pytest.approx(want, rel=1e-3)
    assert all(r.rate >= 0 and sum(r.posterior) == pytest.approx(1) for r in found.collect())


def test_posteriors_against_plain_python(corpus):
    docs, labelled = corpus
    split = lambda t: [w for w in (t or "").split(" ") if w]
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    marks = [(r.id, r.domain) for r in labelled.collect() if r.id is not None and r.domain is not None]
    shares = {d: sum(x == d for _, x in marks) for d in ("one", "two")}
    count = {d: {} for d in shares}
    for i, d in marks:
        for w in split(text[i]):
            count[d][w] = count[d].get(w, 0) + 1
    known = set(count["one"]) | set(count["two"])
    found, _ = mixing.rates(docs, labelled)
    for r in found.where("id IS NOT NULL").collect():
        own = split(text[r.id])
        seen = [w for w in own if w in known]
        z = []
        for d in ("one", "two"):
            total = sum(count[d].values()) + len(known) + 1
            s = sum(math.log((count[d].get(w, 0) + 1) / total) for w in seen)
            z.append(math.log(shares[d] / len(marks)) + s / max(1.0, math.sqrt(len(seen))))
        p = 1 / (1 + math.exp(z[1] - z[0]))
        assert r.posterior[0] == pytest.approx(p) and r.n == len(own)
        assert r.rows == (2 if r.id == 7 else 1)


def test_a_rare_domain_keeps_its_words(spark):
    # 5,000 words of the big domain, each oftener than any of the rare one's.
    big = [(i, " ".join(f"big{(i * 50 + j) % 5000}" for j in range(100))) for i in range(200)]
    rare = [(1000 + i, " ".join(f"rare{i * 3 % 10 + j}" for j in range(10))) for i in range(40)]
    docs = spark.createDataFrame([*big, *rare, (2000, None), (2001, ""), rare[0]], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "big") for i, _ in big] + [(1000, "rare"), (1003, "rare")], "id long, domain string")
    found, domains = mixing.rates(docs, labelled, weights={"big": 1, "rare": 1})
    rows = {r.id: r for r in found.collect()}
    assert domains == ["big", "rare"] and len(rows) == 242
    own = [rows[i].posterior[1] for i, _ in rare]
    assert min(own) > 0.5
    assert rows[2000].n == rows[2001].n == 0 and rows[2000].posterior[1] == pytest.approx(2 / 202)
    assert (rows[1000].rows, rows[1000].n, rows[5].rows, rows[5].n) == (2, 10, 1, 100)


def test_the_model_has_a_fixed_bound(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "MODEL_NUMBERS", 9)
    docs, labelled = corpus
    domains, model, _ = mixing.classifier(mixing._rows(docs, "doc_id", "text"), labelled)
    assert len(domains) == 2 and 0 < model.count() <= 3  # of 3 buckets
    found, _ = mixing.rates(docs, labelled)
    assert sum(r.rows for r in found.collect()) == docs.count()


def test_one_labelled_id_on_a_third_of_all_rows(spark):
    rows = [(i, f"one a{i} " * 5) for i in range(40)] + [(100 + i, f"two b{i} " * 5) for i in range(40)]
    hot = [(500, f"one c{i} " * 3) for i in range(40)]
    labelled = spark.createDataFrame([(i, "one" if i < 100 else "two") for i, _ in rows[::2]] + [(500, "one")] * 40, "id long, domain string")
    docs = spark.createDataFrame(rows + hot, "doc_id long, text string")
    _, model, priors = mixing.classifier(mixing._rows(docs, "doc_id", "text"), labelled)
    assert priors == pytest.approx([math.log(21 / 41), math.log(20 / 41)])
    # 40 texts of two words each, and a single one of the id with 40 texts.
    assert model.count() == 2 + 40 + 1
    found, _ = mixing.rates(docs, labelled, weights={"one": 1, "two": 2}, tokens=3000.0)
    assert found.count() == 120 and totals(found) == pytest.approx([1000, 2000], rel=1e-3)


def test_copies_round_the_rate(corpus):
    found, _ = mixing.rates(*corpus, weights={"one": 1, "two": 2})
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in found.collect())
    again, _ = mixing.rates(*corpus, weights={"one": 1, "two": 2})
    assert sorted(map(str, found.collect())) == sorted(map(str, again.collect()))


def test_mix_repeats_rows(corpus):
    docs, labelled = corpus
    mixed = mixing.mix(docs, labelled, weights={"one": 1, "two": 3}, at_least=1.0)
    assert mixed.columns == docs.columns
    rows, before = mixed.collect(), docs.collect()
    assert set(rows) == set(before) and len(rows) > len(before)
    found, _ = mixing.rates(docs, labelled, weights={"one": 1, "two": 3}, at_least=1.0)
    want = {(r.id, r.digest): r.copies * r.rows for r in found.collect()}
    assert len(rows) == sum(want.values()) and all(r.rate >= 1 for r in found.collect())


def skewed(spark, domains, own):
    """Posteriors of one big domain and small ones whose documents give them a share in ``own``."""
    g = np.random.default_rng(domains)
    rows = []
    for i in range(4000):
        d = 0 if i % 10 else 1 + i // 10 % (domains - 1)
        p = 0.02 * g.dirichlet(np.ones(domains))
        if d:
            p[d] += g.uniform(*own)
        p[0] += 1 - p.sum()
        rows.append((i, i, 1, float(g.integers(5, 300)), *map(float, p)))
    columns = ", ".join(f"p{k} double" for k in range(domains))
    p, n = np.array([r[4:] for r in rows]), np.array([r[3] for r in rows])
    return cut(spark.createDataFrame(rows, f"id long, digest long, rows long, n double, {columns}"), "members"), p, n


@pytest.mark.parametrize("domains, own", [(4, (0.3, 0.3)), (12, (0.1, 0.3)), (300, (0.5, 0.7))])
def test_skewed_overlapping_domains_each_meet_their_own_target(spark, domains, own):
    members, p, n = skewed(spark, domains, own)
    totals = p.T @ n
    targets = mixing.targets_of(list(totals), list(range(domains)), None, 0.7, None)
    found, reached = mixing.fit_rates(members, list(totals), targets)
    rate = np.array([r.rate for r in found.orderBy("id").collect()])
    assert rate.min() >= 0 and p.T @ (n * rate) == pytest.approx(reached)
    assert reached == pytest.approx(targets, rel=1e-5)


def test_targets_out_of_reach_are_neared_and_named(spark, corpus, caplog):
    members, p, n = skewed(spark, 4, (0.3, 0.3))
    totals = p.T @ n
    targets = np.array(mixing.targets_of(list(totals), list(range(4)), None, 0.7, None))
    _, reached = mixing.fit_rates(members, list(totals), list(targets), 1.0)
    rate = np.ones(len(n))
    for _ in range(3000):
        rate = np.maximum(rate - p @ ((p.T @ (n * rate) - targets) / totals), 1.0)
    off = lambda s: ((s - targets) ** 2 / totals).sum()
    assert off(np.array(reached)) < 1.05 * off(p.T @ (n * rate))
    mixing.rates(*corpus, tokens=10.0, at_least=1.0)
    assert "miss their targets" in caplog.text and "'one'" in caplog.text


def test_a_domain_without_weight_goes(corpus):
    found, _ = mixing.rates(*corpus, weights={"two": 1}, tokens=100.0)
    one, two = totals(found)
    assert one < 5 and two == pytest.approx(100, rel=0.05)


def test_without_labels_or_rows(corpus):
    docs, labelled = corpus
    found, domains = mixing.rates(docs, labelled.limit(0))
    assert domains == [] and {(r.rate, r.copies) for r in found.collect()} == {(1.0, 1)}
    assert mixing.mix(docs, labelled.limit(0)).count() == docs.count()
    assert mixing.mix(docs.limit(0), labelled).count() == 0


def test_no_python_in_the_plan(corpus):
    docs, labelled = corpus
    plan = mixing.mix(docs, labelled)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_a_descent_makes_no_row_for_each_document_and_domain(spark, monkeypatch):
    members, p, n = skewed(spark, 4, (0.3, 0.3))
    totals = p.T @ n
    targets = mixing.targets_of(list(totals), list(range(4)), None, 0.7, None)
    plans, collect = [], type(members).collect
    monkeypatch.setattr(type(members), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    found, reached = mixing.fit_rates(members, list(totals), targets)
    assert reached == pytest.approx(targets, rel=1e-5) and found.count() == len(n)
    assert len(plans) > 3 and not any("Generate" in plan or "Python" in plan for plan in plans)


def test_a_descent_over_no_documents_has_no_words(spark):
    none = spark.createDataFrame([], "id long, digest long, rows long, n double, p0 double, p1 double")
    found, reached = mixing.fit_rates(none, [0.0, 0.0], [0.0, 0.0], 2.0)
    assert found.count() == 0 and reached == [0.0, 0.0]
