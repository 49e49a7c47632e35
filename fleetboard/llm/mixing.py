"""Mixing by soft membership: how often each document is taken, so that domains meet their targets.

All on DataFrame functions. A naive Bayes classifier counted from a labelled sample gives each
document a posterior over the domains. Its words are hashed into so many buckets that the model
has at most ``MODEL_NUMBERS`` numbers, whatever the corpus and the number of domains: every word
counts, and the broadcast model has a fixed bound.

With ``n`` the words of a document, ``p`` its posterior and ``W[k] = sum(n * p[k])``, rates
``r >= 0`` are fitted by projected-gradient least squares: they start at 1 and go down
``sum((s[k] - T[k])**2 / W[k]) / 2`` with ``s[k] = sum(r * n * p[k])`` the expected words of
domain ``k`` and ``T[k]`` its target. Measured by the documents' words, the gradient of a rate is
``sum(p[k] * e[k])`` with ``e[k] = (s[k] - T[k]) / W[k]``, so that one number a domain tells every
document its step, and the step is cut off where a rate would fall under its bound. As posteriors
add up to 1, a step of length 1 always descends; each aggregation also tries the spectral length
(Barzilai-Borwein) and four times that, and the best of them is taken. Rates are not written each
time: a document walks through the steps so far, which every task gets as one array, and all
aggregations share one compiled plan. A few numbers a domain reach the driver.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetboard.llm.common import cut, forget

log = logging.getLogger(__name__)

#: Labelled ids to learn from at most (those with the least hash).
TRAIN_ROWS = 20_000
#: Numbers of the model at most: buckets of words times domains and one.
MODEL_NUMBERS = 1 << 20
#: ``fit`` ends its descent when every domain is as near to its own target as this share of it.
CLOSE = 1e-4
#: It also ends when so many steps together lower the weighted squared distance by less than this share.
PATIENCE, WORTH = 10, 0.1
#: So many steps are walked through before the rates are written, and their walk begins anew.
WALK = 32
#: A domain that ends further from its target than this share of it is named in a warning.
MISSED = 1e-3


@dataclass
class Fit:
    """Rates with the domains in the order of their posteriors, their targets and the words reached."""

    rates: DataFrame
    domains: list
    targets: list[float]
    reached: list[float]

    @property
    def gaps(self) -> dict:
        """Per domain the distance from its target, as a share of it."""
        return {d: abs(r - t) / t if t else float(r > 0) for d, t, r in zip(self.domains, self.targets, self.reached)}


def words_of(text: str) -> Column:
    """Lower-case runs of letters, digits and all that is not ASCII; NULL has none."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\x00-/:-`{-\\x7f]+")
    return F.filter(parts, lambda w: w != "")


def _bucket(word: str, domains: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(max(1, MODEL_NUMBERS // (domains + 1))))


def classifier(rows: DataFrame, labelled: DataFrame, *, train_rows: int = TRAIN_ROWS) -> tuple[list, DataFrame, list[float]]:
    """The domains, the model (bucket, l0, l1, ...) and the logarithms of the domains' shares.

    ``rows`` has id, digest and text, ``labelled`` id and domain. NULL ids and domains are left out.
    A labelled id counts once, with its least domain and the text of least digest, however many
    rows have it.
    """
    ids = labelled.where("id IS NOT NULL AND domain IS NOT NULL").groupBy("id").agg(F.min("domain").alias("domain"))
    sample = ids.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    shares = {r.domain: r.n for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(shares)
    texts = rows.join(F.broadcast(sample), "id").groupBy("id", "domain").agg(F.min_by("text", "digest").alias("text"))
    words = texts.select("domain", F.explode(words_of("text")).alias("word"))
    counted = words.groupBy(_bucket("word", len(domains)).alias("bucket"), "domain").agg(F.count("*").alias("n"))
    if not domains:
        return [], counted.select("bucket"), []
    counted = cut(counted, "vocabulary")
    totals = {r.domain: r.n for r in counted.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    buckets = counted.agg(F.count_distinct("bucket")).first()[0]
    by_domain = counted.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("by"))
    model = by_domain.select("bucket", *[
        F.log((F.coalesce(F.try_element_at("by", F.lit(d)), F.lit(0)) + 1) / F.lit(float(totals.get(d, 0) + buckets + 1))).alias(f"l{k}")
        for k, d in enumerate(domains)
    ])
    return domains, model, [math.log(shares[d] / sum(shares.values())) for d in domains]


def posteriors(rows: DataFrame, domains: list, model: DataFrame, priors: list[float]) -> DataFrame:
    """Per distinct (id, digest): n, the words of one row, rows, and the posterior p0, p1, ...

    Words of buckets that the labelled sample does not have say nothing. A document's evidence is
    divided by the root of its known words, as words are not independent; else long texts would
    have no soft membership.
    """
    known = range(len(domains))
    words = rows.select("id", "digest", F.posexplode_outer(words_of("text")).alias("place", "word"))
    words = words.select("id", "digest", "place", "word", _bucket("word", len(domains)).alias("bucket"))
    summed = words.join(F.broadcast(model), "bucket", "left").groupBy("id", "digest").agg(
        F.count("word").alias("n"), F.count_if(F.expr("place IS NULL OR place = 0")).alias("rows"),
        F.sum(F.when(F.col("word").isNotNull(), F.expr("int(l0 IS NOT NULL)"))).alias("seen"),
        *[F.sum(F.when(F.col("word").isNotNull(), F.col(f"l{k}"))).alias(f"s{k}") for k in known],
    )
    one = F.greatest(F.sqrt(F.col("seen") / F.col("rows")), F.lit(1.0)) * F.col("rows")
    summed = summed.select(
        "id", "digest", "rows", (F.col("n") / F.col("rows")).alias("n"),
        *[(F.lit(priors[k]) + F.coalesce(F.col(f"s{k}"), F.lit(0.0)) / one).alias(f"z{k}") for k in known],
    )
    most = F.greatest(*[f"z{k}" for k in known]) if len(domains) > 1 else F.col("z0")
    powers = summed.select("id", "digest", "rows", "n", *[F.exp(F.col(f"z{k}") - most).alias(f"x{k}") for k in known])
    total = reduce(add, [F.col(f"x{k}") for k in known])
    return powers.select("id", "digest", "rows", "n", *[(F.col(f"x{k}") / total).alias(f"p{k}") for k in known])


def targets_of(totals: list[float], domains: list, weights: Mapping | None, temperature: float, tokens: float | None) -> list[float]:
    """Target words per domain.

    ``weights`` by domain (missing: 0), or else the domains' shares to the power ``temperature``.
    They are scaled to ``tokens``, or else so that no weighted domain has to shrink.
    """
    wanted = [float(weights.get(d, 0)) if weights is not None else t**temperature for d, t in zip(domains, totals)]
    if not any(w > 0 for w in wanted):
        return list(totals)
    scale = tokens / sum(wanted) if tokens is not None else max(t / w for t, w in zip(totals, wanted) if w > 0)
    return [scale * w for w in wanted]


def _numbers(values) -> str:
    """An array in SQL text; Spark folds it into one object that compiled code refers to."""
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def _walked(steps: list[np.ndarray], at_least: float) -> str:
    """The rate, in SQL, after the steps so far: each is cut off at the bound."""
    walk = f"array({', '.join(map(_numbers, steps))})"
    return f"aggregate({walk}, rate, (r, v) -> greatest(r - {_DOT}, {float(at_least)!r}D))"


_DOT = "aggregate(zip_with(p, v, (a, b) -> a * b), 0D, (t, x) -> t + x)"


def fit_rates(members: DataFrame, totals: list[float], targets: list[float], at_least: float = 0.0, close: float = 1e-6) -> tuple[DataFrame, list[float]]:
    """``members`` with ``rate`` (``at_least`` or more), and the domains' expected totals under it.

    Ends when each domain is within the share ``close`` of its own target. Where no rates reach the targets, as when posteriors do not tell the domains apart or
    ``at_least`` is too much for one of them, the least squares are gone down to until
    ``PATIENCE`` steps lower them by less than ``WORTH``.
    """
    known = range(len(targets))
    start, want = np.array(totals, float), np.array(targets, float)
    # A domain without any words is out of reach, whatever the rates.
    words = np.where(start > 0, start, 1.0)
    want = np.where(start > 0, want, 0.0)
    posterior = f"array({', '.join(f'p{k}' for k in known)})"
    now = members.selectExpr("*", f"greatest(1D, {float(at_least)!r}D) AS rate")
    written, steps = None, [np.zeros(len(want))]

    def measure(tried: list[np.ndarray]) -> list[tuple[np.ndarray, float]]:
        """Per step the domains' totals after it, and how far it moves the rates, squared."""
        if not start.any():  # No words, which may be no documents.
            return [(np.zeros(len(want)), 0.0) for _ in tried]
        rated = now.selectExpr("n * rows AS m", f"{posterior} AS p", "rate").selectExpr("m", "p", f"{_walked(steps, at_least)} AS old")
        ways = f"array({', '.join(map(_numbers, tried))})"
        after = rated.selectExpr("m", "p", "old", f"transform({ways}, v -> greatest(old - {_DOT}, {float(at_least)!r}D)) AS new")
        terms = "flatten(transform(new, x -> concat(transform(p, q -> m * q * x), array(m * (x - old) * (x - old)))))"
        # A document's terms are added up as one vector; a row of each would be documents times steps times domains.
        vector = array_to_vector(F.expr(f"transform({terms}, t -> coalesce(t, 0D))"))
        sums = after.agg(vector_to_array(Summarizer.sum(vector)).alias("sums")).first()["sums"]
        return [(row[:-1], float(row[-1])) for row in np.array(sums).reshape(len(tried), -1)]

    def height(sums: np.ndarray) -> float:
        return float(((sums - want) ** 2 / words).sum())

    sums, length = start if at_least <= 1 else measure([steps[0]])[0][0], 1.0
    heights = [height(sums)]
    while np.any(np.abs(sums - want) > close * np.where(want > 0, want, words)):
        slope = (sums - want) / words
        tried = [share * slope for share in sorted({1.0, length, 4 * length})]
        found = measure(tried)
        best = int(np.argmin([height(s) for s, _ in found]))
        if not height(found[best][0]) < heights[-1]:
            break  # No lower state by the precision of the sums.
        steps.append(tried[best])
        moved = ((found[best][0] - sums) ** 2 / words).sum()
        length = found[best][1] / moved if moved > 0 else 1.0
        sums = found[best][0]
        heights.append(height(sums))
        if len(heights) > PATIENCE and heights[-1] > (1 - WORTH) * heights[-1 - PATIENCE]:
            break
        if len(steps) > WALK:
            before, written = written, cut(now.selectExpr(*[c for c in now.columns if c != "rate"], f"{_in_place(posterior, steps, at_least)} AS rate"), "rates")
            now, steps = written, steps[:1]
            if before is not None:
                forget(before)
    fitted = now.selectExpr(*[c for c in now.columns if c != "rate"], f"{_in_place(posterior, steps, at_least)} AS rate")
    return fitted, [float(x) for x in sums]


def _in_place(posterior: str, steps: list[np.ndarray], at_least: float) -> str:
    return _walked(steps, at_least).replace("zip_with(p,", f"zip_with({posterior},")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("digest"), F.col(f"`{text}`").alias("text"))


def fit(
    docs: DataFrame, labelled: DataFrame, *, key: str = "doc_id", text: str = "text",
    weights: Mapping | None = None, temperature: float = 0.7, tokens: float | None = None, at_least: float = 0.0,
    train_rows: int = TRAIN_ROWS, close: float = CLOSE,
) -> Fit:
    """Rates of all documents, the domains in the order of their posterior, targets and words reached.

    ``labelled`` has columns id and domain. One row per distinct id and text: id, digest, rows
    (how many rows are equal), n (words), posterior (array), rate (0 or more) and copies: the
    whole part of the rate, and one more with the chance of its fraction, by a hash of the row.
    NULL and empty texts have no words and the domains' shares as posterior; their rate moves
    like any other but weighs nothing. Each domain ends within the share ``close`` of its target, or as
    ``Fit.gaps`` says. ``at_least`` 1 keeps every document. Domains that no rates bring
    to their targets are logged as a warning. Without labels there is no domain, and all rates are 1.
    """
    rows = _rows(docs, key, text)
    domains, model, priors = classifier(rows, labelled, train_rows=train_rows)
    if not domains:
        plain = rows.groupBy("id", "digest").agg(F.count("*").alias("rows"), F.max(F.size(words_of("text"))).cast("double").alias("n"))
        return Fit(plain.select(
            "id", "digest", "rows", "n", F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies")
        ), [], [], [])
    known = range(len(domains))
    members = cut(posteriors(rows, domains, model, priors), "posteriors")
    mass = F.col("n") * F.col("rows")
    totals = [x or 0.0 for x in members.agg(*[F.sum(mass * F.col(f"p{k}")) for k in known]).first()]
    targets = targets_of(totals, domains, weights, temperature, tokens)
    fitted, reached = fit_rates(members, totals, targets, at_least, close)
    chance = F.pmod(F.xxhash64("id", "digest", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    # Differences of a millionth are those of the order of summing, not of the data.
    steady = F.round("rate", 6)
    found = Fit(fitted.select(
        "id", "digest", "rows", "n", F.array(*[f"p{k}" for k in known]).alias("posterior"), steady.alias("rate"),
        (F.floor(steady) + (chance < steady - F.floor(steady)).cast("int")).cast("int").alias("copies"),
    ), domains, targets, reached)
    missed = {d: (reached[k], targets[k]) for k, d in enumerate(domains) if found.gaps[d] > MISSED}
    if missed:
        log.warning("domains that miss their targets (words reached, target): %s", missed)
    return found


def rates(docs: DataFrame, labelled: DataFrame, **options) -> tuple[DataFrame, list]:
    """``fit``'s rates and domains alone."""
    found = fit(docs, labelled, **options)
    return found.rates, found.domains


def mix(docs: DataFrame, labelled: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``copies`` says; all columns, whatever their names."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    own, words = (plain[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*plain)
    found, _ = rates(rows, labelled, key=own, text=words, **options)
    wanted = found.select(F.concat_ws(":", F.col("id").cast("string"), "digest").alias("_tag"), "copies")
    tagged = rows.withColumn("_tag", F.concat_ws(":", F.col(own).cast("string"), F.xxhash64(words)))
    many = tagged.join(wanted, "_tag").where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))
    return many.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns)])
