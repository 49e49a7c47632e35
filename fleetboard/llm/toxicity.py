"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over the presence of words and of their first four and five letters. It
is trained with numpy from confirmed toxic texts (P) and texts whose label is not looked at (U).
With the class prior ``p``, the share of toxic texts, the risk of calling a clean text toxic is
estimated from both samples as the loss of U taken as clean, less ``p`` times that of P taken as
clean; where this turns negative, which only overfitting can do, it is corrected: the step goes
the other way instead. Learning stays on the driver, on bounded samples (``TOXIC_ROWS``,
``UNLABELLED_ROWS``); texts are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fleetboard.llm.common import one_text, text_batches
from fleetboard.llm.quality import held_out
from fleetboard.llm.words import ALPHANUMERIC, Words

#: Confirmed toxic and unlabelled rows to learn from at most, those with the least hash of their id.
TOXIC_ROWS = 4_000
UNLABELLED_ROWS = 10_000


def features_of(word: bytes) -> list[int]:
    """32-bit ids of the word and of its first letters."""
    found = [xxhash.xxh32_intdigest(word)]
    letters = word.decode("utf-8", "ignore")
    for n in (4, 5):
        if len(letters) > n:
            found.append(xxhash.xxh32_intdigest(letters[:n], seed=n))
    return found


def document_features(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs; where sorted ``known`` ids are given, places in it."""
    words = Words(texts, ALPHANUMERIC, lower=True)
    lists = [features_of(w) for w in words.values.to_pylist()]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((f for own in lists for f in own), np.int64, int(counts.sum()))
    code = np.repeat(np.arange(len(lists)), counts)
    if known is not None:
        at = np.searchsorted(known, flat)
        hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == flat) if len(known) else np.zeros(len(flat), bool)
        flat, code = at[hit], code[hit]
        counts = np.bincount(code, minlength=len(lists))
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(words.first) - 1), words.counts)
    own = words.codes[counts[words.codes] > 0] if len(lists) else words.codes
    text = text[counts[words.codes] > 0] if len(lists) else text
    pair = np.unique(text * len(lists) + own) if len(own) else np.zeros(0, np.int64)
    text, own = (pair // len(lists), pair % len(lists)) if len(own) else (pair, pair)
    n = counts[own] if len(own) else own
    take = np.repeat(first[own] if len(own) else own, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
    pairs = np.unique((np.repeat(text, n) << 32) | flat[take]) if len(own) else np.zeros(0, np.int64)
    return pairs >> 32, pairs & 0xFFFFFFFF


class Linear:
    """Weights of the chosen features and a constant."""

    def __init__(self, known: np.ndarray, weight: np.ndarray, constant: float):
        self.known, self.weight, self.constant = known, weight, constant

    def score(self, texts: pa.Array) -> np.ndarray:
        text, place = document_features(texts, self.known)
        margin = self.constant + np.bincount(text, self.weight[place] if len(place) else None, len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def risks(parameters: np.ndarray, toxic: tuple, unlabelled: tuple, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The risk on toxic texts, the estimated risk on clean ones, and the gradients of both.

    ``toxic`` and ``unlabelled`` are (row, feature's place, rows); the last parameter is the
    constant. Logistic loss: log(1 + exp(-z)) as toxic, log(1 + exp(z)) as clean.
    """
    (row_p, at_p, n_p), (row_u, at_u, n_u) = toxic, unlabelled

    def back(row: np.ndarray, at: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(at, slope[row], len(parameters) - 1), slope.sum())

    w = parameters[:-1]
    z_p = parameters[-1] + np.bincount(row_p, w[at_p], n_p)
    z_u = parameters[-1] + np.bincount(row_u, w[at_u], n_u)
    s_p, s_u = 1 / (1 + np.exp(-np.clip(z_p, -50, 50))), 1 / (1 + np.exp(-np.clip(z_u, -50, 50)))
    negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
    clean = back(row_u, at_u, s_u / n_u) - prior * back(row_p, at_p, s_p / n_p)
    positive = prior * back(row_p, at_p, (s_p - 1) / n_p)
    return prior * np.logaddexp(0, -z_p).mean(), negative, positive, clean


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = 400, rate: float = 0.1, decay: float = 3e-4) -> Linear:
    """Minimise the non-negative risk. Without toxic or unlabelled texts the score is the prior's."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    constant = float(np.log(prior / (1 - prior)))
    if not toxic or not unlabelled:
        return Linear(np.zeros(0, np.int64), np.zeros(0), constant)
    n_p, n_u = len(toxic), len(unlabelled)
    ids_p, in_p = np.unique(np.concatenate(toxic), return_counts=True)
    ids_u, in_u = np.unique(np.concatenate(unlabelled), return_counts=True)
    of_u = np.zeros(len(ids_p))
    at = np.minimum(np.searchsorted(ids_u, ids_p), max(len(ids_u) - 1, 0))
    if len(ids_u):
        of_u = np.where(ids_u[at] == ids_p, in_u[at], 0)
    # A feature of toxic texts only is 1 / prior times as common among them as in U; half that will do.
    lift = ((in_p + 0.5) / (n_p + 1)) / ((of_u + 0.5) / (n_u + 1))
    use = np.flatnonzero((in_p >= max(3, n_p // 500)) & (lift > 0.5 / prior))
    known = np.sort(ids_p[use])

    def places(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        flat = np.concatenate(rows)
        at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
        hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        return row[hit], at[hit]

    (row_p, at_p), (row_u, at_u) = places(toxic), places(unlabelled)
    parameters = np.zeros(len(known) + 1)
    parameters[-1] = constant
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)

    for step in range(1, steps + 1):
        w = parameters[:-1]
        _, negative, positive, clean = risks(parameters, (row_p, at_p, n_p), (row_u, at_u, n_u), prior)
        gradient = positive + clean if negative >= 0 else -clean
        gradient[:-1] += decay * w
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        parameters -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Linear(known, parameters[:-1], float(parameters[-1]))


def learn(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS,
) -> Linear:
    """A classifier from rows that are not held out. The prior is the share of 1 among their labels.

    An id counts once as toxic and once as unlabelled, however many rows have it: with the text
    of least hash.
    """
    text_batches(docs.sparkSession)
    seen = labels.where(~held_out(key) & F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isin(0, 1)).select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")
    )
    prior = seen.agg(F.avg("label")).first()[0]
    order = [F.xxhash64("key"), F.col("key")]
    toxic = seen.where("label = 1").select("key", F.lit(1).alias("toxic")).distinct().orderBy(*order).limit(toxic_rows)
    ids = docs.where(~held_out(key) & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"))
    free = ids.select("key", F.lit(0).alias("toxic")).distinct().orderBy(*order).limit(unlabelled_rows)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = one_text(rows.join(F.broadcast(toxic.unionAll(free)), "key"), "key", "toxic").select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_of, feature = document_features(batch.column(1))
            cuts = np.searchsorted(text_of, np.arange(batch.num_rows + 1))
            packed = [feature[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["toxic", "features"])

    found = rows.mapInArrow(run, "toxic int, features binary").toArrow()
    kinds = found["toxic"].to_numpy()
    # Sorted, so that sums do not depend on the order of tasks.
    packed = sorted(zip(kinds, found["features"].to_pylist()))
    of = lambda kind: [np.frombuffer(f, "<u4").astype(np.int64) for k, f in packed if k == kind]
    return fit(of(1), of(0), 0.0 if prior is None else prior)


def scores(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = 0.5, toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Empty and NULL texts get the score of a text without features. Rows may repeat; an empty
    table gives no rows; without toxic labels every score is near 0. Other columns are not read.
    """
    model = learn(docs, labels, key=key, text=text, label=label, toxic_rows=toxic_rows, unlabelled_rows=unlabelled_rows)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = StructType([rows.schema["key"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))], names=["key", "score"])

    return rows.mapInArrow(run, schema).select(
        F.col("key").alias(key), held_out("key").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
