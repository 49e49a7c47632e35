"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are counts that do not depend on its language: shares of kinds of
characters, lengths of words and lines, and how much words, word triples and lines repeat. They
are computed for a whole Arrow batch with numpy. The trees are grown on the driver from a
bounded sample of labelled rows (``TRAIN_ROWS``, a few megabytes of statistics), by histograms
of the statistics' quantile bins, and flattened into arrays: node ``i`` of a complete tree has
its children at ``2 i + 1`` and ``2 i + 2``, so all rows walk down one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fleetboard.llm.common import one_text, text_batches
from fleetboard.llm.words import NOT_SPACE, Words, grams, mix

#: Labelled ids to learn from at most, those with the least hash of their id.
TRAIN_ROWS = 20_000
#: Parts of the labelled rows, one of which is held out.
FOLDS = 5

_B = np.arange(256)
_KINDS = {
    "upper": (_B >= 65) & (_B <= 90),
    "lower": (_B >= 97) & (_B <= 122),
    "digit": (_B >= 48) & (_B <= 57),
    "space": _B == 32,
    "newline": _B == 10,
    "other": _B >= 128,
    "stop": (_B == ord(".")) | (_B == ord(",")),
    "mark": (_B == ord("!")) | (_B == ord("?")),
    "bar": _B == ord("|"),
    "angle": np.isin(_B, [ord(c) for c in "<>{}[]()=/\\"]),
    "sign": np.isin(_B, [ord(c) for c in "#$%&*+@^_~"]),
}
NAMES = [
    "log_bytes", *_KINDS, "word_mean", "word_spread", "word_longest", "one_letter", "distinct", "same_next",
    "top_share", "triples_distinct", "ends_stop", "line_mean", "lines_distinct", "line_words", "log_words",
]


def _distinct(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group the number of distinct values and the count of the commonest."""
    if not len(group):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (v[1:] != v[:-1])])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, g[at], np.diff(np.concatenate([at, [len(g)]])))
    return np.bincount(g[at], minlength=n).astype(float), most


_NOT_NEWLINE = _B != 10


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text; NULL as empty. Shares are of 1 at least, never divided by 0."""
    plain = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    n = len(plain)
    out = np.zeros((n, len(NAMES)))
    if not n:
        return out
    at = {name: i for i, name in enumerate(NAMES)}
    offsets = np.frombuffer(plain.buffers()[1], np.int64, n + 1, plain.offset * 8)
    body = plain.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and len(body) else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    size = np.diff(bounds)
    total = np.maximum(size, 1)
    out[:, at["log_bytes"]] = np.log1p(size)
    for i in range(n):
        counts = np.bincount(data[bounds[i] : bounds[i + 1]], minlength=256)
        for name, kind in _KINDS.items():
            out[i, at[name]] = counts[kind].sum() / total[i]

    words = Words(texts, NOT_SPACE)
    group = np.repeat(np.arange(n), words.counts)
    many = np.maximum(words.counts, 1)
    values = words.values
    length = np.diff(np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8))[words.codes] if words.n else np.zeros(0)
    mean = np.bincount(group, length, n) / many
    out[:, at["word_mean"]] = mean
    out[:, at["word_spread"]] = np.sqrt(np.maximum(np.bincount(group, length**2.0, n) / many - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, group, length)
    out[:, at["word_longest"]] = np.log1p(longest)
    out[:, at["one_letter"]] = np.bincount(group, length <= 2, n) / many
    distinct, most = _distinct(group, words.codes, n)
    out[:, at["distinct"]] = distinct / many
    out[:, at["top_share"]] = most / many
    out[:, at["log_words"]] = np.log1p(words.counts)
    same = (words.codes[1:] == words.codes[:-1]) & (group[1:] == group[:-1])
    out[:, at["same_next"]] = np.bincount(group[1:], same, n) / many
    triples = grams(mix(words.codes.astype(np.uint64) + np.uint64(1)), 3)
    inside = group[2:] == group[:-2] if words.n > 2 else np.zeros(0, bool)
    own = group[: len(triples)][inside]
    found, _ = _distinct(own, triples[inside], n)
    out[:, at["triples_distinct"]] = found / np.maximum(np.bincount(own, minlength=n), 1)
    last = np.array([v[-1] if v else 0 for v in values.to_pylist()], np.int64)[words.codes] if words.n else np.zeros(0, np.int64)
    out[:, at["ends_stop"]] = np.bincount(group, np.isin(last, [ord("."), ord(",")]), n) / many

    lines = Words(texts, _NOT_NEWLINE)
    group = np.repeat(np.arange(n), lines.counts)
    many_lines = np.maximum(lines.counts, 1)
    out[:, at["line_mean"]] = np.log1p(size / many_lines)
    out[:, at["lines_distinct"]] = _distinct(group, lines.codes, n)[0] / many_lines
    out[:, at["line_words"]] = np.log1p(words.counts / many_lines)
    return out


class Trees:
    """Boosted trees as arrays: (tree, node) of statistic, threshold, and leaf values."""

    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        self.column, self.limit, self.value = [], [], []

    @classmethod
    def grow(
        cls, x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, rate: float = 0.1,
        bins: int = 64, least_weight: float = 2.0, smooth: float = 1.0,
    ) -> Trees:
        """Boost on the logistic loss. Without rows of both labels all scores are the base rate."""
        rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
        made = cls(depth, float(np.log(rate_of_ones / (1 - rate_of_ones))))
        if not len(y) or y.min() == y.max():
            return made.flat()
        limits = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, bins + 1)[1:-1])) for c in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(own, x[:, c], "left") for c, own in enumerate(limits)])
        margin = np.full(len(y), made.base)
        inner, nodes = (1 << depth) - 1, (1 << (depth + 1)) - 1
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = p - y, np.maximum(p * (1 - p), 1e-9)
            column, limit = np.zeros(inner, np.int32), np.full(inner, np.inf)
            node = np.zeros(len(y), np.int64)
            for level in range(depth):
                first, wide = (1 << level) - 1, 1 << level
                best = np.full(wide, 1e-9)
                cut_bin = np.zeros(wide, np.int64)
                own = node - first
                for c in range(x.shape[1]):
                    if not len(limits[c]):
                        continue
                    b = len(limits[c]) + 1
                    key = own * b + binned[:, c]
                    g = np.bincount(key, gradient, wide * b).reshape(wide, b).cumsum(axis=1)
                    h = np.bincount(key, weight, wide * b).reshape(wide, b).cumsum(axis=1)
                    gl, hl, g_all, h_all = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl**2 / (hl + smooth) + (g_all - gl) ** 2 / (h_all - hl + smooth) - g_all**2 / (h_all + smooth)
                    gain[(hl < least_weight) | (h_all - hl < least_weight)] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(wide), at]
                    better = top > best
                    best[better], cut_bin[better] = top[better], at[better]
                    column[first : first + wide][better] = c
                    limit[first : first + wide][better] = limits[c][at[better]]
                # A node that no cut improves sends all rows left (its limit is infinite).
                node = 2 * node + 1 + (x[np.arange(len(y)), column[node]] > limit[node])
            leaf = node - inner
            g = np.bincount(leaf, gradient, nodes - inner)
            h = np.bincount(leaf, weight, nodes - inner)
            value = -rate * g / (h + smooth)
            margin += value[leaf]
            made.column.append(column)
            made.limit.append(limit)
            made.value.append(value)
        return made.flat()

    def flat(self) -> Trees:
        if isinstance(self.column, list):
            inner = (1 << self.depth) - 1
            self.column = np.array(self.column, np.int32).reshape(-1, inner)
            self.limit = np.array(self.limit, float).reshape(-1, inner)
            self.value = np.array(self.value, float).reshape(-1, inner + 1)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        rows = np.arange(len(x))
        margin = np.full(len(x), self.base)
        for column, limit, value in zip(self.column, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, column[node]] > limit[node])
            margin += value[node - column.size]
        return 1 / (1 + np.exp(-margin))


def held_out(key: str) -> Column:
    """Whether the id falls to the held-out part; a NULL id does not."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by number, and those names by the given ones."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def learn(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Trees:
    """Trees from the labelled rows that are not held out; labels other than 0 and 1 are left out.

    At most ``train_rows`` labelled ids, which every task gets to pick their texts. An id counts
    once, however many rows have it: with its least label and the text of least hash.
    """
    text_batches(docs.sparkSession)
    sample = (
        labels.where(~held_out(key) & F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isin(0, 1))
        .groupBy(F.col(f"`{key}`").alias("key")).agg(F.min(F.col(f"`{label}`").cast("int")).alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(train_rows)
    )
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = one_text(rows.join(F.broadcast(sample), "key"), "key", "label").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[:, c]) for c in range(len(NAMES)))], names=["label", *NAMES]
            )

    schema = ", ".join(["label int", *(f"{c} double" for c in NAMES)])
    seen = rows.mapInArrow(run, schema).toPandas()
    # In an order of their own, so that sums do not depend on the order of tasks.
    seen = seen.sort_values(["label", *NAMES], kind="stable")
    return Trees.grow(seen[NAMES].to_numpy(float), seen["label"].to_numpy(float))


def with_score(docs: DataFrame, trees: Trees, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``score``; a column of that name is replaced."""
    text_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    rows = docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").alias("_scored_text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.score(statistics(batch.column(len(keep))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=schema.names)

    return rows.mapInArrow(run, schema)


def scores(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    threshold: float = 0.3, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Empty and NULL texts get the score of their (zero) statistics. Rows may repeat; an empty
    table gives no rows; without labels every score is 0.5. Other columns are not read.
    """
    trees = learn(docs, labels, key=key, text=text, label=label, train_rows=train_rows)
    scored = with_score(docs.select(f"`{key}`", f"`{text}`"), trees, text=text, keep=[key])
    return scored.select(
        f"`{key}`", held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    threshold: float = 0.3, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``; all columns, whatever their names."""
    trees = learn(docs, labels, key=key, text=text, label=label, train_rows=train_rows)
    plain, name = _plain(docs)
    kept = with_score(plain, trees, text=name[text]).where(F.col("score") >= threshold)
    return kept.select(*[F.col(p).alias(c) for c, p in name.items()])
