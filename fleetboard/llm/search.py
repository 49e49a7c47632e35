"""Ranked lexical search, term at a time with limited accumulators.

The queries are the stated set and are taken in blocks of about ``BLOCK_TERMS`` (query, term)
pairs. For each block one pass over the texts writes an index: a row per document with its length
and how often it has each of the block's terms. Counts over all documents (how many there are,
their terms, the documents of each term) come from that index, and a second pass ranks it.

A task turns up to ``SHARD_DOCS`` documents at once into postings and ranks every query on them:
terms are taken rarest first, each adding its weight to the accumulators of its documents. Before
each term the greatest scores that the remaining terms can still give are added up. Once a
document met only from here on could not reach the k-th best partial score any more, no new
accumulators are made, and the remaining terms go only to those that exist, which end exact. The
k-th best score of a task's earlier documents is a floor for its later ones, too. Equal scores are
never cut off, as the smaller id decides between them.

A task gives at most ``k`` documents a query and shard, which are then ranked in two rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fleetboard.llm.common import cut, forget, text_batches
from fleetboard.llm.words import ALPHANUMERIC, Words

#: Pairs of a query and one of its terms that the driver and each task hold at once.
BLOCK_TERMS = 200_000
#: Documents and postings that a task ranks at once.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 21
#: The best of a query are ranked in so many parts before they meet.
PARTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters, digits and all that is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: str) -> Column:
    """The terms of a text, A-Z in lower case; NULL has none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def weight(documents: int, having: int) -> int:
    """What a term weighs that ``having`` of all ``documents`` have: more the rarer it is, never below 0."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def index(docs: DataFrame, vocabulary: pa.Array, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with a term: its id, n (terms, with repeats), and of the ``vocabulary``
    (binary) the numbers of the terms it has, with their occurrences."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string("n long, terms array<int>, times array<int>")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch["text"], ALPHANUMERIC, lower=True)
            known = pc.fill_null(pc.index_in(words.values, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = known[words.codes] if words.n else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(batch)), words.counts)[term >= 0]
            pairs, times = np.unique(doc * max(1, len(vocabulary)) + term[term >= 0], return_counts=True)
            first = np.searchsorted(pairs, np.arange(len(batch) + 1) * max(1, len(vocabulary))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(first, v.astype(np.int32)) for v in (pairs % max(1, len(vocabulary)), times)]
            out = pa.record_batch([batch["id"], pa.array(words.counts.astype(np.int64)), *lists], ["id", "n", "terms", "times"])
            yield out.filter(pa.array(words.counts > 0))

    return rows.mapInArrow(count, schema)


class Shard:
    """Postings of some documents: per term of the vocabulary its documents and what it gives them."""

    def __init__(self, rows: pa.Table, documents: int, length: int):
        self.ids = rows["id"].combine_chunks()
        # The order of ids decides between equal scores; NULL comes last.
        self.order = pc.rank(self.ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        n = rows["n"].to_numpy()
        norm = 50 + 50 * n * documents // length
        sizes = pc.list_value_length(rows["terms"]).to_numpy()
        term, times = (pc.list_flatten(rows[c]).to_numpy().astype(np.int64) for c in ("terms", "times"))
        doc = np.repeat(np.arange(len(n)), sizes)
        by_term = np.argsort(term, kind="stable")
        self.doc, times = doc[by_term], times[by_term]
        self.gain = 1_000_000_000 * times // (1000 * times + 20 * norm[self.doc])
        self.terms, self.first = np.unique(term[by_term], return_index=True)
        self.last = np.append(self.first[1:], len(term))
        self.most = np.maximum.reduceat(self.gain, self.first) if len(self.first) else self.gain
        self.at = {int(t): i for i, t in enumerate(self.terms)}

    def best(self, terms: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents above 0 that may be among the ``k`` best.

        ``terms``: (number, weight), rarest first. ``floor``: what the k-th of other documents has.
        """
        here = [(self.at[t], w) for t, w in terms if t in self.at and w > 0]
        bounds = np.array([w * int(self.most[i]) for i, w in here], np.int64)
        remaining = bounds[::-1].cumsum()[::-1]
        if not here or remaining[0] < floor:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores, alive, given = np.zeros(len(self.ids), np.int64), None, 0
        for (i, w), left, bound in zip(here, remaining, bounds):
            if alive is None and (left < floor or left < given):
                alive = self._limited(scores, k, max(floor, int(left) + 1), int(left) < floor)
            places = self.doc[self.first[i] : self.last[i]]
            gain = self.gain[self.first[i] : self.last[i]]
            if alive is not None:
                if len(alive) * 16 < len(places):
                    found = np.minimum(np.searchsorted(places, alive), len(places) - 1)
                    found = found[places[found] == alive]
                else:
                    found = np.flatnonzero(scores[places] > 0)
                places, gain = places[found], gain[found]
            scores[places] += w * gain
            given += bound
        places = np.flatnonzero(scores > 0)
        if len(places) > k:
            kth = np.partition(scores[places], len(places) - k)[len(places) - k]
            places = places[scores[places] >= kth]
        places = places[np.lexsort((self.order[places], -scores[places]))][:k]
        return places, scores[places]

    @staticmethod
    def _limited(scores: np.ndarray, k: int, needed: int, known: bool) -> np.ndarray | None:
        """The accumulators made so far, if no document beside them can be among the best: the k-th
        partial score is ``needed`` or more, or that is ``known``. Else None."""
        alive = np.flatnonzero(scores > 0)
        if known or len(alive) >= k and np.partition(scores[alive], len(alive) - k)[len(alive) - k] >= needed:
            return alive
        return None


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, postings = [], 0, 0
    for batch in batches:
        held.append(batch)
        docs, postings = docs + len(batch), postings + len(batch["terms"].flatten())
        if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
            yield pa.Table.from_batches(held)
            held, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, pairs: list, item_type: pa.DataType, k: int, schema: T.StructType) -> DataFrame:
    """The best of each shard for the queries of ``pairs``."""
    names = sorted({r.term for r in pairs})
    number = {t: i for i, t in enumerate(names)}
    found = cut(index(docs, pa.array([t.encode() for t in names], pa.large_binary())), "index")
    documents, length = found.agg(F.count("*"), F.sum("n")).first()
    having = {r.term: r.n for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    weights = {t: weight(documents, n) for t, n in having.items()}
    queries: dict = {}
    for r in pairs:
        queries.setdefault(r.item, []).append(number[r.term])
    items = pa.array(list(queries), item_type)
    # Rarest first.
    wanted = [sorted(((t, weights[t]) for t in terms if t in weights), key=lambda x: (-x[1], x[0])) for terms in queries.values()]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * len(wanted)
        for rows in _shards(batches):
            shard = Shard(rows, documents, length)
            of, at, score = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, terms in enumerate(wanted):
                floor = int(kept[i].min()) if len(kept[i]) == k else 0
                places, scores = shard.best(terms, k, floor)
                kept[i] = np.sort(np.concatenate([kept[i], scores]))[-k:]
                of.append(len(places))
                at.append(places)
                score.append(scores)
            of = np.repeat(np.arange(len(wanted)), of)
            yield pa.record_batch([items.take(pa.array(of)), shard.ids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(score))], ["item", "id", "score"])

    best = cut(found.mapInArrow(rank, schema), "best")
    forget(found)
    return best


def search(
    docs: DataFrame, queries: DataFrame, *, k: int = 50, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per query its ``k`` best documents with a score above 0: item, rank (from 1), id, score.

    Ids of both kinds have any type that can be ordered. Equal scores go by ascending id, NULL
    last; rows of one id are documents each. Query rows of one id are one query, which has the terms of
    all, and NULL is an id like any other. A query without terms, or none that a document has,
    gives no rows. Lengths times documents must stay within 64 bits.
    """
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField("item", queries.schema[item].dataType), T.StructField("id", docs.schema[key].dataType), T.StructField("score", T.LongType()),
    ])
    pairs = queries.select(F.col(f"`{item}`").alias("item"), F.explode(F.array_distinct(terms_of(item_text))).alias("term")).distinct()
    pairs = cut(pairs, "queries")
    blocks = max(1, -(-pairs.count() // block_terms))
    item_type = to_arrow_type(schema["item"].dataType)
    best = None
    for b in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item", "term").collect()
        if not mine:
            continue
        rows = _block(docs, mine, item_type, k, schema)
        best = rows if best is None else best.unionAll(rows)
    if best is None:
        best = spark.createDataFrame([], schema)
    parted = best.withColumn("part", F.pmod(F.xxhash64("id", "score"), F.lit(PARTS)))
    return _ranked(_ranked(parted, ["item", "part"], k).drop("rank", "part"), ["item"], k).select("item", "rank", "id", "score")
