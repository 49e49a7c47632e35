"""Benchmark decontamination by winnowing.

For a window of ``t`` words, texts are cut into k-grams, and of each ``t - k + 1`` consecutive
k-gram hashes the least is kept (all positions that have it). Texts that share ``t`` words in a
row therefore share a kept hash inside them. Kept hashes of documents are joined with those of
the benchmark, and each hit is extended word by word in both directions; it counts where the
shared span reaches ``t`` words. Items of fewer than ``t`` words are one window of their own
length, found the same way with that length as ``t``.

The benchmark is the stated query set: it is dealt into blocks of at most about ``BLOCK_WORDS``
words, each a file in the shared folder, and each task holds its documents against every block,
one at a time: with several blocks it gathers so many documents first that a block is read a few
times a task, not once a batch. So nothing is shuffled or broadcast but the blocks' paths, whatever the number
of documents that share a passage. Words are compared themselves, not their hashes: documents'
words become numbers of the block's vocabulary.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fleetboard.llm.common import attempt_name, create_file, cut, open_stream, shared_path, text_batches
from fleetboard.llm.words import ALPHANUMERIC, Words, grams, mix, runs_of, sliding

#: Words of the benchmark that a task holds at once.
BLOCK_WORDS = 1_000_000
#: Bytes of texts that a task gathers before it goes through several blocks.
GATHERED = 64 << 20
#: Length of the k-grams, where the window is no shorter.
GRAM = 5


def _kept(ids: np.ndarray, ends: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and hashes kept by winnowing windows of ``t`` words inside texts; k."""
    k = min(GRAM, t)
    w = t - k + 1
    hashes = grams(mix(ids.astype(np.uint64) + np.uint64(1)), k)
    if len(ids) < t:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), k
    # A window that leaves its text, or holds a word of number -1, keeps nothing.
    start = np.arange(len(ids) - t + 1)
    known = np.concatenate([[0], np.cumsum(ids < 0)])
    good = (start + t <= ends[: len(start)]) & (known[t:] == known[:-t])
    least = np.where(good, sliding(hashes, w), np.uint64(0))
    # A hash is kept if it is the least of some window that holds it.
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    kept = np.flatnonzero((sliding(padded, w, least=False) == hashes) & (hashes > 0))
    return kept, hashes[kept], k


class Block:
    """Items of the benchmark, ready to be searched for."""

    def __init__(self, item_ids: list[str], texts: pa.Array, window: int):
        words = Words(texts, ALPHANUMERIC, lower=True)
        self.item_ids, self.vocabulary = item_ids, words.values
        self.ids, self.first, self.ends = words.codes.astype(np.int64), words.first, words.ends()
        self.item = np.repeat(np.arange(len(item_ids)), words.counts)
        self.by_window = {}
        lengths = np.minimum(words.counts, window)
        for t in np.unique(lengths[lengths > 0]):
            mine = np.repeat(lengths == t, words.counts)
            # Others' words are taken for unknown, so that they keep nothing.
            at, hashes, k = _kept(np.where(mine, self.ids, -1), self.ends, int(t))
            order = np.argsort(hashes, kind="stable")
            self.by_window[int(t)] = (hashes[order], at[order], k)

    def numbers(self, words: Words) -> np.ndarray:
        """The words by number in this block's vocabulary, -1 where it has none."""
        known = pc.fill_null(pc.index_in(words.values, value_set=self.vocabulary), -1)
        known = known.to_numpy(zero_copy_only=False).astype(np.int64)
        return known[words.codes] if words.n else np.zeros(0, np.int64)

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Marks of the words inside an occurrence; pairs (text, item) with one, as an array."""
        hit = np.zeros(words.n + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        ids, ends = self.numbers(words), words.ends()
        starts = np.repeat(words.first[:-1], words.counts)
        text = np.repeat(np.arange(len(words.first) - 1), words.counts)
        for t, (hashes, places, k) in self.by_window.items():
            at, found, _ = _kept(ids, ends, t)
            lo, hi = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            use = hi > lo
            at, lo, hi = at[use], lo[use], hi[use]
            # So many positions at once that their candidates stay few.
            cuts = np.searchsorted(np.cumsum(hi - lo), np.arange(0, int((hi - lo).sum()), 1 << 18))
            for a, b in zip(cuts, [*cuts[1:], len(at)]):
                p = np.repeat(at[a:b], (hi - lo)[a:b])
                q = places[runs_of(lo[a:b], hi[a:b])]
                same = np.ones(len(p), bool)
                for j in range(k):
                    same &= ids[p + j] == self.ids[q + j]
                p, q = p[same], q[same]
                left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
                for j in range(1, t - k + 1):
                    i, m = p - j, q - j
                    ok = (left == j - 1) & (i >= starts[p]) & (m >= self.first[self.item[q]])
                    left += ok & (ids[np.maximum(i, 0)] == self.ids[np.maximum(m, 0)])
                    i, m = p + k - 1 + j, q + k - 1 + j
                    ok = (right == j - 1) & (i < ends[p]) & (m < self.ends[q])
                    right += ok & (ids[np.minimum(i, len(ids) - 1)] == self.ids[np.minimum(m, len(self.ids) - 1)])
                long = left + right + k >= t
                p, q, left, right = p[long], q[long], left[long], right[long]
                np.add.at(hit, p - left, 1)
                np.add.at(hit, p + k + right, -1)
                pairs.append(np.unique(np.column_stack([text[p], self.item[q]]), axis=0))
        return np.cumsum(hit[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def write_blocks(benchmark: DataFrame, *, key: str, text: str, window: int, block_words: int) -> list[str]:
    """Write the benchmark's blocks; their paths."""
    spark = benchmark.sparkSession
    folder = shared_path(spark, "benchmark")
    rows = benchmark.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")).alias("item"), F.col(f"`{text}`").alias("text")
    ).where("text IS NOT NULL")
    # A word and its separator are two characters at least.
    total = rows.agg(F.sum(F.ceil(F.length("text") / 2))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int"))

    def build(items: pa.Table) -> pa.Table:
        items = items.sort_by([("item", "ascending"), ("text", "ascending")]).combine_chunks()
        path = f"{folder}/{attempt_name('block')}"
        with create_file(path) as file:
            file.write(pickle.dumps(Block(items["item"].to_pylist(), items["text"].chunk(0), window)))
        return pa.table({"path": [path]})

    return sorted(r.path for r in cut(rows.groupBy("block").applyInArrow(build, "path string"), "blocks").collect())


_loaded: dict[str, Block] = {}


def _load(path: str) -> Block:
    """A block; each Python worker keeps the last one."""
    if path not in _loaded:
        _loaded.clear()
        with open_stream(path) as file:
            _loaded[path] = pickle.loads(file.read())
    return _loaded[path]


def _gathered(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[list[pa.RecordBatch]]:
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.column(at).nbytes
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def search_blocks(
    batches: Iterator[pa.RecordBatch], at: int, paths: list[str], load: Callable[[str], Block] = _load, gathered: int = GATHERED
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[list[str]]]]:
    """Per batch its texts' numbers of words, of hit words, and sorted items; ``at`` is the texts' column."""
    for held in _gathered(batches, at, gathered if len(paths) > 1 else 0):
        words = [Words(batch.column(at), ALPHANUMERIC, lower=True) for batch in held]
        hits = [np.zeros(w.n, bool) for w in words]
        items: list[list[set]] = [[set() for _ in range(batch.num_rows)] for batch in held]
        for path in paths:
            block = load(path)
            for w, hit, found in zip(words, hits, items):
                marks, pairs = block.search(w)
                hit |= marks
                for row, item in pairs:
                    found[row].add(block.item_ids[item])
        for batch, w, hit, found in zip(held, words, hits, items):
            before = np.concatenate([[0], np.cumsum(hit)])
            yield batch, w.counts, before[w.first[1:]] - before[w.first[:-1]], [sorted(i) for i in found]


def find_hits(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = 10, block_words: int = BLOCK_WORDS, drop_text: bool = False,
) -> DataFrame:
    """``docs`` with columns ``n_words``, ``n_hit`` (long) and ``items`` (sorted strings).

    A word is hit if it lies inside an occurrence of a benchmark window. NULL and empty texts
    have no words; empty items have no window; a NULL item id reads "null". Rows may repeat.
    Columns of ``docs`` that have the new names are replaced. ``drop_text`` leaves the text out.
    """
    text_batches(docs.sparkSession)
    paths = write_blocks(benchmark, key=item_key, text=item_text, window=window, block_words=block_words)
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("n_words", "n_hit", "items")])
    at = rows.columns.index(text)
    fields = [f for i, f in enumerate(rows.schema.fields) if not (drop_text and i == at)]
    schema = StructType([
        *fields, StructField("n_words", LongType()), StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, n_hit, items in search_blocks(batches, at, paths):
            columns = [c for i, c in enumerate(batch.columns) if not (drop_text and i == at)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts.astype(np.int64)), pa.array(n_hit), pa.array(items, pa.list_(pa.string()))],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a hit word; all columns kept, whatever their names."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    text = plain[docs.columns.index(options.pop("text", "text"))]
    kept = find_hits(docs.toDF(*plain), benchmark, text=text, **options).where("n_hit = 0")
    return kept.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns)])
