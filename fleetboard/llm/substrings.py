"""Removing repeated passages: seeds on winnowed anchors, extended both ways.

A passage repeats if a window of ``window`` words also starts in a document of smaller id.

1. *Seeds.* Of each window the least of its k-gram hashes (the rightmost of equals) is the
   anchor; equal windows choose the same one, at the same place. Windows that follow each other
   and share an anchor are one seed, extended left and right as far as those windows reach.
2. *Join.* Anchors that only one document has are dropped by a pre-aggregated count; the others
   are joined back to their seeds. Where all extended seeds of an anchor are equal, all but
   those of the smallest document repeat.
3. *Extend.* Where they are not, one seed stands for its equals (the smallest document's) and is
   extended window by window; a window repeats if a smaller document has it under this anchor.
   All seeds then take what their representative found, or repeat as a whole behind it.
4. *Maximal repeats.* The repeating windows of a document are joined into its longest spans.

No step lists pairs of documents: thousands of copies of a passage cost as many rows as there
are copies. Hashes are of 64 bits, and two independent ones must agree (anchor and extension).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fleetboard.llm.common import cut, text_batches
from fleetboard.llm.words import MULTIPLIER, NOT_SPACE, Words, grams, mix, runs_of

#: Words of a k-gram.
GRAM = 10
#: Windows of a seed at most: bits of a mask.
BITS = 60
#: Stands for a NULL id, which no document is smaller for.
LAST = (1 << 63) - 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def word_hashes(words: Words) -> np.ndarray:
    values = words.values.to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))[words.codes] if words.n else np.zeros(0, np.uint64)


def _least_at(hashes: np.ndarray, w: int) -> np.ndarray:
    """Index of the least of each ``w`` consecutive hashes, the rightmost of equals."""
    now, size = np.arange(len(hashes)), 1

    def pick(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] <= hashes[a], b, a)

    while size * 2 <= w:
        now = pick(now[:-size], now[size:])
        size *= 2
    n = len(hashes) - w + 1
    return pick(now[:n], now[w - size : w - size + n])


def seeds(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, extension hash, first window and number of windows of each seed."""
    if words.n < window:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    own = word_hashes(words)
    k = min(GRAM, window)
    gram = grams(own, k)
    anchor = _least_at(gram, window - k + 1)
    start = np.arange(len(anchor))
    good = np.flatnonzero(start + window <= words.ends()[: len(anchor)])
    anchor = anchor[good]
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]]) if len(good) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    first, n = good[at], np.diff(np.concatenate([at, [len(good)]]))
    anchor = anchor[at]
    if len(n) and n.max() > BITS:
        # So many windows as a mask has bits; what is left is a seed of the same anchor.
        parts = -(-n // BITS)
        nth = runs_of(np.zeros(len(n), np.int64), parts)
        first, anchor = np.repeat(first, parts) + nth * BITS, np.repeat(anchor, parts)
        n = np.minimum(np.repeat(n, parts) - nth * BITS, BITS)
    # The hash of words [a, b) from sums of powers, whatever their place.
    one = np.ones(1, np.uint64)
    powers = np.cumprod(np.concatenate([one, np.full(words.n, MULTIPLIER, np.uint64)]))
    inverse = np.cumprod(np.concatenate([one, np.full(words.n, INVERSE, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own + np.uint64(1)) * powers[:-1])])
    span = (sums[first + n + window - 1] - sums[first]) * inverse[first]
    shape = ((n << 40) + (anchor - first)).astype(np.uint64)
    text = np.searchsorted(words.first, first, "right") - 1
    return text, gram[anchor], mix(span + mix(shape + np.uint64(7))), first - words.first[text], n


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id (NULL last), tag (tells rows that share an id apart), text."""
    return docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("id"), F.hash(F.col(f"`{text}`")).alias("tag"),
        F.col(f"`{text}`").alias("text"),
    )


def _find_seeds(rows: DataFrame, window: int) -> DataFrame:
    """A row per seed: h (anchor), e (extension), id, tag, start, n (windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, h, e, start, n = seeds(Words(batch.column(2), NOT_SPACE), window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)), pa.array(e.view(np.int64)), batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                ],
                names=["h", "e", "id", "tag", "start", "n"],
            )

    return rows.mapInArrow(run, "h long, e long, id long, tag int, start int, n int")


def _windows(rows: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """Windows of chosen seeds: h, e, id, nth, hash."""
    lists = chosen.groupBy("id", "tag").agg(F.collect_list(F.struct("h", "e", "start", "n")).alias("seeds"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0), NOT_SPACE)
            own = grams(word_hashes(words), window, 0xD6E8FEB86659FD93)
            lists = batch.column(2)
            flat = lists.flatten()
            text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            h, e, start, n = (flat.field(i).to_numpy() for i in range(4))
            begin = words.first[text] + start
            at = runs_of(begin, begin + n)
            nth = at - np.repeat(begin, n)
            ids = batch.column(1).take(pa.array(np.repeat(text, n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(h, n)), pa.array(np.repeat(e, n)), ids, pa.array(nth.astype(np.int32)), pa.array(own[at].view(np.int64))],
                names=["h", "e", "id", "nth", "hash"],
            )

    return rows.join(lists, ["id", "tag"]).select("text", "id", "seeds").mapInArrow(run, "h long, e long, id long, nth int, hash long")


def repeats(rows: DataFrame, window: int) -> DataFrame:
    """Of rows (id, tag, text): id, tag and the list of repeating windows as (start, mask).

    Bit ``i`` of a mask says that the window at ``start + i`` repeats.
    """
    found = _find_seeds(rows, window)
    of_anchor = found.groupBy("h").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.min("e").alias("e0"), F.max("e").alias("e1")
    )
    # Tables of their own, so that the joins deal out both sides anew and a hot key can be split.
    shared = cut(of_anchor.where("first < last").select("h", "first", (F.col("e0") != F.col("e1")).alias("differ")), "shared")
    met = cut(found.join(shared, "h"), "seeds")
    whole = F.expr("shiftleft(1L, n) - 1")
    plain = met.where(~F.col("differ") & (F.col("id") > F.col("first"))).select("id", "tag", "start", whole.alias("mask"))

    mixed = met.where("differ").select("h", "e", "id", "tag", "start", "n")
    spans = cut(mixed.groupBy("h", "e").agg(F.min(F.struct("id", "tag", "start", "n")).alias("s")).select("h", "e", "s.*"), "spans")
    windows = cut(_windows(rows, spans, window), "windows")
    earliest = cut(windows.groupBy("h", "hash").agg(F.min("id").alias("first")), "earliest")
    masks = (
        windows.join(earliest, ["h", "hash"]).where("first < id").groupBy("h", "e")
        .agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("found"))
    )
    known = cut(spans.select("h", "e", F.col("id").alias("own")).join(masks, ["h", "e"], "left"), "masks")
    extended = mixed.join(known, ["h", "e"]).select(
        "id", "tag", "start",
        F.when(F.col("id") > F.col("own"), whole).otherwise(F.coalesce("found", F.lit(0).cast("long"))).alias("mask"),
    ).where("mask <> 0")
    return plain.unionAll(extended).groupBy("id", "tag").agg(F.collect_list(F.struct("start", "mask")).alias("found"))


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 50, digest_only: bool = False
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, spans (start and end of removed words), kept.

    Words are what lies between ASCII white space; kept words are joined by one space. NULL and
    empty texts have no words. Only documents of a smaller id count: rows that share an id do
    not repeat each other, and a NULL id is greater than any other. Windows are judged on the
    input. With ``digest_only`` the SHA-256 of the kept text,
    ``kept_sha256``, stands in its place. Other columns are not read.
    """
    if window < 1:
        raise ValueError("window must be a word or more")
    text_batches(docs.sparkSession)
    rows = _rows(docs, key, text)
    found = cut(repeats(rows, window), "repeats")
    kind = docs.schema[key].dataType
    last = "kept_sha256" if digest_only else "kept"
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([
        StructField(key, kind), StructField("n_words", LongType()), StructField("n_removed", LongType()),
        StructField("spans", ArrayType(span)), StructField(last, StringType()),
    ])
    joined = rows.join(found, ["id", "tag"], "left").select(
        F.when(F.col("id") != LAST, F.col("id")).cast(kind).alias("id"), "text", "found"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            words = Words(batch.column(1), NOT_SPACE)
            lists = batch.column(2)
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            start, mask = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            change = np.zeros(words.n + 1, np.int64)
            for i in range(min(window, BITS)):
                at = (words.first[row] + start)[(mask >> i) & 1 == 1] + i
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
            gone = np.cumsum(change[:-1]) > 0
            before = np.concatenate([[0], np.cumsum(gone)])
            n_removed = before[words.first[1:]] - before[words.first[:-1]]
            values = words.values.to_pylist()
            spans, kept = [], []
            for a, b, n in zip(words.first[:-1], words.first[1:], n_removed):
                own = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))) if n else np.zeros(0, np.int64)
                spans.append([{"start": s, "end": t} for s, t in zip(edge[::2].tolist(), edge[1::2].tolist())])
                body = b" ".join([values[c] for c in (words.codes[a:b][~own] if n else words.codes[a:b])])
                kept.append(hashlib.sha256(body).hexdigest() if digest_only else body.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(words.counts.astype(np.int64)), pa.array(n_removed.astype(np.int64)),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string()),
                ],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema)
