"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints are cut into halves of 32 bits. Fingerprints that differ in at most 3 bits differ
in at most one bit of some half (in general ``max_bits // 2 + 1`` blocks are cut). Inside a half
the anchors are the words of the perfect Hamming code on its first 31 bits: every bit string is
within the covering radius, 1, of exactly one anchor, its home. Each fingerprint is replicated
to all anchors within covering radius plus threshold, 2: its home and, unless it is an anchor
itself, 15 others. If two differ in one bit of the half, the second is within 2 of the first's
home, so that they meet there; each anchor compares its home members with all its members on all
64 bits. There are 2**26 anchors a half, so candidates stay few as the corpus grows.

Copies never meet: fingerprints are made distinct first. An anchor whose home members are many
is split by hash (``HOME_ROWS`` a piece), its other members going to every piece; a piece gives
a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetboard.llm.common import components, cut, in_arrow, text_batches

SEED = 42
BITS = 64
#: Home members of an anchor that one task compares at once.
HOME_ROWS = 2048


def fingerprint_of(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text: A-Z lower-cased, words between ASCII white space.

    A text of fewer words than a shingle is one shingle; one without words, or NULL, gives 0.
    """
    # On UTF-8 bytes, lower() changes A-Z only and split() cuts at 0x20 and 0x09-0x0D only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)))))
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 14):
        some = shingles[at : at + (1 << 14)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), "<u8", len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(set_bits * 2 > len(shingles), bitorder="little").view("<u8")[0])


def with_fingerprint(rows: DataFrame, *, text: str, shingle_words: int = 3) -> DataFrame:
    """``rows`` with ``_fp``, the fingerprint of column ``text`` as a signed long."""
    text_batches(rows.sparkSession)
    at = rows.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.fromiter((fingerprint_of(t, shingle_words) for t in batch.column(at).to_pylist()), np.uint64)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, "_fp"]
        )

    schema = StructType([*rows.schema.fields, StructField("_fp", LongType())])
    return in_arrow(rows, run, schema)


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, r) of each block: a Hamming code on 2**r - 1 bits from ``shift`` on."""
    n = max_bits // 2 + 1
    width = BITS // n
    r = (width + 1).bit_length() - 1
    if r < 2:
        raise ValueError(f"max_bits={max_bits} leaves blocks of {width} bits")
    return [(i * width, r) for i in range(n)]


def _anchors(fps: np.ndarray, shift: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Home anchor of each fingerprint, and all anchors within 2 of it as (row, anchor)."""
    n = (1 << r) - 1
    word = (fps >> np.uint64(shift)) & np.uint64((1 << n) - 1)
    syndrome = np.zeros(len(fps), dtype=np.int64)
    for i in range(n):
        syndrome ^= np.where((word >> np.uint64(i)) & np.uint64(1), i + 1, 0)
    flip = lambda s: np.where(s > 0, np.uint64(1) << (np.maximum(s, 1) - 1).astype(np.uint64), np.uint64(0))
    home = word ^ flip(syndrome)
    rows, found = [np.arange(len(fps))], [home]
    for i in range(1, n + 1):
        # Flipping bits i and j reaches an anchor where i ^ j is the syndrome.
        j = syndrome ^ i
        use = np.flatnonzero((syndrome > 0) & (j > i))
        rows.append(use)
        found.append(word[use] ^ np.uint64(1 << (i - 1)) ^ flip(j[use]))
    return home, np.column_stack([np.concatenate(rows).astype(np.uint64), np.concatenate(found)])


def _replicas(fps: DataFrame, max_bits: int) -> DataFrame:
    """A row for each fingerprint and anchor within covering radius plus threshold."""
    blocks = _blocks(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(all_fps), 20_000):
                own = all_fps[at : at + 20_000]
                for block, (shift, r) in enumerate(blocks):
                    home, near = _anchors(own, shift, r)
                    fp = own[near[:, 0].astype(np.int64)]
                    is_home = np.zeros(len(near), dtype=bool)
                    is_home[: len(home)] = True
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(near), block, dtype=np.int32)),
                            pa.array(near[:, 1].astype(np.int64)),
                            pa.array(is_home),
                            pa.array(fp.view(np.int64)),
                        ],
                        names=["block", "anchor", "home", "fp"],
                    )

    return fps.mapInArrow(run, "block int, anchor long, home boolean, fp long")


class _Piece:
    """The home members of a piece of an anchor, and a forest of the links found."""

    def __init__(self, key: tuple, homes: np.ndarray):
        self.key, self.homes = key, homes
        self.root = list(range(len(homes)))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def compare(self, members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
        edges = []
        for at in range(0, len(members), 1024):
            some = members[at : at + 1024]
            close = np.bitwise_count(some[:, None] ^ self.homes[None, :]) <= max_bits
            close &= some[:, None] != self.homes[None, :]
            for i in np.flatnonzero(close.any(axis=1)):
                own = np.flatnonzero(close[i])
                edges.append((some[i], self.homes[own[0]]))
                for j in own[1:]:
                    self.root[self.find(j)] = self.find(own[0])
        return edges

    def rest(self) -> list[tuple[int, int]]:
        """Homes that a common neighbour links."""
        return [(self.homes[i], self.homes[r]) for i in range(len(self.homes)) if (r := self.find(i)) != i]


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column fp, distinct) within ``max_bits``."""
    members = cut(_replicas(fps, max_bits), "replicas")
    # Anchors that are nobody's home compare nothing.
    sizes = (
        members.where("home").groupBy("block", "anchor").agg(F.count("*").alias("n"))
        .withColumn("pieces", F.ceil(F.col("n") / HOME_ROWS).cast("int"))
    )
    in_use = members.join(sizes, ["block", "anchor"])
    every: Column = F.sequence(F.lit(0), F.col("pieces") - 1)
    own: Column = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    homes = in_use.where("home").select("block", "anchor", own.alias("piece"), "home", "fp")
    nears = in_use.select("block", "anchor", F.explode(every).alias("piece"), F.lit(False).alias("home"), "fp")
    key = ["block", "anchor", "piece"]
    dealt = homes.unionAll(nears).repartition(*key).sortWithinPartitions(*key, F.desc("home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, waiting = None, None

        def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            block, anchor, part, home, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp = fp.view(np.uint64)
            edges = []
            # Cuts where the key, or home within it, changes.
            change = (np.diff(block) != 0) | (np.diff(anchor) != 0) | (np.diff(part) != 0) | (home[1:] != home[:-1])
            starts = [0, *(np.flatnonzero(change) + 1), len(fp)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                key = (block[a], anchor[a], part[a])
                if home[a]:
                    if waiting is not None and waiting[0] == key:
                        waiting = (key, np.concatenate([waiting[1], fp[a:b]]))
                    else:
                        waiting = (key, fp[a:b])
                    continue
                if piece is None or piece.key != key:
                    if piece is not None:
                        edges += piece.rest()
                    piece = _Piece(key, waiting[1] if waiting and waiting[0] == key else fp[:0])
                if len(piece.homes) and not (b - a == 1 and len(piece.homes) == 1 and piece.homes[0] == fp[a]):
                    edges += piece.compare(fp[a:b], max_bits)
            if edges:
                yield out(edges)
        if piece is not None and (edges := piece.rest()):
            yield out(edges)

    return dealt.mapInArrow(run, "a long, b long")


def classes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle_words: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing
    bits. NULL and empty texts have fingerprint zero and link like any other. Rows may repeat:
    each gives a row. A NULL id takes part, but is a component's id only where its group has no
    other. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    marked = cut(with_fingerprint(rows, text="_text", shingle_words=shingle_words).drop("_text"), "fingerprints")
    distinct = cut(marked.groupBy("_fp").agg(F.min("_id").alias("first")), "distinct")
    groups = components(links(distinct.select(F.col("_fp").alias("fp")), max_bits))
    named = distinct.join(groups, distinct["_fp"] == groups["node"], "left").select(
        "_fp", "first", F.coalesce("component", "_fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = named.join(least, "component").select("_fp", "component_id")
    return marked.join(of_fp, "_fp", "left").select(
        F.col("_id").alias(key), _hex("_fp").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle_words: int = 3, max_bits: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the one with its smallest id.

    Of rows that repeat an id and fingerprint one stays. A group without any id keeps one row
    of each fingerprint. All columns are kept, whatever their names.
    """
    found = classes(docs.select(f"`{key}`", f"`{text}`"), key=key, text=text, shingle_words=shingle_words, max_bits=max_bits)
    tag = lambda own, digits: F.concat_ws(":", own.cast("string"), digits)  # noqa: E731  NULL: the digits alone
    chosen = (
        found.where(F.col(f"`{key}`").eqNullSafe(F.col("component_id")))
        .select(tag(F.col(f"`{key}`"), F.col("fingerprint")).alias("_tag")).distinct()
    )
    plain = [f"c{i}" for i in range(len(docs.columns))]
    own, words = (plain[docs.columns.index(c)] for c in (key, text))
    marked = with_fingerprint(docs.toDF(*plain), text=words, shingle_words=shingle_words)
    marked = marked.withColumn("_tag", tag(F.col(own), _hex("_fp")))
    first = Window.partitionBy("_tag").orderBy(F.xxhash64(*plain))
    kept = marked.join(chosen, "_tag", "left_semi").withColumn("_n", F.row_number().over(first))
    return kept.where("_n = 1").select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns)])
