"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into phrases: each is the shortest run from where the last one
ended that is not yet in the dictionary, and enters it. Texts that compress well together share
phrases, so the Jaccard likeness of phrase sets follows compression likeness. The set is hashed
to 32 bits and its ``SIZE`` least hashes are the signature: the share of the least hashes of
both signatures together that both have estimates the likeness, and is exact for small sets.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetboard.llm.common import text_batches

#: Least hashes that a signature keeps.
SIZE = 128


def parse(data: bytes, known: dict[bytes, None], start: int = 0, end: int | None = None) -> int:
    """Add the phrases of ``data[start:end]`` to ``known``, in order.

    Returns where the last, unfinished phrase begins, from where longer data can be parsed on.
    """
    stop = len(data) if end is None else end
    at = start + 1
    while at <= stop:
        phrase = data[start:at]
        if phrase in known:
            at += 1
        else:
            known[phrase] = None
            start = at
            at += 1
    return start


def hashes(known) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, known), np.uint32, len(known))


def signature(found: np.ndarray) -> np.ndarray:
    return np.unique(found)[:SIZE]


def written(own: np.ndarray) -> str:
    """A signature as text; empty for a text without phrases."""
    return base64.b64encode(own.astype("<u4").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of the phrase sets; 1 of two empty ones."""
    least = np.union1d(a, b)[:SIZE]
    if not len(least):
        return 1.0
    return float((np.isin(least, a) & np.isin(least, b)).sum() / len(least))


def fingerprint_of(text: str | None) -> str:
    """The fingerprint of one text; NULL as empty. Equal texts have equal fingerprints."""
    known: dict[bytes, None] = {}
    parse((text or "").encode(), known)
    return written(signature(hashes(known)))


class _Document:
    """A parsed text that can also be parsed on with another second half."""

    def __init__(self, key, text: str):
        self.key, self.text, self.n = key, text, len(text)
        head = text[: self.n - self.n // 2].encode()
        known: dict[bytes, None] = {}
        self.begun = parse(head, known)
        self.head, self.head_known = head, dict(known)
        parse(text.encode(), known, self.begun)
        own = hashes(known)
        self.head_hashes = own[: len(self.head_known)]
        self.signature = signature(own)

    def edited(self, follower: str) -> tuple[str, np.ndarray]:
        """SHA-256 and signature with the second half replaced by the follower's beginning."""
        data = self.head + follower[: self.n // 2].encode()
        known = self.head_known
        before = len(known)
        parse(data, known, self.begun)
        new = list(known)[before:]
        return hashlib.sha256(data).hexdigest(), signature(np.concatenate([self.head_hashes, hashes(new)]))


def edited_pairs(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and likenesses to that and the next text.

    Documents follow each other by descending id (an integer; NULL last, equal ids by text),
    after the last comes the first. The edited text of one of ``n`` characters has its last
    ``n // 2`` replaced by as many first ones of the next (or all it has). Texts are shuffled
    once, into ranges of ids; the first document of each range is also sent, behind the rest,
    to the range before it, so no other order over all rows is needed. NULL texts are empty. A
    single document is its own follower; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text_batches(spark)
    least = -(1 << 63)
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(least)).alias("place"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    limits = sorted(set(rows.agg(F.percentile_approx("place", shares or [0.5], 100_000)).first()[0] or []))

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(limits, np.int64), place.to_numpy(), "left").astype(np.int32))

    placed = rows.withColumn("range", range_of("place"))
    # One number per range, as many as there are partitions.
    heads = sorted(placed.groupBy("range").agg(F.max("place").alias("place")).collect())
    ahead = [(h.place, heads[i + 1 - len(heads)].range) for i, h in enumerate(heads)]
    sent = spark.createDataFrame(ahead or [(0, 0)], "place long, ahead int").where(F.lit(bool(ahead)))
    extra = placed.drop("range").join(F.broadcast(sent), "place").select("key", "place", "text", F.col("ahead").alias("range"), F.lit(True).alias("ahead"))
    dealt = (
        placed.select("key", "place", "text", "range", F.lit(False).alias("ahead")).unionAll(extra)
        .repartitionById(ranges, "range").sortWithinPartitions("ahead", F.desc("place"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Document | None = None
        done = False
        for batch in batches:
            out: list[tuple] = []
            for own, body, is_ahead in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                if done:
                    break
                now = _Document(own, body)
                if last is not None:
                    digest, edited = last.edited(now.text)
                    out.append((
                        last.key, last.n, digest, written(last.signature), written(edited),
                        likeness(last.signature, edited), likeness(last.signature, now.signature),
                    ))
                # Of the rows sent ahead only the first follows.
                last, done = now, is_ahead
            if out:
                columns = list(zip(*out))
                kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    found = dealt.mapInArrow(
        run, f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
    return found.withColumnRenamed("key", key)
