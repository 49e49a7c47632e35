"""Token ids in binary shards, reached by key through minimal perfect hashes.

**Shard**: the ids of its documents one after the other as little-endian unsigned integers of
``width`` bytes (2 where the vocabulary fits), then ``n + 1`` little-endian 64-bit offsets of
the documents, counted in ids, then a footer (magic, width, n). Shards hold ascending key ranges;
within one, documents ascend by key, equal keys by text, NULL keys first.

**Index**: keys are dealt by hash to parts of about ``PART_KEYS``. A part's minimal perfect hash
is a cascade of bit arrays: at each level every key still left hashes to a bit, keys alone on
their bit stay there, the others go to the next level. A key's slot is the number of set bits
before its own, found with stored counts, so a lookup takes constant expected time. The slot has
the key's 32-bit fingerprint (a foreign key passes it by a chance of 2**-32), its shard, the
number of its first document there, and how many documents share the key.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetboard.llm.common import (
    attempt_name, create_file, cut, open_file, shared_path, text_batches,
)
from fleetboard.llm.words import runs_of

PART_KEYS = 50_000
MAGIC = b"TOKSHRD1"
INDEX_MAGIC = b"TOKINDX1"
FOOTER = "<8sQQ"
#: Pieces of texts whose ids a Python worker remembers; up to twice as many at times.
PIECES = 250_000
#: Bytes of texts that are cut and encoded at once, unless one text alone has more.
BATCH_BYTES = 2 << 20
#: Bits per key of a level of the hash.
GAMMA = 1.6


class Memory:
    """A dictionary of bounded size that forgets what was not asked for lately."""

    def __init__(self, size: int):
        self.size, self.now, self.before = size, {}, {}

    def unknown(self, keys: Iterable) -> list:
        """Those of ``keys`` (distinct) that are to be learned; all others are in ``now`` after this."""
        if len(self.now) > self.size:
            self.now, self.before = {}, self.now
        now, before, new = self.now, self.before, []
        for key in filterfalse(now.__contains__, keys):
            if (value := before.get(key)) is None:
                new.append(key)
            else:
                now[key] = value
        return new


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    The library's pattern joins no character to a space behind it, nor letters to punctuation (but
    for apostrophes, which contractions have), and keeps a line break between non-spaces apart. A
    batch is cut there with numpy, on bytes: before each space that a non-space follows, around a
    single line break, and between Latin letters and ASCII punctuation. Where a byte may belong to
    a wide space no cut is made, which only makes a piece longer. Only distinct pieces are looked
    up; their ids are remembered, and new ones are encoded together, with line breaks between. A
    text with a special token is encoded whole, as are all with another pre-tokenizer or with a
    normalizer.
    """

    #: Texts that the library encodes at once, and how many such groups before their ids are taken over.
    TOGETHER, GROUPS = 1000, 8

    def __init__(self, path: str | None, width: int, end_id: int, text: str | None = None):
        """``text`` is what the file at ``path`` holds, where that is not to be read here."""
        from tokenizers import Tokenizer

        text = text or Path(path).read_text(encoding="utf-8")
        made = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        pre = made.get("pre_tokenizer") or {}
        self.cuts = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not made.get("normalizer")
        self.specials = [t["content"] for t in made["added_tokens"]]
        self.kind = f"<u{width}"
        self.end = self._bytes([end_id])
        self.line = self._bytes(self._ids(["\n"])[0])
        self.pieces = Memory(PIECES)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, wanted: Iterable[bytes]) -> None:
        """Pieces as UTF-8; those with white space inside are encoded each for itself."""
        new = self.pieces.unknown(wanted)
        plain = [key for key in new if _SOLID.fullmatch(key)]
        other = [key for key in new if not _SOLID.fullmatch(key)] if len(plain) < len(new) else []
        groups = [plain[at : at + self.TOGETHER] for at in range(0, len(plain), self.TOGETHER)]
        line, now = np.frombuffer(self.line, self.kind), self.pieces.now
        # What the library returns for a token has many times the size of its id, so a few groups at a time.
        some = (groups[at : at + self.GROUPS] for at in range(0, len(groups), self.GROUPS))
        coded = chain.from_iterable(zip(held, self._ids([b"\n".join(g).decode() for g in held])) for held in some)
        for group, ids in coded:
            data = np.array(ids, self.kind)
            ends = np.flatnonzero(data == line[0]) if len(line) == 1 else []
            if len(ends) == len(group) - 1:
                raw, size = data.tobytes(), data.itemsize
                ends = [*(ends * size).tolist(), len(raw)]
                starts = [0, *(e + size for e in ends)]
                now.update(zip(group, (raw[a:b] for a, b in zip(starts, ends))))
            else:
                other += group
        for at in range(0, len(other), self.TOGETHER):
            some = other[at : at + self.TOGETHER]
            now.update(zip(some, map(self._bytes, self._ids([key.decode() for key in some]))))

    def encode(self, texts: pa.Array | list) -> list[bytes]:
        """Of each text the little-endian ids with the end id; NULL as empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string()).fill_null("")
        apart = np.full(len(texts), not self.cuts)
        for special in self.specials:
            apart |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        alone = {int(i): texts[int(i)].as_py() for i in np.flatnonzero(apart)}
        if alone:
            texts = pc.if_else(pa.array(apart), pa.scalar("", pa.large_string()), texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
        body = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(body, np.uint8) if body is not None and len(body) else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        start = _cuts(data, bounds)
        at = np.append(np.flatnonzero(start), len(data)) if len(data) else np.zeros(1, np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        found = list(map(self.pieces.now.__getitem__, distinct))
        ids = np.frombuffer(b"".join(found), self.kind)
        length = np.fromiter(map(len, found), np.int64, len(found)) // ids.itemsize
        first = np.cumsum(length) - length
        codes = coded.indices.to_numpy(zero_copy_only=False)
        all_ids = ids[runs_of(first[codes], first[codes] + length[codes])] if len(codes) else ids
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(length[codes])])
        cuts = before[np.searchsorted(at[:-1], bounds)]
        out = [all_ids[a:b].tobytes() + self.end for a, b in zip(cuts, cuts[1:])]
        for i, text in alone.items():
            out[i] = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids) + self.end
        return out


_BYTES = np.arange(256)
_LETTER = ((_BYTES | 0x20) >= 0x61) & ((_BYTES | 0x20) <= 0x7A) & (_BYTES < 0x80)
_VISIBLE = (_BYTES > 0x20) & (_BYTES < 0x7F)
_MARK = _VISIBLE & ~_LETTER & ~((_BYTES >= 0x30) & (_BYTES <= 0x39)) & (_BYTES != ord("'"))
# Bytes behind a space or line break that are certainly not white space: neither ASCII white
# space nor the first byte of a character that may be.
_BEGINS = np.ones(256, bool)
_BEGINS[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False
# A piece without white space but at its beginning (that of ASCII; wide spaces count as letters
# here, which the line breaks between pieces do not mind).
_SOLID = re.compile(rb" ?[^\x09-\x0d\x1c-\x20]+")


def _cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces of UTF-8 texts begin, and the texts themselves (``bounds``)."""
    start = np.zeros(len(data) + 1, bool)
    if len(data):
        behind = np.append(data[1:], np.uint8(0x20))
        # Letters from U+00C0 to U+017F have two bytes; two signs among them are no letters.
        wide = (data >= 0xC3) & (data <= 0xC5) & ~((data == 0xC3) & ((behind == 0x97) | (behind == 0xB7)))
        begins, ends = _LETTER[data] | wide, _LETTER[data]
        ends[1:] |= wide[:-1]
        mark = _MARK[data]
        start[1:-1] = (mark[1:] & ends[:-1]) | (begins[1:] & mark[:-1])
        follows = _BEGINS[behind]
        follows[np.maximum(bounds[1:] - 1, 0)] = False
        start[:-1] |= (data == 0x20) & follows
        line = (data[1:] == 0x0A) & follows[1:] & (ends[:-1] | _VISIBLE[data[:-1]])
        start[1:-1] |= line
        start[2:] |= line
    start[bounds] = True
    start[-1] = False
    return start


_encoders: dict[tuple, Encoder] = {}


def encoder(text: str, width: int, end_id: int) -> Encoder:
    """One for each Python worker, which keeps what it remembers between tasks."""
    if (made := _encoders.get((text, width, end_id))) is None:
        made = _encoders[text, width, end_id] = Encoder(None, width, end_id, text)
    return made


def _gathered(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches joined until they have ``size`` bytes, larger ones cut by rows.

    Larger batches have fewer distinct words, but what encoding holds grows with the batch.
    """
    size = size or BATCH_BYTES
    held: list[pa.RecordBatch] = []
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            if sum(b.nbytes for b in held) >= size:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def _key_text(key: Column) -> Column:
    """Keys as text, NULL apart from all others."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 2, key: str = "doc_id",
    text: str = "text", width: int = 2, shards: int | None = None,
) -> DataFrame:
    """Encode ``text`` and write shards; a row per document: key, shard, path, record, n_ids."""
    spark = docs.sparkSession
    text_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    dealt = rows.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")
    # The driver reads the tokenizer's file and sends what it holds: no other machine needs it.
    made = Path(tokenizer).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        path = f"{folder}/shards/{attempt_name(f'{shard:06d}')}.ids"
        ids = encoder(made, width, end_id)
        file, lengths = None, []
        for batch in _gathered(batches):
            file = file or create_file(path)
            own = []
            for data in ids.encode(batch.column(1)):
                file.write(data)
                own.append(len(data) // width)
            n, before = len(own), len(lengths)
            lengths += own
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(n, shard, np.int32)), pa.array([path] * n),
                    pa.array(np.arange(before, before + n)), pa.array(own, pa.int64()),
                ],
                names=["key", "shard", "path", "record", "n_ids"],
            )
        if file:
            file.write(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
            file.write(struct.pack(FOOTER, MAGIC, width, len(lengths)))
            file.close()

    kind = rows.schema["key"].dataType.simpleString()
    return dealt.mapInArrow(run, f"key {kind}, shard int, path string, record long, n_ids long")


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of each hash for each level; a bijection, so no two ever join."""
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(keys: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each key the hash that finds its slot, and its fingerprint."""
    data = [k.encode() for k in keys]
    own = np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in data), np.uint64, len(data))
    prints = np.fromiter((xxhash.xxh32_intdigest(k, seed + 1) for k in data), np.uint32, len(data))
    return own, prints


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes: bit arrays by level and their counts."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = [np.packbits(bits, bitorder="little") for bits in levels]
        self.bytes = words
        self.counts, total = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.counts.append(total + np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(w) else np.zeros(0, np.int64))
            total += int(ones.sum())
        self.size = total

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            size = max(8, -(-int(GAMMA * len(left)) // 8) * 8)
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            taken = np.bincount(at, minlength=size)
            levels.append(taken == 1)
            left = left[taken[at] != 1]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 where no level has a bit for it."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = (_mixed(hashes[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            where, own = at[hit], open_[hit]
            low = self.bytes[level][where >> 3] & ((1 << (where & 7)) - 1).astype(np.uint8)
            out[own] = self.counts[level][where >> 3] + np.bitwise_count(low)
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + b"".join(struct.pack("<Q", len(b)) for b in self.levels)
        return head + b"".join(w.tobytes() for w in self.bytes)

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        (n,) = struct.unpack_from("<I", data)
        sizes = struct.unpack_from(f"<{n}Q", data, 4)
        at, levels = 4 + 8 * n, []
        for size in sizes:
            bits = np.frombuffer(data, np.uint8, size // 8, at)
            levels.append(np.unpackbits(bits, bitorder="little").astype(bool))
            at += size // 8
        return cls(levels), at


SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u4"), ("copies", "<u4")])


def build_part(keys: list[str], shard: np.ndarray, first: np.ndarray, copies: np.ndarray) -> bytes:
    """The file of an index part; keys are distinct."""
    seed = 0
    while True:
        own, prints = _hashes(keys, seed)
        if len(np.unique(own)) == len(own):
            break
        seed += 2
    perfect = PerfectHash.build(own)
    slots = np.zeros(perfect.size, SLOT)
    at = perfect.slots(own)
    for name, values in (("print", prints), ("shard", shard), ("first", first), ("copies", copies)):
        slots[name][at] = values
    return INDEX_MAGIC + struct.pack("<I", seed) + perfect.dump() + slots.tobytes()


def find_in_part(data: bytes, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slot rows of the keys, and which of them are there."""
    if data[:8] != INDEX_MAGIC:
        raise ValueError("not an index part")
    (seed,) = struct.unpack_from("<I", data, 8)
    perfect, at = PerfectHash.load(data[12:])
    slots = np.frombuffer(data, SLOT, perfect.size, 12 + at)
    own, prints = _hashes(keys, seed)
    where = perfect.slots(own)
    there = where >= 0
    rows = slots[np.maximum(where, 0)] if len(slots) else np.zeros(len(keys), SLOT)
    return rows, there & (rows["print"] == prints)


def write_index(entries: DataFrame, folder: str, parts: int) -> DataFrame:
    """Write the index of shard rows; a row per part: part, path."""
    keys = entries.groupBy("key").agg(
        F.min(F.struct("shard", "record")).alias("first"), F.count("*").alias("copies")
    ).select(
        _key_text(F.col("key")).alias("key"), "first.shard", F.col("first.record").alias("first"), "copies"
    ).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        part = rows["part"][0].as_py()
        path = f"{folder}/index/{attempt_name(f'{part:06d}')}.mph"
        with create_file(path) as file:
            file.write(build_part(rows["key"].to_pylist(), *(rows[c].to_numpy() for c in ("shard", "first", "copies"))))
        return pa.table({"part": pa.array([part], pa.int32()), "path": [path]})

    return keys.groupBy("part").applyInArrow(build, "part int, path string")


class TokenStore:
    """Written shards and their index; ``shards`` and ``index`` are small written tables."""

    def __init__(self, shards: DataFrame, index: DataFrame, parts: int):
        self.shards, self.index, self.parts = shards, index, parts

    def find(self, keys: DataFrame) -> DataFrame:
        """Of a column of keys: key, shard, first, copies of those that the index has."""
        name = keys.columns[0]
        asked = keys.select(F.col(f"`{name}`").alias("key"), _key_text(F.col(f"`{name}`")).alias("text"))
        asked = asked.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(self.parts)).cast("int"))

        def look(rows: pa.Table) -> pa.Table:
            with open_file(rows["path"][0].as_py()) as file:
                found, there = find_in_part(file.read(), rows["text"].to_pylist())
            places = {c: pa.array(found[c].astype(np.int64)) for c in ("shard", "first", "copies")}
            return pa.table({"key": rows["key"], **places}).filter(pa.array(there))

        kind = asked.schema["key"].dataType.simpleString()
        with_path = asked.join(self.index, "part")
        return with_path.groupBy("part").applyInArrow(look, f"key {kind}, shard long, first long, copies long")

    def read(self, found: DataFrame) -> DataFrame:
        """For each document of each found key: key, start, n_tokens, ids (little-endian bytes).

        ``start`` counts the ids of all documents before it in all shards.
        """
        return self._each(found, "ids binary", lambda ids: ids.tobytes(), pa.binary())

    def digests(self, found: DataFrame) -> DataFrame:
        """As ``read``, with the CRC-32 of the ids as unsigned 32-bit integers instead of them."""
        return self._each(found, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())

    def _each(self, found: DataFrame, column: str, value, kind: pa.DataType) -> DataFrame:
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        bases = self.shards.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
        places = found.join(bases, "shard").repartition("shard").sortWithinPartitions("shard", "first")
        places = places.select("key", "path", "base", "first", "copies")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            path, file = None, None
            for batch in batches:
                out: list[tuple] = []
                for k, p, base, first, copies in zip(*(c.to_pylist() for c in batch.columns)):
                    if p != path:
                        if file:
                            file.close()
                        path, file = p, open_file(p)
                        file.seek(file.size() - struct.calcsize(FOOTER))
                        magic, width, n = struct.unpack(FOOTER, file.read(struct.calcsize(FOOTER)))
                        if magic != MAGIC:
                            raise ValueError(f"not a shard: {path}")
                        file.seek(file.size() - struct.calcsize(FOOTER) - 8 * (n + 1))
                        offsets = np.frombuffer(file.read(8 * (n + 1)), "<u8").astype(np.int64)
                    for record in range(first, first + copies):
                        a, b = int(offsets[record]), int(offsets[record + 1])
                        file.seek(a * width)
                        ids = np.frombuffer(file.read((b - a) * width), f"<u{width}")
                        out.append((k, base + a, b - a, value(ids)))
                key, start, n_tokens, values = zip(*out) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, batch.schema.field(0).type), pa.array(start, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(values, kind)],
                    names=["key", "start", "n_tokens", column.split()[0]],
                )
            if file:
                file.close()

        text_batches(found.sparkSession)
        key_kind = found.schema["key"].dataType.simpleString()
        return places.mapInArrow(run, f"key {key_kind}, start long, n_tokens long, {column}")


def write_store(docs: DataFrame, tokenizer: str, *, folder: str | None = None, **options) -> TokenStore:
    """Write shards and index of ``docs`` into ``folder`` (default: a new shared one).

    NULL texts are empty documents. Rows that share a key, a NULL one too, are documents of
    their own that lie side by side and are found together. An empty table gives no shard and
    no index part. Other columns are not read. Options are those of ``write_shards``.
    """
    folder = folder or shared_path(docs.sparkSession, "tokens")
    entries = cut(write_shards(docs, folder, tokenizer, **options), "entries")
    shards = cut(entries.groupBy("shard", "path").agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("n")), "shards")
    n = shards.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-n // PART_KEYS))
    return TokenStore(shards, cut(write_index(entries, folder, parts), "index"), parts)


def round_trip(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", **options) -> DataFrame:
    """Write ``docs``, then look every key up again and read its documents: key, start, n_tokens, ids_crc32."""
    store = write_store(docs, tokenizer, key=key, **options)
    keys = docs.select(F.col(f"`{key}`").alias("key")).distinct()
    return store.digests(store.find(keys)).withColumnRenamed("key", key)
