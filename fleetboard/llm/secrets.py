"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: alternatives of trigrams
(three bytes of UTF-8, A-Z in lower case) that every match has to hold. Each task takes its
documents in shards of a batch, writes the shard's postings for all trigrams of the rules,
intersects and unites them as the queries say, and tries a rule's expression only on the documents
that are left. A rule without a mandatory trigram, such as a run of hex digits, is tried on all.
The index is a filter: the spans found are those of the expressions on whole texts.

Nothing is shuffled, and a shard's index is bounded by its texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetboard.llm.common import text_batches
from fleetboard.llm.words import LOWER

#: Strings that a part of an expression may stand for, to be taken apart into trigrams; characters of a set.
STRINGS, SET = 64, 16
#: Alternatives of a query; a conjunction of more keeps its narrower part.
ALTERNATIVES = 64
#: Bytes whose trigrams are looked up at once.
CHUNK = 1 << 22


@dataclass(frozen=True)
class Rule:
    """``kind``, the expression, and how many characters its ``group`` must have for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap, in code points; too short ones are dropped."""
        found = self.regex.finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


def either_case(word: str) -> str:
    """An expression for a word's ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else re.escape(c) for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])

#: The base rules. Runs are maximal, so a least length in the expression drops what is too short.
BASE = (
    Rule("assign", f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
#: Further rules: tokens of a code host, signed web tokens, private key blocks.
MORE = (
    Rule("host", "gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE


# ---- from an expression to trigrams

#: Alternatives, each a set of trigrams that must all be there; one without any says nothing.
Query = frozenset
ANY: Query = frozenset([frozenset()])


def _either(queries: list[Query]) -> Query:
    """An alternative that holds all of another one is left out."""
    found = frozenset().union(*queries)
    return frozenset(a for a in found if not any(b < a for b in found))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > ALTERNATIVES:
        return min(a, b, key=lambda q: (len(q), -min(map(len, q))))
    return _either([frozenset([x | y]) for x, y in product(a, b)])


def _of_strings(strings: set[str]) -> Query:
    def trigrams(s: str) -> frozenset:
        data = bytes(LOWER[np.frombuffer(s.encode(), np.uint8)])
        return frozenset(data[i : i + 3] for i in range(len(data) - 2))

    return _either([frozenset([trigrams(s)]) for s in strings])


def _products(parts: list[set[str] | None]) -> set[str] | None:
    found = {""}
    for part in parts:
        if part is None or len(found) * len(part) > STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _folded(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _exact(op, arg, flags: int) -> set[str] | None:
    """All strings, A-Z in lower case, that this part of an expression stands for; None if too many."""
    folds = flags & re.IGNORECASE and not flags & re.ASCII
    if op is C.LITERAL:
        return None if folds else {_folded(arg)}
    if op is C.IN and not folds:
        found: set[str] = set()
        for kind, value in arg:
            if kind is C.LITERAL:
                found.add(_folded(value))
            elif kind is C.RANGE and value[1] - value[0] < SET:
                found.update(map(_folded, range(value[0], value[1] + 1)))
            else:
                return None
        return found if len(found) <= SET else None
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return {""}
    if op is C.SUBPATTERN:
        return _products([_exact(*part, (flags | arg[1]) & ~arg[2]) for part in arg[3]])
    if op is C.ATOMIC_GROUP:
        return _products([_exact(*part, flags) for part in arg])
    if op is C.BRANCH:
        each = [_products([_exact(*part, flags) for part in way]) for way in arg[1]]
        return None if None in each or sum(map(len, each)) > STRINGS else set().union(*each)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[1] <= 4:
        one = _products([_exact(*part, flags) for part in arg[2]])
        each = [_products([one] * n) for n in range(arg[0], arg[1] + 1)]
        return None if None in each or sum(map(len, each)) > STRINGS else set().union(*each)
    return None


def _inside(op, arg, flags: int) -> Query:
    """What a part needs that stands for too many strings."""
    if op is C.SUBPATTERN:
        return _sequence(arg[3], (flags | arg[1]) & ~arg[2])
    if op is C.ATOMIC_GROUP:
        return _sequence(arg, flags)
    if op is C.BRANCH:
        return _either([_sequence(way, flags) for way in arg[1]])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0]:
        return _sequence(arg[2], flags)
    return ANY


def _sequence(parts, flags: int) -> Query:
    query, strings = ANY, {""}
    for op, arg in parts:
        own = _exact(op, arg, flags)
        longer = _products([strings, own])
        if longer is not None:
            strings = longer
            continue
        query, strings = _both(query, _of_strings(strings)), own or {""}
        if own is None:
            query = _both(query, _inside(op, arg, flags))
    return _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> Query:
    """The trigrams that every match of an expression holds; ``ANY`` if there are none to name.

    Expressions that fold more than ASCII letters are not taken apart where they do.
    """
    parsed = _parser.parse(pattern)
    return _sequence(parsed, parsed.state.flags)


# ---- a shard and its postings


class Trigrams:
    """The trigrams of some queries, and where texts hold them."""

    def __init__(self, queries: list[Query]):
        self.all = sorted(set().union(*(needed for q in queries for needed in q)))
        self._number = np.zeros(1 << 24, np.int16)
        self._number[[int.from_bytes(t, "big") for t in self.all]] = np.arange(1, len(self.all) + 1)

    def postings(self, texts: pa.Array) -> dict[bytes, np.ndarray]:
        """For each trigram the places of the texts that hold it, ascending."""
        texts = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        found = [np.zeros(0, np.int64)]
        for start in range(0, max(0, len(data) - 2), CHUNK):
            part = LOWER[data[start : start + CHUNK + 2]].astype(np.int32)
            which = self._number[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            at = np.flatnonzero(which)
            text = np.searchsorted(bounds, at + start, "right") - 1
            inside = at + start + 3 <= bounds[text + 1]
            found.append(np.unique((which[at].astype(np.int64) - 1)[inside] * n + text[inside]))
        pairs = np.unique(np.concatenate(found))
        cuts = np.searchsorted(pairs, np.arange(len(self.all) + 1) * n)
        return {t: pairs[cuts[i] : cuts[i + 1]] - i * n for i, t in enumerate(self.all)}


def candidates(query: Query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Of ``n`` texts those that a query leaves: its lists intersected, the shortest first, and united."""
    left = [np.zeros(0, np.int64)]
    for needed in query:
        lists = sorted((postings[t] for t in needed), key=len)
        left.append(reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists) if lists else np.arange(n))
    return np.unique(np.concatenate(left))


def find(texts: pa.Array, rules: tuple[Rule, ...], queries: list[Query], trigrams: Trigrams) -> list[list[tuple[int, int, int]]]:
    """Per text (start, rule's number, end), sorted."""
    postings = trigrams.postings(texts)
    spans: list[list] = [[] for _ in range(len(texts))]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        for at in candidates(query, postings, len(texts)).tolist():
            text = texts[at].as_py()
            if text:
                spans[at].extend((start, k, end) for start, end in rule.spans(text))
    return [sorted(s) for s in spans]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``, an array of (kind, start, end) by start, then by the order of the rules.

    Starts and ends count code points, ends are exclusive. One row per row of ``docs``, whatever its id;
    NULL and empty texts have no spans. A very long text is held once as text and in pieces as trigrams.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    span = T._parse_datatype_string("kind string, start int, end int")
    schema = T.StructType([rows.schema["id"], T.StructField("spans", T.ArrayType(span))])
    queries, kinds = [trigram_query(r.pattern) for r in rules], [r.kind for r in rules]
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams = Trigrams(queries)
        for batch in batches:
            found = [[{"kind": kinds[k], "start": s, "end": e} for s, k, e in own] for own in find(batch["text"], rules, queries, trigrams)]
            yield pa.record_batch([batch["id"], pa.array(found, arrow)], ["id", "spans"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)
