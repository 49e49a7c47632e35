"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import xxhash
from fleetboard.llm import simhash

DIGITS = 16


def plain_fingerprint(text):
    words = []
    for part in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").split("\n"):
        words += [w for w in part.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(fps, max_bits):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    return group


def least_ids(ids, group):
    return {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in set(group)}


def test_classes_against_all_pairs(docs, texts):
    got = sorted(map(tuple, simhash.classes(docs).collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t in texts]
    group = components(fps, 3)
    least = least_ids([i for i, _ in texts], group)
    want = sorted(((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(texts, fps, group)), key=repr)
    assert got == want


def test_empty_texts_link_to_each_other(docs):
    found = {r.doc_id: r for r in simhash.classes(docs).where("doc_id IN (50, 51, 52)").collect()}
    assert {r.fingerprint for r in found.values()} == {"0" * 16}
    assert {r.component_id for r in found.values()} == {50}


def test_links_find_every_component_of_dense_fingerprints(spark):
    own = random.Random(3)
    centres = [own.getrandbits(64) for _ in range(6)]
    fps = set(centres)
    for c in centres:
        for _ in range(60):
            x = c
            for _ in range(own.randint(1, 5)):
                x ^= 1 << own.choice([0, 1, 2, 30, 31, 32, 33, 62, 63, own.randrange(64)])
            fps.add(x)
    fps = sorted(fps)
    for max_bits in (1, 3, 5):
        signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
        edges = simhash.links(spark.createDataFrame(signed, "fp long"), max_bits).collect()
        near = [(np.uint64(np.int64(e.a)), np.uint64(np.int64(e.b))) for e in edges]
        assert len(near) < 4 * 62 * len(fps)
        place = {f: i for i, f in enumerate(fps)}
        group = list(range(len(fps)))
        for a, b in near:
            x, y = group[place[int(a)]], group[place[int(b)]]
            group = [x if g == y else g for g in group]
        want = components(fps, max_bits)
        assert len(set(zip(group, want))) == len(set(group)) == len(set(want))


def test_a_crowded_anchor_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOME_ROWS", 8)
    fps = [(b << 32 | b * 3,) for b in range(120)]
    edges = simhash.links(spark.createDataFrame(fps, "fp long"), 3).collect()
    group = list(range(120))
    for e in edges:
        a, b = group[e.a >> 32], group[e.b >> 32]
        group = [a if g == b else g for g in group]
    want = components([f[0] for f in fps], 3)
    assert len(set(zip(group, want))) == len(set(group)) == len(set(want))


def test_keep_one_keeps_the_smallest_of_each_group(docs, texts):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    fps = [plain_fingerprint(t) for _, t in texts]
    group = components(fps, 3)
    least = least_ids([i for i, _ in texts], group)
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(v for v in least.values() if v is not None)
    text_of = {(i, t) for i, t in texts}
    assert all((r.doc_id, r.text) in text_of for r in rows)


def test_empty_table(no_docs):
    assert simhash.classes(no_docs).count() == 0
    assert simhash.keep_one(no_docs).columns == no_docs.columns
