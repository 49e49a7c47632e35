import itertools
import math
import re
import zlib

import corpus_pipeline
import public_tokenizers
import pytest
import tokenizers
import xxhash
from fleetboard.llm import decontaminate, mixing, quality, simhash
from fleetboard.llm.queries import ORACLE, QUERIES, labelled_domains

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "decontamination", "mixing", "tokens"]
    good = stages["quality"](spark, docs, SMALL)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert good.columns == docs.columns
    assert ids(good) == ids(quality.scores(docs, labels).where("predicted = 1"))
    one = stages["near_copies"](spark, good, SMALL)
    assert ids(one) == ids(simhash.classes(good).where("doc_id = component_id"))
    clean = stages["decontamination"](spark, one, SMALL)
    assert ids(clean) == ids(decontaminate.find_hits(one, benchmark).where("n_hit = 0"))
    mixed = stages["mixing"](spark, clean, SMALL)
    assert mixed.columns == docs.columns and set(ids(mixed)) == set(ids(clean))
    written = stages["tokens"](spark, mixed, SMALL).collect()
    assert sorted(r.doc_id for r in written) == ids(mixed)
    run = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(run) == sorted(written)


def test_queries_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, SMALL).count() == 0


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(docs):
    """The smallest id reachable over pairs of at most 3 differing bits, by trying all pairs."""
    prints = {i: plain_fingerprint(t) for i, t in docs}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sorted(prints), 2):
            if least[a] != least[b] and (prints[a] ^ prints[b]).bit_count() <= 3:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def plain_contaminated(text, windows):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def test_run_against_plain_stages(spark):
    """Full rows of run(): near copies, windows and token ids worked out anew, in plain Python.

    Scores and copies are held against plain Python in the tests of their operators.
    """
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r.doc_id for r in quality.scores(docs, labels, threshold=0.3).collect() if r.predicted}
    text = {r.doc_id: r.text for r in docs.collect()}
    least = plain_groups([(i, text[i]) for i in good])
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(10, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    clean = sorted(i for i in good if least[i] == i and not plain_contaminated(text[i], windows))
    assert 0 < len(clean) < len(good) < len(text)

    kept = docs.where(docs.doc_id.isin(clean))
    found, domains = mixing.rates(kept, labelled_domains(kept, labels), temperature=0.7, at_least=1.0)
    rates = {r.id: r for r in found.collect()}
    assert set(rates) == set(clean) and min(r.rate for r in rates.values()) >= 1 and len(domains) > 1
    assert all(math.floor(r.rate) <= r.copies <= math.ceil(r.rate) for r in rates.values())

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for i in clean:
        ids = library.encode(text[i] or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(b"".join(t.to_bytes(4, "little") for t in ids))
        for _ in range(rates[i].copies):
            want.append((i, start, len(ids), crc))
            start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == want
