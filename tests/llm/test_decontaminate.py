import re

import pytest
from fleetboard.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(rows, items, window=10):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in rows:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit[k : k + n] = [True] * n
        out.append((i, len(w), sum(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(texts, prose):
    text = dict(texts)
    base = text[20].split(" ")
    return [
        (1, " ".join(base[20:45])), (2, " ".join(base[100:112]).upper()), (3, prose(40, 77)), (4, "ko"), (5, "ko-LU!"),
        (6, None), (7, "  "), (8, " ".join(base[20:45])), (8, text[41]), (None, " ".join(base[3:9])), (11, " ".join(["same"] * 14)),
        (12, " ".join(base[60:69])), (13, " ".join(base[0:9] + ["other"])),
    ]


def found(docs, items, spark, **options):
    benchmark = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, block string")
    got = decontaminate.find_hits(docs, benchmark, drop_text=True, **options).select("doc_id", "n_words", "n_hit", "items")
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_words": 40}, {"window": 4}, {"window": 13}])
def test_against_all_windows(spark, docs, texts, items, options):
    assert found(docs, items, spark, **options) == plain(texts, items, options.get("window", 10))


def test_many_short_spans(spark, prose):
    """Every span of ten shared words is found, wherever it lies and whatever is around it."""
    item = prose(60, 1)
    cut = item.split(" ")
    rows = [(i, f"{prose(3, 50 + i)} {' '.join(cut[i : i + 10 - i % 2])} {prose(3, 90 + i)}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, [(1, item)], spark) == plain(rows, [(1, item)])


def test_clean_keeps_columns(spark, docs, texts, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    want = [i for i, _, hit, _ in plain(texts, items) if not hit]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark, docs, no_docs, items):
    assert found(no_docs, items, spark) == []
    assert all(not r[2] and not r[3] for r in found(docs, items[:0] or [(6, None)], spark))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_hits(docs, none).where("n_hit > 0").count() == 0


def test_blocks_are_read_once_for_gathered_batches(spark, docs, items):
    import pyarrow as pa

    frame = spark.createDataFrame(items, "item_id long, text string")
    paths = decontaminate.write_blocks(frame, key="item_id", text="text", window=10, block_words=60)
    assert len(paths) > 3
    texts = [r.text for r in docs.collect()]
    batches = [pa.record_batch([pa.array(texts[i : i + 5])], ["text"]) for i in range(0, len(texts), 5)]
    loads = []

    def load(path):
        loads.append(path)
        return decontaminate._load(path)

    one = [(c.tolist(), n.tolist(), i) for _, c, n, i in decontaminate.search_blocks(iter(batches), 0, paths, load)]
    assert len(loads) == len(paths) and len(batches) > 5
    loads.clear()
    each = [(c.tolist(), n.tolist(), i) for _, c, n, i in decontaminate.search_blocks(iter(batches), 0, paths, load, gathered=0)]
    assert each == one and len(loads) == len(paths) * len(batches)
