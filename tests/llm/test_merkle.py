import hashlib

import pytest
from fleetboard.llm import merkle
from pyspark.sql import functions as F


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_steps(levels, at):
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def plain(rows):
    """Per row (id, grp, leaf, seen): subroot, root, steps."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_levels([r[2] for r in groups[g]]) for g in names}
    tops = plain_levels([trees[g][-1][0] for g in names])
    for j, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            yield r, trees[g][-1][0], tops[-1][0], [*plain_steps(trees[g], i), *plain_steps(tops, j)]


def plain_fold(start, steps):
    for before, after in steps:
        start = sha(*before, start, *after)
    return start


@pytest.fixture(scope="module")
def rows():
    sizes = {"a": 700, "b": 1, None: 9, "": 8, "é": 64, "B": 65, "z": 2}
    found = [(i * 7 % 1009, g, sha(str(g), str(i)), sha("x") if i % 3 == 0 else None) for g, n in sizes.items() for i in range(n)]
    found += [(5, f"g{i:03}", sha(f"{i}"), None) for i in range(90)]
    # NULL and repeated ids, equal rows.
    return found + [(None, "a", sha("n"), None), (3, "a", sha("t"), None), (3, "a", sha("t"), None), (None, None, sha("m"), sha("m"))]


@pytest.fixture(scope="module")
def tree(spark, rows):
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "id long, grp string, leaf string, seen string, level int, salt string")
    return merkle.build(df.repartition(5))


def key(r):
    return tuple((v is not None, v) for v in r)


@pytest.mark.parametrize("leaves", [1, 100, 2048])
def test_audit_against_a_plain_tree(tree, rows, leaves):
    if leaves == 1:
        wanted = tree.leaves.where("id % 50 = 3 OR grp IS NULL")
        rows = [r for r in rows if r[1] is None or r[0] is not None and r[0] % 50 == 3]
    else:
        wanted = None
    found = merkle.audit(tree, wanted, leaves=leaves).collect()
    got = [(r.id, r.grp, r.leaf, r.seen, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found]
    want = []
    for r, subroot, root, steps in plain(tree_rows(tree)):
        if leaves == 1 and not (r[1] is None or r[0] is not None and r[0] % 50 == 3):
            continue
        folded = plain_fold(r[3] or r[2], steps)
        want.append((*r, subroot, root, sha(*(h for b, a in steps for h in (*b, *a))), folded, folded == root))
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == len(rows)
    assert {r.verified for r in found} == {True, False}
    assert all(r.level == 1 and r.salt == "q" for r in found)


def tree_rows(tree):
    return [(r.id, r.grp, r.leaf, r.seen) for r in tree.leaves.collect()]


def test_proofs_lead_to_the_root(tree):
    some = tree.leaves.where("id % 97 = 1 OR id IS NULL")
    found = merkle.proofs(tree, some).collect()
    assert len(found) == some.count() > 5
    for r in found:
        assert merkle.fold(r.leaf, ((s.before, s.after) for s in r.proof)) == r.root == tree.root


def test_a_partition_fetches_each_node_once_and_none_it_derives(spark, tree):
    asked = []
    whole = tree.leaves.withColumn("p", F.lit(0)).toArrow()
    assert merkle._missing(whole, tree.groups).num_rows == 0
    one = tree.leaves.where("grp = 'a'").withColumn("p", F.lit(0)).toArrow()
    found = merkle._missing(one, tree.groups).to_pylist()
    asked = [(r["tree"], r["level"], r["pos"]) for r in found]
    assert len(asked) == len(set(asked)) and {t for t, _, _ in asked} == {merkle.TOP}


def test_leaf_writes_lengths_in_bytes(spark):
    df = spark.createDataFrame([(1, "é漢", None), (-12, "", "x:1")], "a long, b string, c string")
    got = [r[0] for r in df.select(merkle.leaf("a", "b", "c")).collect()]
    assert got == [plain_leaf(1, "é漢", None), plain_leaf(-12, "", "x:1")]


@pytest.mark.parametrize("sizes", [[1], [3], [1, 1], [9, 1], [1] * 12])
def test_small_trees(spark, sizes):
    rows = [(i, f"g{g:02}", sha(f"{g} {i}"), None) for g, n in enumerate(sizes) for i in range(n)]
    found = merkle.audit(merkle.build(spark.createDataFrame(rows, "id long, grp string, leaf string, seen string"))).collect()
    want = {r[:3]: (subroot, root, sha(*(h for b, a in steps for h in (*b, *a)))) for r, subroot, root, steps in plain(rows)}
    assert {(r.id, r.grp, r.leaf): (r.subroot, r.root, r.proof_sha256) for r in found} == want and all(r.verified for r in found)


def test_no_rows(spark):
    tree = merkle.build(spark.createDataFrame([], "id long, grp string, leaf string, seen string"))
    assert tree.root is None and merkle.audit(tree).collect() == [] and merkle.proofs(tree).collect() == []
