import random

import numpy as np
import pytest

from brute import components, shingles
from cadence.llm import ngram_join as nj
from cadence.llm import shingles as sh
from cadence.llm.components import components as joined


def same(got, expect):
    return sorted(map(repr, map(tuple, got))) == sorted(map(repr, expect))


def corpus(rng):
    """Groups of copies and near copies, chains, shared passages, short texts."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for size in (1, 2, 3, 40):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    chain = [word() for _ in range(80)]
    for _ in range(15):
        chain = chain[4:] + [word() for _ in range(4)]
        texts.append(" ".join(chain))
    for _ in range(30):
        texts.append(" ".join([word() for _ in range(rng.randint(3, 40))] + passage))
        texts.append(" ".join([word() for _ in range(rng.randint(0, 8))] + ["common", "line", "of", "many", "texts", "here"]))
        texts.append(" ".join(word()[:2] for _ in range(rng.randint(0, 7))))
    texts += [texts[5]] * 30 + [texts[5].upper(), "A\tb  C\nd\x0be f", "a b c d e f", "\x1ca b c d e f", "", " \n", None]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = corpus(rng)
    ids = rng.sample(range(10 ** 6), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int").repartition(6)
    assert same(nj.join_documents(df).collect(), components(rows))


def test_odd_rows(spark, odd_docs, no_docs):
    assert same(nj.join_documents(odd_docs).collect(), components([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert nj.join_documents(no_docs).collect() == []
    kept = nj.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, 5, None, 6, 7], key=str)  # 4 goes with 3, 8 with 6


def test_one_id_with_two_texts_is_one_document(spark):
    a, b = ("one two three four five six seven", "eight nine ten eleven twelve thirteen")
    df = spark.createDataFrame([(5, a), (5, b), (1, a), (9, b), (2, "else")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in nj.join_documents(df).collect()}
    assert got == {(5, 1), (1, 1), (9, 1), (2, 2)}


def test_shingle_sets():
    texts = ["a b c d e f", "x", "", "A b\tC d e f", "a b c d", "é é é é é é é", "日 b c d e f g h " * 40]
    data = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, data)])
    got = {}
    for a, cuts, h in sh.sets(np.frombuffer(b"".join(data), np.uint8), off, 5):
        for i in range(len(cuts) - 1):
            got[a + i] = set(h[cuts[i]:cuts[i + 1]].tolist())
    assert [len(got[i]) for i in range(len(texts))] == [len(shingles(t)) for t in texts]
    assert got[0] == got[3] and not got[0] & got[4]


def test_filters_never_lose_a_link(spark):
    from pyspark.sql import functions as F
    rng = random.Random(7)
    rows = []
    for _ in range(300):
        pool = list(range(60))
        x = sorted(rng.sample(pool, rng.randint(8, 40)))
        y = sorted(set(x) ^ set(rng.sample(pool, rng.randint(0, 9))))
        both = set(x) & set(y)
        if not both or 4 * len(both) < 3 * len(set(x) | set(y)):
            continue
        first = min(both)
        i, j = x.index(first) + 1, y.index(first) + 1
        assert i <= nj.prefix_length(len(x)) and j <= nj.prefix_length(len(y))
        rows.append((len(x), i, len(y), j))
    assert rows
    df = spark.createDataFrame(rows, "n1 int, p1 int, n2 int, p2 int")
    assert df.where(~nj.may_link(F.col("n1"), F.col("p1"), F.col("n2"), F.col("p2"))).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}
    for _ in range(len(parent)):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    edges = [e for e in edges if e[0] != e[1]]
    got = dict(joined(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: parent[x] for e in edges for x in e}


def test_stage_keeps_columns_of_any_name(spark):
    """Columns named like the operator's own, repeated ids, null ids, no rows."""
    schema = "doc_id long, text string, id long, body string, row string, _place int, _stay long, node long, label string"
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 7, "b", "r", 1, 1, 1, "l"), (2, text, 8, "b", "r", 1, 1, 1, "l"), (2, "z " + text, 8, "c", None, 2, 2, 2, "l"), (3, "other words here", 9, None, "r", 3, 3, 3, None),
            (4, None, 1, "b", "r", 1, 1, 1, "l"), (None, text, 2, "b", "r", 1, 1, 1, "l"), (5, "", 3, "b", "r", 1, 1, 1, "l"), (3, "other words here", 9, None, "r", 3, 3, 3, None)]
    docs = spark.createDataFrame(rows, schema)
    got = nj.one_of_each_group(docs)
    assert got.schema == docs.schema
    assert sorted((r.doc_id or -1, r.id) for r in got.collect()) == [(-1, 2), (1, 7), (3, 9), (4, 1), (5, 3)]
    assert nj.one_of_each_group(docs.limit(0)).collect() == []


def near_copies(seed, count=60, size=130):
    """Copies of a text with several words changed, about half of the pairs below the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    texts = []
    for k in range(count):
        own = list(base)
        for at in rng.sample(range(size), rng.randint(1, 5)):
            own[at] = f"x{k}_{at}"
        texts.append(" ".join(own))
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk", [nj.CHUNK, 3000])
def test_large_group_of_near_copies(spark, monkeypatch, chunk):
    """Blocks of one chunk and of several find all links of a group, and put out a few rows per node, not one per pair."""
    monkeypatch.setattr(nj, "CHUNK", chunk)
    rows, made = near_copies(4), []
    in_blocks = nj.in_blocks

    def counted(members, of_node, work, schema):
        out = in_blocks(members, of_node, work, schema)
        if work is nj.forest:
            made.append((out.count(), members.select("node").distinct().count()))
        return out

    monkeypatch.setattr(nj, "in_blocks", counted)
    assert same(nj.join_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect(), components(rows))
    (links, members), = made
    assert members > nj.FEW and 0 < links < 4 * members < members * (members - 1) / 4


def test_overlaps_and_block_work_against_sets():
    rng = np.random.default_rng(5)
    hashes = lambda k: rng.integers(0, 1 << 64, k, dtype=np.uint64)
    sets, labels = [], []
    for size in (6, 90, 700, 2500):
        base = hashes(size)
        for _ in range(12):
            sets.append(np.unique(np.concatenate([base[rng.random(size) > 0.08], hashes(1 + size // 20)])))
            labels.append(int(rng.integers(0, 20)))
    n, labels, nodes = np.array([len(s) for s in sets], np.int32), np.array(labels), np.arange(len(sets))
    true = [[len(set(s.tolist()) & set(t.tolist())) for t in sets] for s in sets]
    got = nj.overlaps(sets)
    assert all(got[i, j] == true[i][j] for i in nodes for j in nodes if i != j)
    linked = {(i, j) for i in nodes.tolist() for j in nodes.tolist() if i < j and labels[i] != labels[j] and 7 * true[i][j] >= 3 * (int(n[i]) + int(n[j]))}
    reach = set(nj.may_reach(labels, n, nodes, [nj.pressed(nj.ranges(s)) for s in sets])["node"].to_pylist())
    assert {x for p in linked for x in p} <= reach
    tree = nj.forest(labels, n, nodes, [s.tobytes() for s in sets])
    pairs = set(zip(tree["a"].to_pylist(), tree["b"].to_pylist()))
    assert pairs <= linked and len(pairs) < len(sets)


def test_ranges_tell_large_sets_apart():
    """128 ranges let two sets of 8,000 hashes without a common one pass as similar."""
    rng = np.random.default_rng(6)
    x, y = (nj.ranges(rng.integers(0, 1 << 64, 8000, dtype=np.uint64)) for _ in range(2))
    assert 7 * np.minimum(nj.folded(x, 128), nj.folded(y, 128)).sum() >= 3 * 16000
    assert 7 * np.minimum(x, y).sum() < 3 * 16000


def test_sets_are_read_by_one_python_worker_a_task(spark, monkeypatch):
    """Filter and sets of whole texts never share a stage, even if the asked nodes could be broadcast."""
    plans, kept = [], nj.kept

    def seen(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(nj, "kept", seen)
    nj.join_documents(spark.createDataFrame(near_copies(7, 12), "doc_id long, text string")).collect()
    assert plans and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
