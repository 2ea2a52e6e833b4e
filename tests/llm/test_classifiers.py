import math
import random
import re
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from brute import components
from cadence.llm import nbsvm, packing, queries, toxicity

SMALL, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"  # the larger one has some 3,000 rows to learn from


def test_curve_separates():
    slope, bias = nbsvm.curve(np.array([-2.0, -1, 1, 2]), np.array([-1.0, -1, 1, 1]))
    assert slope > 0 and abs(bias) < 0.1


def test_features_are_whole_texts_and_indicators():
    seen = np.zeros(nbsvm.BUCKETS, bool)
    f = lambda t: set(nbsvm.features(np.frombuffer(t, np.uint8), seen).tolist())
    assert f(b"") == set() and f(b"a") == set() and f(b"abab") == f(b"ababab")
    assert f(b"x " * 5000 + b"zq") - f(b"x " * 5000 + b"z") and not seen.any()
    assert nbsvm.REPEATS in f(b"so so") and nbsvm.REPEATS not in f(b"so do")


def held_out_accuracy(spark, name, label, m, r):
    got = queries.QUERIES[name](spark, LARGER).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas().set_index("doc_id")[label]
    assert got.score.between(0, 1).all() and len(got) == 10000
    assert all(h == (zlib.crc32(str(i).encode()) % m == r) for i, h in got.held_out.items())
    own = got[got.held_out].join(labels, how="inner")
    return (own.predicted == own[label]).mean()


def test_held_out_quality(spark):
    assert held_out_accuracy(spark, "op8_nb_svm_quality", "quality", 4, 2) >= 0.95


def test_held_out_toxicity(spark):
    assert held_out_accuracy(spark, "op10_toxicity_grammar", "toxic", 5, 0) >= 0.95


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1), (4, None), (5, 9)], "doc_id long, quality int")
    from pyspark.sql import functions as F
    model = nbsvm.train(nbsvm.labelled_sample(odd_docs, labels, "quality", F.lit(True), 100))
    got = nbsvm.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    nothing = nbsvm.train(nbsvm.labelled_sample(no_docs, labels, "quality", F.lit(True), 100))
    assert nothing is None and all(r.score == 0.5 for r in nbsvm.score(odd_docs, nothing).collect())
    assert nbsvm.keep_good(odd_docs, model, 0.0).count() == odd_docs.count()
    plain = toxicity.Model({}, {}, toxicity.THREATS)
    assert [r.clauses for r in toxicity.score(odd_docs, plain).collect()] == [0] * odd_docs.count()
    kept = toxicity.keep_clean(odd_docs, plain)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.score(no_docs, plain).collect() == [] and nbsvm.score(no_docs, None).collect() == []


def test_sample_is_bounded_by_rows(spark):
    from pyspark.sql import functions as F
    docs = spark.range(5000).select(F.lit(7).alias("doc_id"), F.col("id").cast("string").alias("text")).unionAll(spark.sql("SELECT 8, 'x'"))
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    got = nbsvm.labelled_sample(docs, labels, "quality", F.lit(True), 3).collect()
    assert sorted(map(tuple, got)) == [(7, "0", 1), (8, "x", 0)]
    assert nbsvm.labelled_sample(docs, labels, "quality", F.lit(True), 1).count() <= 1


def slow_features(text):
    b, out = text.encode(), set()
    out |= {b[i] * 256 + b[i + 1] for i in range(len(b) - 1)}
    out |= {65536 + ((b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) * 2654435761 % 2 ** 32 >> 16) for i in range(len(b) - 2)}
    words = b.split()
    twice = [x == y for x, y in zip(words, words[1:])]
    if any(twice):
        out |= {nbsvm.REPEATS, nbsvm.REPEATS + 2 + min(5, int(8 * sum(twice) / len(twice)))}
        out |= {nbsvm.REPEATS + 1} if any(x and y for x, y in zip(twice, twice[1:])) else set()
    return out


def slow_nb_svm(sets, labels):
    """The classifier's margin function, feature by feature over dictionaries."""
    pos, neg = {}, {}
    for own, y in zip(sets, labels):
        side = pos if y == 1 else neg
        for f in own:
            side[f] = side.get(f, 0) + 1
    p_all, n_all = (nbsvm.BUCKETS + sum(d.values()) for d in (pos, neg))
    ratio = lambda f: math.log((pos.get(f, 0) + 1) / p_all) - math.log((neg.get(f, 0) + 1) / n_all)
    ratios = {f: ratio(f) for own in sets for f in own}

    def fit(rows):
        w, b, alpha = {}, 0.0, {i: 0.0 for i in range(len(rows))}
        order = np.random.default_rng(0)
        for _ in range(nbsvm.EPOCHS):
            for i in order.permutation(len(rows)):
                own, y = sets[rows[i]], 1 if labels[rows[i]] == 1 else -1
                x = {f: ratios[f] / max(1, len(own)) ** 0.5 for f in own}
                gap = y * (sum(w.get(f, 0.0) * v for f, v in x.items()) + b) - 1 + alpha[i] * 0.5 / nbsvm.COST
                new = max(0.0, alpha[i] - gap / (sum(v * v for v in x.values()) + 1 + 0.5 / nbsvm.COST))
                for f, v in x.items():
                    w[f] = w.get(f, 0.0) + (new - alpha[i]) * y * v
                b, alpha[i] = b + (new - alpha[i]) * y, new
        top = max(map(abs, w.values()))
        w = {f: v for f, v in w.items() if abs(v) > 1e-10 * top}
        mean = sum(map(abs, w.values())) / nbsvm.BUCKETS
        mixed = {f: (nbsvm.MIX * v + (1 - nbsvm.MIX) * mean * ((v > 0) - (v < 0))) * ratios[f] for f, v in w.items()}
        return lambda own: sum(mixed.get(f, 0.0) for f in own) / max(1, len(own)) ** 0.5 + b

    margins = [0.0] * len(sets)
    for k in range(3):
        part = fit([i for i in range(len(sets)) if i % 3 != k])
        for i in range(k, len(sets), 3):
            margins[i] = part(sets[i])
    slope, bias = nbsvm.curve(np.array(margins), np.where(np.array(labels) == 1, 1.0, -1.0))
    whole = fit(list(range(len(sets))))
    return lambda own: 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * whole(own) + bias))))


def test_quality_against_slow_version(spark):
    rng = random.Random(3)
    good, bad = "the river runs through green hills and old towns".split(), "buy buy now cheap cheap click win free $$$".split()
    rows = []
    for i in range(60):
        mix = rng.random() < 0.15
        words = (good if (i % 2 == 0) != mix else bad) + ["común", "Wort", "x"]
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) if i != 17 else ""))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows if i < 45], "doc_id long, quality int")
    from pyspark.sql import functions as F
    got = nbsvm.score(docs, nbsvm.train(nbsvm.labelled_sample(docs, labels, "quality", F.lit(True), 100))).collect()
    own = sorted(rows[:45], key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    slow = slow_nb_svm([slow_features(t) for _, t in own], [int(i % 2 == 0) for i, _ in own])
    expect = {i: slow(slow_features(t)) for i, t in rows}
    assert len(got) == 60 and all(abs(r.score - expect[r.doc_id]) < 1e-5 for r in got)


def slow_clause(model, clause):
    """The clause's weight by looking around each insult and threat, without transducers."""
    kinds = [k for k, _ in model.symbols(clause)]
    near = lambda kind, lo, hi: kind in kinds[max(0, lo):max(0, hi)]
    total = 0.0
    for i, (kind, weight) in enumerate(model.symbols(clause)):
        if kind == "threat" and not (near("will", i - 5, i) or near("target", i - 5, i)):
            weight = 0.0
        weight *= 1.5 if near("target", i - 5, i + 6) else 1
        weight *= 0.5 if near("negation", i - 2, i) else 1
        weight *= 0.5 if "speech" in kinds[:i] and kinds[:i].count("quote") % 2 else 1
        total += weight
    return total


def test_grammar_against_slow_version():
    rng = random.Random(4)
    model = toxicity.Model({"fool": 1.0, "clod": 0.4}, {"stupi": 0.7}, toxicity.THREATS)
    words = ["fool", "clod", "stupidly", "kill", "hurt", "you", "they", "will", "not", "never", "said", '"', "“", "”", "a", "tree", "foolish"]
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", ". ", "!", "?!", ";\n", "\n\n"]) for _ in range(rng.randint(0, 60)))
        clauses = [c for c in re.split(r"[.!?;\n]", text.lower()) if slow_clause(model, c) > 0]
        found = model.matched(text)
        assert [text[a:b].lower() for a, b, _ in found] == clauses
        assert [w for _, _, w in found] == pytest.approx([slow_clause(model, c) for c in clauses])


def test_long_text_of_many_matches_is_read_once():
    model = toxicity.Model({"fool": 1.0}, {}, {})
    began = time.perf_counter()
    assert len(model.matched("you fool. " * 200_000)) == 200_000
    assert time.perf_counter() - began < 30


@pytest.fixture(scope="module")
def grammar():
    return toxicity.Model({"idiot": 1.0}, {"lowei": 0.8}, toxicity.THREATS)


@pytest.mark.parametrize("stronger, weaker", [
    ("you are an idiot", "some idiot"), ("an idiot, you", "an idiot"), ("an idiot", "not an idiot"), ("he said an idiot", 'he said "an idiot"'),
    ("I will kill you", "kill the light"), ("loweixyz and idiot", "loweixyz"), ("you idiot", "you")])
def test_clauses(grammar, stronger, weaker):
    assert grammar.clause_weight(stronger) > grammar.clause_weight(weaker)


def test_matched_clauses(grammar):
    text = "Fine day. You Idiot! Then; loweiabc\nidiotic"
    assert [text[a:b].strip() for a, b, _ in grammar.matched(text)] == ["You Idiot", "loweiabc"]
    assert grammar.matched("") == []


def test_lexicon_is_learnt():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    clean = [" ".join(word() for _ in range(30)) for _ in range(300)]
    toxic = [" ".join([*(word() for _ in range(20)), "zonk" if k % 2 else "xyzz" + word()]) for k in range(60)]
    m = toxicity.fit(clean + toxic + [toxic[0]] * 20, [0] * 300 + [1] * 80)
    assert "zonk" in m.words and any("xyzz".startswith(b[:4]) for b in m.beginnings)
    score = lambda t: m.score([c[2] for c in m.matched(t)])
    assert score("a new zonk here") > 0.5 and score("xyzzqqq") > 0.5 and score("a b c") < 0.5
    assert toxicity.Model.load(m.dump()).dump() == m.dump()


def test_pipeline_against_plain_steps(spark):
    import pandas as pd
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    crc = lambda i: zlib.crc32(str(i).encode())
    own = [(i, text[i], t) for i, t in zip(labels.doc_id, labels.toxic) if i in text and crc(i) % 5 != 0]
    tox = toxicity.fit([x[1] for x in sorted(own)], [x[2] for x in sorted(own)])
    left = {i: t for i, t in text.items() if tox.score([c[2] for c in tox.matched(t or "")]) < 0.5}
    seen = np.zeros(nbsvm.BUCKETS, bool)
    features = lambda t: nbsvm.features(np.frombuffer((t or "").encode(), np.uint8), seen)
    own = sorted(((crc(i), i, q) for i, q in zip(labels.doc_id, labels.quality) if i in left and crc(i) % 4 != 2))
    good = nbsvm.fit([features(left[i]) for _, i, _ in own], np.array([q for *_, q in own]))
    left = {i: t for i, t in left.items() if good.score(features(t)) >= 0.7}
    left = {i: left[i] for i, _, c in components(sorted(left.items())) if c == i}
    got = cp.run(spark, SMALL).toPandas()
    assert set(got.doc_id) == set(left) and [n for n, _ in cp.STAGES] == ["toxicity", "quality_classifier", "ngram_jaccard_join", "best_fit_packing"]
    import public_tokenizers as P
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        cache = packing.tokenizer_cache(f.read(), P.PATTERN)
    sizes = pd.Series({i: len(cache(t or "")) // 4 + 1 for i, t in left.items()})
    assert (got.groupby("doc_id").length.sum() == sizes.sort_index()).all()
    assert (got.groupby("sequence_id").length.sum() <= 1024).all()
