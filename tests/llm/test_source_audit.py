"""The source audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cadence.llm import source_audit

SCHEMA = "doc_id long, text string, lang string, source string, docs long, n long, term string, block long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least, top=50):
    docs, counts, groups = Counter(), Counter(), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for (a, t), n in docs.items() if a == lang and n >= least]
        own = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        every = {t: sum(own[s][t] for s in sources) for t in kept}

        def shares(c):
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: shares(own[s]) for s in sources}, shares(every)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, n in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(found)[:n], 1)]
    return sorted(out)


def made(n, seed, langs=("en", "de", None), sources=("a", "b", "c", "é", None), words=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcXYZéß日 ") for _ in range(r.randint(1, 4))) for _ in range(words)]
    joined = [" ", "  ", "\n", ", ", "-", "1", "\t", "　", ".\x00", "'"]
    return [(k, "".join(r.choice(vocabulary) + r.choice(joined) for _ in range(r.randint(0, 40))), r.choice(langs), r.choice(sources), 1, 1, "x", 1)
            for k in range(n)]


@pytest.mark.parametrize("rows,least", [(made(150, 1), 3), (made(150, 2), 30), (made(60, 3, words=5), 8), (made(40, 4, langs=("x",)), 1)])
@pytest.mark.parametrize("block", [1, 1 << 24])
def test_against_plain_counting(spark, rows, least, block, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK_BYTES", block)
    got = sorted(map(tuple, source_audit.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), least_docs=least).collect()))
    assert got == plain(rows, least)


def test_odd_rows(spark):
    rows = [(1, None, "en", "a", 1, 1, "x", 1), (1, "", "en", "b", 1, 1, "x", 1), (2, "... 123 \n", "en", "c", 1, 1, "x", 1), (None, "x", None, None, 1, 1, "x", 1),
            (3, "Word word-word, WORD", "en", "a", 1, 1, "x", 1), (3, "Word word-word, WORD", "en", "a", 1, 1, "x", 1), (4, "long " * 50_000, "en", "b", 1, 1, "x", 1),
            (5, "word", "de", "a", 1, 1, "x", 1), (6, "other", "de", "b", 1, 1, "x", 1)]
    for least in (1, 2, 9):
        got = sorted(map(tuple, source_audit.audit(spark.createDataFrame(rows, SCHEMA), least_docs=least).collect()))
        assert got == plain(rows, least)
    assert source_audit.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_document_counts_once_in_several_chunks(spark):
    rows = [(k, "word (word) word. x" if k % 2 else "WORD", "en", "ab"[k % 2], 1, 1, "x", 1) for k in range(10)]
    assert plain(rows, 11) == sorted(map(tuple, source_audit.audit(spark.createDataFrame(rows, SCHEMA), least_docs=11).collect()))
    assert plain(rows, 10) == sorted(map(tuple, source_audit.audit(spark.createDataFrame(rows, SCHEMA), least_docs=10).collect()))


def test_counts_of_many_rows_stay_whole(spark):
    row = spark.sql("SELECT 30000000000000000 n, 40000000000000000 total, 1000L kinds").withColumn("p", source_audit.share("n", "total", "kinds")).first()
    assert row.p == 1 + 10 ** 9 * (30000000000000000 + 5) // (40000000000000000 + 5000)
