import hashlib
import random

import numpy as np

from cadence.llm import syncmers as sy


def plain_anchors(data: bytes):
    h = [int(sy.mix(np.array([int.from_bytes(data[i:i + sy.S], "little")], np.uint64))[0]) for i in range(len(data) - sy.S + 1)]
    w = sy.K - sy.S + 1
    return [i for i in range(len(data) - sy.K + 1) if min(h[i:i + w]) in (h[i], h[i + w - 1])]


def test_anchors_are_closed_syncmers():
    rng = random.Random(1)
    for n in (0, 5, 15, 16, 17, 40, 300):
        data = bytes(rng.choice(b"abcde ") for _ in range(n))
        assert sy.anchors(np.frombuffer(data, np.uint8))[1].tolist() == plain_anchors(data)


def test_anchors_do_not_depend_on_context():
    rng = random.Random(2)
    middle = bytes(rng.choice(b"abcdefgh ") for _ in range(400))
    a = np.frombuffer(b"x" * 7 + middle + b"yy", np.uint8)
    own, inside = sy.anchors(np.frombuffer(middle, np.uint8)), sy.anchors(a)
    assert set(zip(own[0].tolist(), own[1].tolist())) <= {(h, i - 7) for h, i in zip(*(x.tolist() for x in inside))}


def test_windows_do_not_change_fingerprints(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(n)) for n in (0, 3, 16, 900, 17, 5000)]
    whole = sy.fingerprints(texts)
    monkeypatch.setattr(sy, "WINDOW", 64)
    assert sy.fingerprints(texts) == whole
    assert [sy.fingerprints([t])[0] for t in texts] == whole


def test_likeness():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    near = text[:1500] + "inserted words" + text[1500:]
    far = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    swapped = text[1500:] + text[:1500]
    f = sy.fingerprints([x.encode() for x in (text, near, far, swapped, "")])
    assert sy.likeness(f[0], f[0]) == 1 and sy.likeness(f[4], f[4]) == 1
    assert sy.likeness(f[0], f[1]) > 0.8 and sy.likeness(f[0], f[2]) < 0.1 and sy.likeness(f[0], f[4]) == 0
    assert sy.likeness(f[0], f[3]) < 0.8  # the same anchors in another order
    assert sy.likeness(f[0], f[1]) == sy.likeness(f[1], f[0])


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] if r[0] is not None else sy.LEAST, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        e = sy.edited_text(t, after)
        a, b, c = sy.fingerprints([t.encode(), e.encode(), after.encode()])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), sy.shown(a), sy.shown(b), sy.likeness(a, b), sy.likeness(a, c)))
    return out


def test_query_against_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(5)
    more = [(rng.randrange(10 ** 9), "".join(rng.choice("abc déf ") for _ in range(rng.randrange(0, 200)))) for _ in range(300)]
    df = spark.createDataFrame(more, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sy.fingerprint_edits(df.repartition(5)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))
    one = spark.createDataFrame([(9, "only one text stands here")], "doc_id long, text string")
    assert [tuple(r) for r in sy.fingerprint_edits(one).collect()] == brute([(9, "only one text stands here")])
    assert sy.fingerprint_edits(no_docs).collect() == []


def test_fingerprints_keep_every_anchor():
    rng = random.Random(6)
    for n in (24, 300, 9000):
        data = bytes(rng.choice(b"abcdefgh ") for _ in range(n)) + b"again " * 40
        f = sy.fingerprints([data])[0]
        assert np.cumsum(list(f.steps)).tolist() == plain_anchors(data)
        assert np.frombuffer(f.hashes, "<u4").tolist() == sy.anchors(np.frombuffer(data, np.uint8))[0].tolist()
    quiet = [t for t in (bytes(rng.choice(b"abcdefgh ") for _ in range(16)) for _ in range(50)) if not plain_anchors(t)][:2]
    f = sy.fingerprints(quiet)
    assert sy.likeness(*f) == 0 and sy.shown(f[0]) != sy.shown(f[1])


def test_a_passage_in_a_long_text_always_shows():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(5000)]
    text = " ".join(rng.choice(words) for _ in range(20000)).encode()
    own = sy.fingerprints([text])[0]
    for _ in range(20):
        at = rng.randrange(len(text) - 300)
        other = sy.fingerprints([text[:at] + bytes(rng.choice(b"abcdefghijklmnop ") for _ in range(300)) + text[at + 300:]])[0]
        assert sy.shown(other) != sy.shown(own) and 0.99 < sy.likeness(own, other) < 1
    passage = text[60000:60400]
    pair = sy.fingerprints([" ".join(rng.choice(words)[::-1] for _ in range(4000)).encode() + passage for _ in range(2)])
    assert sy.likeness(*pair) > 0


def plain_chain(x, y):
    line = [0] * (len(y) + 1)
    for v in x:
        before, line = line, [0]
        for j, w in enumerate(y):
            line.append(before[j] + 1 if v == w else max(before[j + 1], line[-1]))
    return line[-1]


def test_chain_is_the_longest_common_subsequence(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(sy, "STRIP", 16)
    for _ in range(600):
        kinds = rng.choice([2, 5, 30, 1000])
        x = [rng.randrange(kinds) for _ in range(rng.randrange(70))]
        y = [v for v in x if rng.random() < 0.8] if rng.random() < 0.5 else [rng.randrange(kinds) for _ in range(rng.randrange(70))]
        got = sy.chain(np.array(x, "<u4"), np.array(y, "<u4"))
        assert got == plain_chain(x, y)
