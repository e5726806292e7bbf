"""Periodic runs against brute force over every period, and the query against its contract."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quern.llm import queries, runs


def brute_force(words):
    """(start, length, period) of every run, by start and period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items()) if found else []


def collapsed(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_runs_of_any_words_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = [[rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 90))] for _ in range(rng.randint(1, 5))]
        texts = [runs.wrapped(np.array(t, np.int32), rng.randrange(10**6)).tolist() if rng.random() < 0.6 else t for t in texts]
        starts = np.r_[0, np.cumsum([len(t) for t in texts])]
        found, owner = runs.find(np.array(sum(texts, []), np.int32), starts)
        for k, t in enumerate(texts):
            mine = [(s - starts[k], e - s, p) for (s, e, p), o in zip(found.tolist(), owner.tolist(), strict=True) if o == k]
            assert sorted(mine) == sorted(brute_force(t)) and [(s, p) for s, _, p in mine] == sorted((s, p) for s, _, p in mine)


def test_fibonacci_words_and_long_repetitions():
    a, b = [1], [1, 0]
    while len(b) < 300:
        a, b = b, b + a
    found, _ = runs.find(np.array(b, np.int32), np.array([0, len(b)]))
    assert sorted((s, e - s, p) for s, e, p in found.tolist()) == sorted(brute_force(b))
    n = 200_000  # all words equal, and one period of half the text
    assert runs.find(np.zeros(n, np.int32), np.array([0, n]))[0].tolist() == [[0, n, 1]]
    half = np.arange(n // 2, dtype=np.int32)
    assert runs.find(np.r_[half, half], np.array([0, n]))[0].tolist() == [[0, n, n // 2]]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    found = {r.doc_id: r for r in queries.QUERIES["op11_word_runs"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    sha, some = lambda t: hashlib.sha256(t.encode()).hexdigest(), 0
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        words = planted([w.decode() for w in text.encode().split()], i)
        if len(words) > 3000 and i % 4:
            continue  # brute force is slow
        listed = sorted(brute_force(words), key=lambda r: (r[0], r[2]))
        best = max(listed, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = found[i]
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (len(listed), sha("".join(f"{s},{n},{q}\n" for s, n, q in listed)), sha(collapsed(words, listed)))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        some += bool(best)
    assert some > 10


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (3, " \n\t"), (4, "a " * 40), (5, "x y z " * 9 + "end"), (None, "b " * 13), (6, "é\x85 " * 12), (7, "w " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS RUNS", "2 AS collapsed", "3 AS best", "4 AS turn")
    out = runs.with_runs(docs)
    assert sorted(c.lower() for c in out.columns) == ["best", "collapsed", "doc_id", "runs", "text", "turn"]
    found = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()))
    assert found == [(0, [(0, 13, 1)], "b"), (1, [], ""), (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 40, 1)], "a"), (5, [(0, 27, 3)], "x y z end"), (6, [(0, 12, 1)], "é\x85"), (7, [(0, 400_000, 1)], "w")]
    assert runs.with_runs(docs.limit(0)).count() == 0
    assert runs.digests(runs.with_runs(docs, turn=runs.planted_turn(F.col("doc_id")))).where("doc_id is null").first().n_runs == 1
