"""The divergence audit against plain loops on odd rows (the query itself is held against its SQL), and its tallies."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quern.llm import divergence


def brute_force(rows, least, top):
    """Every group's ranked pairs and terms, by the formula alone."""
    found, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(c.lower() if c < "\x80" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        found[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]
        p = {}
        for name, count in [*((s, found[lang, s]) for s in sources), (None, sum((found[lang, s] for s in sources), Counter()))]:
            n = sum(count[t] for t in kept)
            p[name] = {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}
        f = lambda a, b, t: (p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t])
        pairs = [(-sum(f(source, s, t) for t in kept), s.encode()) for s in sources if s != source]
        terms = [(-f(source, None, t), t.encode()) for t in kept if found[lang, source][t] and p[source][t] > p[None][t]]
        for part, listed, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(sorted(listed)[:most])]
    return sorted(out)


def test_odd_rows(spark):
    words = "alpha Beta GAMMA été Été 日本 \U0001f600 a-b ÀÀ zz".split()
    rng = np.random.default_rng(4)
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), ["en", "de", None, ""][k % 4], ["s1", "s2", None, "s10", "é"][k % 5]) for k in range(200)]
    rows += [(None, "fr", "s1"), ("", "fr", "s2"), ("once only", "fr", None), ("1 2 3", "xx", "s1"), *[("alpha alpha", "en", "s1")] * 30, ("tail " * 200_000, "en", "s2")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS n", "'x' AS term", "2 AS rank", "3 AS VALUE")
    found = sorted(tuple(r) for r in divergence.audit(docs, least=5, top=4).collect())
    assert found == brute_force(rows, 5, 4)
    assert ("fr", "s1", "pair", "s2", 0, 2) in found and not [r for r in found if r[:3] == ("xx", "s1", "pair")]
    assert divergence.audit(docs.limit(0)).count() == 0


def test_tallies_in_small_steps(monkeypatch):
    rng = np.random.default_rng(2)
    lists = [[{"source": str(s), "n": int(rng.integers(1, 4))} for s in rng.permutation(12)[: rng.integers(0, 12)]] for _ in range(300)]
    langs = [str(k % 3) for k in range(300)]
    kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
    table = pa.table({"lang": langs, "sources": pa.array(lists, kind)})
    expected = Counter()
    for lang, own in zip(langs, lists, strict=True):
        own = sorted(own, key=lambda x: x["source"])
        expected.update((lang, x["source"], y["source"], x["n"], y["n"]) for i, x in enumerate(own) for y in own[i + 1 :])
    for pairs, held in ((1 << 18, 1 << 18), (7, 50)):
        monkeypatch.setattr(divergence, "PAIRS", pairs)
        monkeypatch.setattr(divergence, "HELD", held)
        found = Counter()
        for b in divergence.joint_counts(iter(table.to_batches(max_chunksize=64))):
            for r in b.to_pylist():
                found[r["lang"], r["a"], r["b"], r["c"], r["d"]] += r["m"]
        assert found == expected


def test_large_counts_are_exact(spark):
    p = divergence.probability(F.col("c"), F.col("n"), F.col("v"))
    row = spark.createDataFrame([(10**17, 10**18, 10**6)], "c long, n long, v long").select(p.alias("p")).first()
    assert row.p == 1 + 10**9 * (10**17 + 2) // (10**18 + 2 * 10**6)
