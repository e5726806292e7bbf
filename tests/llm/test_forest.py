"""The LSH forest against brute force: the query, groups too large for a task, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import forest, queries


def shingle_set(text, words=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}


def brute_force(ids, texts, words=4):
    sets, group = [shingle_set(t, words) for t in texts], list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    least = {x: min(i for i, g in zip(ids, group, strict=True) if g == x) for x in set(group)}
    return {i: (len(s), least[g], i == least[g]) for i, s, g in zip(ids, sets, group, strict=True)}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_force([r.doc_id for r in rows], [r.text for r in rows])
    assert found(queries.QUERIES["op12_lsh_forest"](spark, sf_dir)) == expected
    assert sum(not kept for _, _, kept in expected.values()) > 20


def crowd():
    """Near copies of one text, a chain whose ends differ, texts that share a passage, and a few far from a crowd but near one of it."""
    rng = random.Random(3)
    texts, base = [], [f"w{k}" for k in range(60)]
    for _ in range(120):
        t = base.copy()
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(t))
    t = [f"c{k}" for k in range(60)]
    for k in range(60):
        t = t.copy()
        t[k] = f"d{k}"
        texts.append(" ".join(t))
    for k in range(40):
        texts.append(" ".join([*base[:40], *[f"y{k}_{j}" for j in range(rng.choice([8, 14, 30]))]]))
    for k in range(25):
        texts.append(" ".join([*base[: 60 - 2 * (k % 6)], *[f"z{k}_{j}" for j in range(k % 6)]]))
    return rng.sample(range(1000), len(texts)), texts


@pytest.mark.parametrize("held", [1 << 20, 3000, 600])
def test_groups_too_large_for_a_task_lose_no_link(spark, held):
    ids, texts = crowd()
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    assert found(forest.near_duplicates(docs, held=held)) == brute_force(ids, texts)


def test_exact_units_find_every_link_between_labels(spark):
    """Without any help of the forest: every set is its own label, so all links have to come from the rare shingles."""
    ids, texts = crowd()
    sets = [forest.shingles(t).view(np.int64) for t in texts]
    rows = {int(np.bitwise_xor.reduce(s)): s.tolist() for s in sets}
    shingled = spark.createDataFrame(list(rows.items()), "key long, shingles array<long>").cache()
    members = shingled.select("key", F.size("shingles").cast("long").alias("n"), F.lit(0).alias("root"), F.col("key").alias("label"))
    expected = {frozenset((a, b)) for a in rows for b in rows if a < b and 100 * len(x := set(rows[a]) & set(rows[b])) >= 80 * (len(rows[a]) + len(rows[b]) - len(x))}
    for held in (1 << 20, 2000):
        units = forest.prefix_units(members, shingled, 80, held).groupBy("unit").agg(F.collect_set("key").alias("keys")).collect()
        together = {frozenset((a, b)) for u in units for a in u["keys"] for b in u["keys"] if a < b}
        assert expected <= together
    assert len(together) < len(rows) ** 2 / 2


def test_signatures_are_minima():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 20_000, np.uint64))
    whole = [min((int(f) * int(h) + int(c)) % (1 << 64) for h in a[:500]) & 0xFFFFFFFF for f, c in zip(forest._FACTORS[:5], forest._ADDED[:5], strict=True)]
    assert forest.minima(a[:500])[:5].view(np.uint32).tolist() == whole
    agree = np.mean([np.mean(forest.minima(x := np.unique(rng.integers(0, 1 << 63, 1000, np.uint64))) == forest.minima(x[:800])) for _ in range(20)])
    assert 0.75 < agree < 0.85


def test_odd_rows(spark):
    base = " ".join(f"w{k}" for k in range(100))
    data = [(3, base, "a"), (2, base.replace("w0 ", "x "), "b"), (5, None, "c"), (4, "", "d"), (6, " \n", "e"), (None, base.upper(), "f"), (None, "no id", "g"), (None, "no id", "h"), (7, "too short", "i"), (8, "Too\tshort", "j"), (2, base.replace("w0 ", "x "), "k"), (None, None, "l"), (9, "long " + " ".join(map(str, range(200_000))), "m")]
    docs = spark.createDataFrame(data, "doc_id long, text string, key string").selectExpr("*", "1 AS KEPT", "map(1, 2) AS minima", "2 AS root", "'n' AS n", "0 AS id", "1 AS th")
    out = forest.near_duplicates(docs)
    assert out.columns == ["doc_id", "key", "minima", "root", "n", "id", "th", "n_shingles", "component_id", "kept"]
    rows = {r["key"]: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    assert rows == {"a": (97, 2, False), "b": (97, 2, True), "c": (0, 5, True), "d": (0, 4, True), "e": (0, 6, True), "f": (97, 2, False), "g": (1, None, False), "h": (1, None, False), "i": (1, 7, True), "j": (1, 7, False), "k": (97, 2, True), "l": (0, None, False), "m": (199_998, 9, True)}
    assert forest.near_duplicates(docs.limit(0)).count() == 0
