"""The registered queries against brute force on the small tables, and their SQL where there is one."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from quern.llm import queries, quality
from tests.compare import database, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def result(spark, sf_dir, n):
    name = next(k for k in queries.QUERIES if k.startswith(f"op{n}_"))
    return queries.QUERIES[name](spark, sf_dir)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), database(sf_dir), queries.ORACLES[name])


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def test_op1(spark, sf_dir, docs):
    found = {r.doc_id: r for r in result(spark, sf_dir, 1).collect()}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        base = base_spans(text)
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert found[i].base_sha256 == sha(",".join(listed))
        assert set(listed) <= set(found[i].spans.split(","))
        assert [found[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
    assert len(found) == len(docs)


def llr(docs, trusted, buckets=quality.BUCKETS):
    """Scores of all documents, counted in plain loops."""

    def grams(text):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(hashes, hashes[1:], strict=False)]
        return [(h - (1 << 64) if h >> 63 else h) % buckets for h in hashes + pairs]

    raw, target, each = Counter(), Counter(), {}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        each[i] = grams(text)
        raw.update(each[i])
        if i in trusted:
            target.update(each[i])
    share = sum(target.values()) / sum(raw.values())
    weight = {b: np.log((target[b] + quality.SMOOTHING) / (n * share + quality.SMOOTHING)) for b, n in raw.items()}
    return {i: sum(weight[b] for b in g) / len(g) if g else 0.0 for i, g in each.items()}


def test_op2(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # a corpus that tells clean text from junk
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    scores = llr(docs, set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id))
    found = {r.doc_id: r for r in result(spark, sf_dir, 2).collect()}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert (r.n_symbols, r.n_dup_lines) == (sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert abs(r.llr - scores[i]) < 1e-5
        assert r.kept == (not r.base_failed and scores[i] >= quality.THRESHOLD)
    bad = set(labels[labels.quality == 0].doc_id)
    assert not any(found[i].kept for i in bad)
    clean = [found[i] for i in labels[labels.quality == 1].doc_id if not found[i].base_failed]
    assert all(r.kept for r in clean)


def test_op3(spark, sf_dir, docs):
    found = result(spark, sf_dir, 3).toPandas().merge(docs, on="doc_id")
    assert len(found) == len(docs)
    assert (found["size"] == found.text.map(lambda t: len(WORD.findall(t)))).all()
    sizes = found.groupby("source")["size"].sum().sort_index()
    weights = dict(zip(sizes.index, [3, 1, 2] * len(sizes), strict=False))
    capped, goal = set(), {}
    while True:
        rest = 1.5 * sizes.sum() - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in sizes.index if s not in capped]
        goal = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if goal[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for source, rows in found.groupby("source"):
        target = 2 * sizes[source] if source in capped else goal[source]
        assert (rows.source_size == sizes[source]).all() and np.allclose(rows.target, target)
        passes, sums = int(target + 0.5) // sizes[source], {0}
        for n in rows["size"] if passes < 2 else []:
            sums |= {a + n for a in sums}
        assert rows.taken.sum() == passes * sizes[source] + max(a for a in sums if a <= int(target + 0.5) - passes * sizes[source])
    assert (found.taken <= 2 * found["size"]).all()
    again = result(spark, sf_dir, 3).toPandas()
    assert dict(zip(again.doc_id, again.taken, strict=True)) == dict(zip(found.doc_id, found.taken, strict=True))


def test_op4(spark, sf_dir, docs):
    rows = result(spark, sf_dir, 4).toPandas()
    assert len(rows) == len(docs) and set(rows["shard"]) <= set(range(24)) and set(rows["law"]) == {"key"}
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    moved = rows[rows["shard"] != rows.grown_shard]
    assert len(moved) and set(moved.grown_shard) == {24}


def test_op5(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.array(vectors.embedding.tolist(), np.float64), vectors.vec_id.to_numpy()
    found, hits, wanted = defaultdict(list), 0, 0
    for r in result(spark, sf_dir, 5).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    for k in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[k]
        best = [j for j in np.lexsort((ids, -scores)) if j != k][:20]
        rows = found[ids[k]]
        assert [r["rank"] for r in rows] == list(range(1, 21))
        at = {int(i): s for i, s in zip(ids, scores, strict=True)}
        assert all(abs(r.score - at[r.vec_id]) < 1e-12 for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits, wanted = hits + len({r.vec_id for r in rows} & set(ids[best])), wanted + 20
    assert hits / wanted >= 0.9


def test_op6(spark, sf_dir, docs, library):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in result(spark, sf_dir, 6).collect()}
    for i, text, coded in zip(docs.doc_id, docs.text, library.encode_batch(docs.text.tolist(), add_special_tokens=False), strict=True):
        assert found[i] == (len(text.encode()), len(coded.ids), len(coded.ids) > 2048)


def test_op8(spark, sf_dir, docs, library):
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in result(spark, sf_dir, 8).collect()}
    for i, coded in zip(docs.doc_id, library.encode_batch(docs.text.tolist(), add_special_tokens=False), strict=True):
        assert found[i] == (len(coded.ids), sha(" ".join(map(str, coded.ids))), sha(library.decode(coded.ids, skip_special_tokens=False)))


def test_op9(spark, sf_dir, docs):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = {r.doc_id: r for r in result(spark, sf_dir, 9).collect()}
    some = 0
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = sorted((k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = found[i]
        some += len(places)
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert some


def test_op10(spark, sf_dir, docs):
    prints = []
    for text in docs.text:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = dict(zip(docs.doc_id, docs.doc_id, strict=True))
    changed = True
    ids = docs.doc_id.tolist()
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    while changed:
        changed = False
        for a, b in near:
            low = min(root[ids[a]], root[ids[b]])
            changed |= root[ids[a]] != low or root[ids[b]] != low
            root[ids[a]] = root[ids[b]] = low
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in result(spark, sf_dir, 10).collect()}
    assert found == {i: (format(p, "016x"), root[i]) for i, p in zip(ids, prints, strict=True)}
