"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import bpe, licenses, mixing, pii, pii_examples, preferences, quality, sharding, simhash, token_counts, vectors

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "word " * 30_000 + "x" * 100_000
TEXTS = [None, "", " \n\t", "one", "a b", LONG, "same text here", "same text here", "Über ßtraße 日本 😀 <|endoftext|>", "\x00\x1c\x85 nul"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for results or in between.
CLASHES = ["size", "spans", "fingerprint", "component_id", "kept", "n_words", "token_ids", "decoded", "licenses", "slot", "shard", "n", "row", "word", "fp", "least", "target", "copies", "n_tokens", "words", "value"]


def rows():
    out = [(k, t, "en", f"s{k % 3}" if k % 4 else None, len(t or "")) for k, t in enumerate(TEXTS)]
    return [*out, out[3], out[3], (None, "no id", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.selectExpr("*", *[f"'theirs' AS {c}" for c in CLASHES]).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "pii": lambda d: pii.find_in(d),
    "redacted": lambda d: pii.redacted(d),
    "quality": lambda d: quality.score(d, d.sparkSession.createDataFrame([(3,), (4,), (None,)], "doc_id long")),
    "mixing": lambda d: mixing.mix(d),
    "sharding": lambda d: sharding.shard_documents(d, sharding.Tree(24)),
    "token_counts": lambda d: token_counts.count_tokens(d, PATH),
    "bpe": lambda d: bpe.decode(bpe.encode(d, PATH), PATH),
    "round_trip": lambda d: bpe.round_trip(d, PATH),
    "licenses": lambda d: licenses.scan_documents(d),
    "simhash": lambda d: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_stays_whatever_it_holds(odd, none, name):
    out = OPERATORS[name](odd)
    assert len(out.columns) == len({c.lower() for c in out.columns})
    assert not [c for c in out.columns if c.startswith("__q_")]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in rows())
    assert OPERATORS[name](none).count() == 0


def test_kept_and_mixed_and_deduplicated_rows_keep_their_columns(odd, none, spark):
    trusted = spark.createDataFrame([(3,)], "doc_id long")
    for make in (lambda d: quality.kept_documents(d, trusted), simhash.one_of_each, mixing.mixture):
        assert make(odd).columns == odd.columns and make(none).count() == 0
        assert all(r["size"] == "theirs" for r in make(odd).collect())
    assert sorted(r.doc_id for r in simhash.one_of_each(odd).collect() if r.doc_id in (6, 7)) == [6]


def test_bpe_agrees_with_the_library_on_any_text():
    library, rng = Tokenizer.from_file(PATH), random.Random(3)
    letters = "abcdeéßΣσςİ'’s<|endoftext|>019 ²½́‍\n\t\x1c\x85\xa0 日本😀-_."
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|><|startoftext|>", "aaaa" * 500, "".join(rng.choice("abcdefghij") for _ in range(20_000)), ""]
    ids, lens = bpe.encoder_from(PATH).encode(texts)
    ends = np.cumsum(lens)
    for k, coded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        mine = ids[ends[k] - lens[k] : ends[k]]
        assert mine.tolist() == coded.ids
        assert bpe.bpe_from(PATH).decode(mine) == library.decode(coded.ids, skip_special_tokens=False)


def test_token_counts_without_frequent_pre_tokens(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    texts = [t or "" for t in TEXTS]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}
    coded = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert found == {k: len(c.ids) for k, c in enumerate(coded)}


def test_token_counts_of_a_hot_word_outside_the_first_documents_and_of_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SAMPLED", 20)
    long = "x" * 40
    texts = [f"früh{k} only here" for k in range(300)] + [f"späterwort {long} " * 50 + f"zahl{k}" for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}
    coded = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert found == {k: len(c.ids) for k, c in enumerate(coded)}


def test_subset_sums_are_the_largest_within_the_budget():
    rng = random.Random(4)
    for _ in range(300):
        sizes = np.array(rng.sample(range(1, 25), rng.randint(1, 4)))
        left, budget = np.array([rng.randint(0, 3) for _ in sizes]), rng.randint(0, 60)
        sums = {0}
        for s, n in zip(sizes, left, strict=True):
            sums = {a + int(s) * k for a in sums for k in range(n + 1)}
        for take in (mixing.subset_sum(sizes, left, budget), mixing.fit(sizes, left, budget)):
            assert (take <= left).all() and (take >= 0).all()
            assert int((take * sizes).sum()) <= budget
        assert int((mixing.subset_sum(sizes, left, budget) * sizes).sum()) == max(s for s in sums if s <= budget)


def test_shortfalls_are_filled_at_every_size(monkeypatch):
    monkeypatch.setattr(mixing, "WINDOW", 32)
    rng = random.Random(12)
    for _ in range(200):
        sizes = np.array(rng.sample(range(20, 90), rng.randint(2, 4)))
        left = np.array([rng.randint(1, 30) for _ in sizes])
        budget = rng.randint(1, int((sizes * left).sum()))
        sums = 1  # bit n: n words can be had
        for s, n in zip(sizes, left, strict=True):
            for _ in range(n):
                sums |= sums << int(s)
        take = mixing.fit(sizes, left, budget)
        assert (take <= left).all() and (take >= 0).all()
        assert int((take * sizes).sum()) == (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1


def test_a_shortfall_that_nothing_fills_costs_little():
    take = mixing.fit(np.array([1000, 1001]), np.array([10_000_000, 1]), 5_000_000_500)  # only 0 and 1 beyond a multiple of 1,000
    assert int((take * np.array([1000, 1001])).sum()) == 5_000_000_001


def test_residues_fill_what_no_window_may(monkeypatch):
    monkeypatch.setattr(mixing, "WINDOW", 16)
    monkeypatch.setattr(mixing, "LARGEST_WINDOW", 32)
    rng = random.Random(21)
    for _ in range(200):
        sizes = np.array(rng.sample(range(5, 60), rng.randint(2, 4)))
        left = np.array([400, *[rng.randint(1, 6) for _ in sizes[1:]]])
        budget = int((sizes * left).sum() * rng.uniform(0.4, 0.6))
        sums = 1
        for s, n in zip(sizes, left, strict=True):
            for _ in range(n):
                sums |= sums << int(s)
        take = mixing.fit(sizes, left, budget)
        assert (take <= left).all() and (take >= 0).all()
        assert int((take * sizes).sum()) == (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1


@pytest.mark.parametrize("outlier", [1001, 100_001, 3_000_001])
def test_a_long_text_among_equal_ones_takes_little_memory(outlier):
    tracemalloc.start()
    sizes = np.array([1000, outlier])
    take = mixing.fit(sizes, np.array([10_000_000, 1]), 5_000_000_500)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int((take * sizes).sum()) == 5_000_000_001 and most < 64e6


def test_words_of_any_length_take_bounded_memory():
    rng = random.Random(8)
    field = pii.default_field()
    field.words = None
    word = lambda n: "".join(rng.choice("aZ0+/=.") for _ in range(n))
    texts = [" ".join(word(10_000) for _ in range(20)) for _ in range(20)]
    for t in texts:
        pii.tag([t], field)
    held = sum(len(w or "") for w in field.words) + sum(len(k if isinstance(k, bytes) else k[0]) for k in field.words.facts if k)
    assert len(field.words.facts) > 300 and held < 40_000
    again, field.words = [pii.tag([t], field) for t in texts], None
    assert again == [pii.tag([t], field) for t in texts]


def test_mix_of_rows_that_differ_in_other_columns_alone(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", k) for k in range(40)], "doc_id long, text string, source string, k int")
    runs = [sorted(r.k for r in mixing.mixture(d).collect()) for d in (docs, docs.repartition(7), docs.orderBy(F.desc("k")))]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 60


def test_mixing_targets_with_hot_empty_and_null_sources(spark):
    data = [(k, "w " * 10, "hot") for k in range(300)] + [(k, "w " * (k % 7), None) for k in range(300, 360)] + [(900, "", "empty"), (901, None, "empty")]
    out = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string")).toPandas()
    assert len(out) == len(data)
    assert out.groupby("source", dropna=False).target.first().sum() == pytest.approx(1.5 * out["size"].sum())
    for source, rows_ in out.groupby("source", dropna=False):
        assert abs(rows_.taken.sum() - rows_.target.iloc[0]) <= 10, source




def test_weights_draw_their_share_and_confine_movement(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    even = sharding.Tree(8, 2, 2)
    heavy = sharding.Tree(8, 2, 2, (3.0, *[1.0] * 7))
    shards = [{r.doc_id: r.shard for r in sharding.place(docs, t).select("doc_id", "shard").collect()} for t in (even, heavy)]
    assert abs(sum(s == 0 for s in shards[1].values()) / 6000 - 0.3) < 0.03
    moved = [(a, shards[1][k]) for k, a in shards[0].items() if a != shards[1][k]]
    assert moved and all(b // 4 == 0 for _, b in moved)  # only into the region whose weight grew


def brute(points):
    label = list(range(len(points)))
    for a in range(len(points)):
        for b in range(a):
            if (int(points[a]) ^ int(points[b])).bit_count() <= 3:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize("crowded", [False, True])
def test_the_forest_finds_every_link(spark, crowded):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 1 << 63, 3 if crowded else 150, np.uint64)
    points = []
    for c in centres:
        for _ in range(180 if crowded else 4):
            p = int(c)
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                p ^= 1 << int(b)
            points.append(p)
    points = np.array(sorted(set(points)), np.uint64)
    expected = brute(points)
    trees = simhash.fit(points[:: 2], 16)
    assert trees[0][1] > 1
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    groups = {}
    for p, e in zip(points.view(np.int64).tolist(), expected, strict=True):
        groups.setdefault(e, set()).add(root.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_one_of_each_component_stays_even_where_ids_repeat(spark):
    data = [(1, "a b c d"), (1, "a b c d"), (1, "z y x w"), (None, "q r s t u"), (None, "q r s t u"), (2, "A b c d"), (7, "m n o p"), (None, "m n o p")]
    kept = simhash.one_of_each(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("1", "a b c d"), ("1", "z y x w"), ("7", "m n o p"), ("None", "q r s t u"), ("None", "q r s t u")]


def test_empty_texts_link_to_each_other(spark):
    docs = spark.createDataFrame([(5, None), (3, ""), (4, " "), (1, "a b c d")], "doc_id long, text string")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect() if r.doc_id > 1} == {5: (0, 3), 3: (0, 3), 4: (0, 3)}
    assert simhash.fingerprint("A b") == simhash.fingerprint("a  B\n") != 0
    assert simhash.fingerprint("a b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_the_field_finds_held_out_examples():
    field, right, found, there = pii.default_field(), 0, 0, 0
    sentences = {}
    for s, _, w, t in pii_examples.examples(400, seed=77):
        sentences.setdefault(s, []).append((w, t))
    for words in sentences.values():
        text, expected, at, k = " ".join(w for w, _ in words), set(), [], 0
        for w, _ in words:
            at.append(k)
            k += len(w) + 1
        for k, (_, t) in enumerate(words):
            if t[0] == "B":
                end = k
                while end + 1 < len(words) and words[end + 1][1] == "I" + t[1:]:
                    end += 1
                expected.add((t[2:], *pii.trimmed(text, at[k], at[end] + len(words[end][0]), t[2:])))
        got = set(pii.tag([text], field)[0])
        right, found, there = right + len(got & expected), found + len(got), there + len(expected)
    assert right / found > 0.95 and right / there > 0.95


def test_viterbi_agrees_with_trying_every_path():
    from itertools import product

    field, rng = pii.default_field(), np.random.default_rng(2)
    for n in (1, 2, 3):
        x = rng.normal(0, 3, (n, len(pii.LABELS)))

        def score(path, x=x):
            steps = [0, *path, 0]
            return sum(field.move[a, b] for a, b in zip(steps, steps[1:], strict=False)) + sum(x[k, p] for k, p in enumerate(path))

        best = max(product(range(len(pii.LABELS)), repeat=n), key=score)
        assert tuple(field.decode([x])[0]) == best


def test_expected_labels_and_transitions_agree_with_trying_every_path():
    """The gradient of the field is what is seen less what is expected; expectations are summed over all paths here."""
    from itertools import product

    rng, m = np.random.default_rng(4), len(pii.LABELS)
    move = np.where(pii.allowed(), rng.normal(0, 1, (m, m)), pii.NEVER)
    x, lens = rng.normal(0, 2, (3, 3, m)), [1, 2, 3]
    p, moves = pii.expected(x, np.arange(3) < np.array(lens)[:, None], move)
    total = np.zeros((m, m))
    for k, n in enumerate(lens):
        weight, each, steps = 0.0, np.zeros((n, m)), np.zeros((m, m))
        for path in product(range(m), repeat=n):
            whole = [0, *path, 0]
            w = np.exp(sum(move[a, b] for a, b in zip(whole, whole[1:], strict=False)) + sum(x[k, t, y] for t, y in enumerate(path)))
            weight += w
            for t, y in enumerate(path):
                each[t, y] += w
            for a, b in zip(whole, whole[1:], strict=False):
                steps[a, b] += w
        assert np.allclose(p[k, :n], each / weight)
        total += steps / weight
    assert np.allclose(moves, total)


def test_open_places_decode_like_whole_sentences(spark, sf_dir):
    """Places that the bound closes are O in the best path of the whole text, and the others get the same labels."""
    field = pii.default_field()
    made = {}
    for s, _, w, _ in pii_examples.examples(300, seed=5):
        made.setdefault(s, []).append(w)
    texts = [" ".join(w) for w in made.values()] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(150).collect()]
    closed = 0
    for text in texts:
        words = [None, None, *pii._WORD.findall(text), None, None]
        if len(words) == 4:
            continue
        at, told, own, sides = field.codes_of(words)
        inner = np.arange(2, len(words) - 2)
        scores = own[at[inner]] + sum(sides[told[inner + k], n] for n, k in enumerate(pii.SIDES))
        whole = field.decode([scores.astype(np.float64)])[0]
        places, kept = field.open_places(words)
        path = np.zeros(len(words), np.int64)
        runs = np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) > 1) + 1)
        for run in runs if len(places) else []:
            path[places[run]] = field.decode([kept[run]])[0]
        assert (path[2:-2] == whole).all()
        closed += len(inner) - len(places)
    assert closed > 10_000


#: Sentences labelled by hand, with what they hold.
BY_HAND = [
    ("Please call me on (212) 555-0143 after six.", [("phone", "(212) 555-0143")]),
    ("The staging login is demo and the password: sunflower for now", [("secret", "sunflower")]),
    ("export API_TOKEN=unused\ntoken = \"9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c\"", [("secret", "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c")]),
    ("Paid with 4111 1111 1111 1111 last week", [("card", "4111 1111 1111 1111")]),
    ("The server at 192.168.10.44 answered in 12 ms", [("ip", "192.168.10.44")]),
    ("Write to jane.doe@example.org or visit us in 2024", [("email", "jane.doe@example.org")]),
    ("A password is what people forget, and the key to the house hangs by the door.", []),
    ("In 1998 the 3rd edition sold 12,500 copies at $19.99 each", []),
    ("Version 2.4.1 fixes issue #4521; see section 7.3 and page 118", []),
    ("He kept the secret of the old garden", []),
]


def test_sentences_labelled_by_hand():
    for text, expected in BY_HAND:
        assert [(k, text[a:b]) for k, a, b, _ in pii.find([text], pii.default_field())[0]] == expected, text


def test_neighbours_are_words_however_far():
    field = pii.default_field()
    secret = "password =" + " " * 500 + "correcthorse" + "\n" * 500 + "then"
    assert [(k, secret[a:b]) for k, a, b in pii.tag([secret], field)[0]] == [("secret", "correcthorse")]
    assert pii.tag(["a password = none", "correcthorse battery"], field)[1] == []  # texts don't see each other


def test_patterns_agree_with_plain_expressions():
    from tests.llm.test_contracts import base_spans

    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choice("ab1234567890.@+- ()_%x45") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == base_spans(text)
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "+1" * 100_000, "1." * 100_000, "9 " * 100_000):
        pii.find([text], pii.default_field())


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.org now"), (2, None), (3, "clean")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redacted(docs).collect()} == {1: "mail <EMAIL> now", 2: None, 3: "clean"}
    other = docs.selectExpr("text AS Text", "'a.b@c.org' AS `my.text`", "doc_id")
    assert sorted(str(tuple(r)) for r in pii.redacted(other).collect()) == ["('clean', 'a.b@c.org', 3)", "('mail <EMAIL> now', 'a.b@c.org', 1)", "(None, 'a.b@c.org', 2)"]


def test_license_rules_suppress_what_better_ones_hold():
    found = licenses.scan("Licensed under the Apache License, Version 2.0 and CC BY-NC-SA 4.0; all rights reserved")
    labels = [d["label"] for d in found["detections"]]
    assert labels[0] == "apache-2" and "apache-unversioned" not in labels and "cc-by-nc-sa" in labels and "cc-by" not in labels
    assert found["places"] == [(3, "apache-2"), (9, "cc-by-nc")]
    assert len(licenses.rules()) > 300
    assert licenses.scan("mit der Familie")["detections"] == []


def test_neighbours_of_copies_ties_and_broken_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(k, [1.0, 0.0, 0.0]) for k in range(0, 400)] + [(k, rng.normal(0, 1, 3).tolist()) for k in range(400, 700)]
    data += [(700, None), (720, []), (740, [0.0, 0.0, 0.0]), (760, [1.0, None, 0.0]), (780, [float("nan"), 0.0, 1.0]), (800, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (820, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    out = vectors.nearest_neighbours(df, df.where("vec_id % 20 = 0").select("vec_id")).collect()
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in data[:700]]
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == set(range(0, 700, 20))
    hits = 0
    for q, v in good[::20]:
        best = sorted((-float(x @ v), i) for i, x in good if i != q)[:20]
        rows_ = sorted(by[q])
        assert [r for r, _, _ in rows_] == list(range(1, 21)) and q not in [i for _, i, _ in rows_]
        hits += len({i for _, i in best} & {i for _, i, _ in rows_})
    assert hits / (20 * len(by)) >= 0.9
    few = spark.createDataFrame(data[:5], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in vectors.nearest_neighbours(few, few.where("vec_id = 0").select("vec_id")).orderBy("rank").collect()] == [(0, k, k) for k in range(1, 5)]
    assert vectors.nearest_neighbours(df.limit(0), df.limit(0).select("vec_id")).count() == 0


def test_queries_with_too_few_neighbours_are_scanned_again(spark, monkeypatch):
    """A test that abandons nearly everything still gives 20 neighbours, and then the right ones."""
    monkeypatch.setattr(vectors, "LENIENCY", -3.5)
    rng = np.random.default_rng(2)
    data = [(k, rng.normal(0, 1, 24).tolist()) for k in range(900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS ids", "1 AS h1", "2 AS score")
    out = vectors.nearest_neighbours(df, df.where("vec_id % 90 = 0").select("vec_id")).collect()
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    x = np.array([v for _, v in data])
    hits = 0
    for q, found in by.items():
        best = [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]
        assert len(found) == 20
        hits += len({i for _, i in found} & set(best))
    assert len(by) == 10 and hits >= 180


def test_two_levels_of_centroids_find_as_much(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (6000, 16))
    found = []
    for one_level in (10_000, 20):
        monkeypatch.setattr(vectors, "ONE_LEVEL", one_level)
        index = vectors.fit(x, 4.0, float(((x / 4) ** 2).sum(axis=1).max()), 6000, 21)
        lists = index.list_of(index.rotated(x))
        assert (index.tops is None) == (one_level > 20) and len(np.unique(lists)) > 40
        q = x[:100]
        order = vectors.distances(index.rotated(q, query=True), index.centroids).argsort(axis=1)[:, : index.probes]
        best = np.argsort(-(q @ x.T), axis=1)[:, 1:21]
        found.append(np.mean([np.isin(lists[b], o).mean() for b, o in zip(best, order, strict=True)]))
    assert min(found) > 0.93, found


def test_huge_components(spark):
    data = [(k, [1e200 * (k + 1), 1e180, -1e200 * k]) for k in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    out = vectors.nearest_neighbours(df, df.where("vec_id = 20").select("vec_id")).collect()
    assert [r["rank"] for r in sorted(out, key=lambda r: r["rank"])] == list(range(1, 21)) and all(r.score == float("inf") for r in out)


def test_scanning_by_columns_finds_what_full_distances_find():
    rng = np.random.default_rng(9)
    x, q = rng.normal(0, 1, (5000, 65)), rng.normal(0, 1, (40, 65))
    full = vectors.distances(q, x)
    bounds = np.sort(full[:, :1000], axis=1)[:, 40]
    found_q, found_v, read = vectors.scan(q, x, bounds, 20)
    best = np.argsort(full, axis=1)[:, :20]
    hits = sum(len(set(found_v[found_q == k]) & set(best[k])) for k in range(40))
    assert hits / 800 > 0.97 and read < full.size * 65


def test_pairs_that_part_in_the_middle_and_differ_in_length(spark):
    turn = lambda role, text: (role, text)
    same = [turn("system", "s"), turn("user", "q"), turn("assistant", "a1")]
    chosen = [*same, turn("user", "more"), turn("assistant", "good"), turn("user", "ok"), turn("assistant", "bye")]
    rejected = [*same, turn("user", "more"), turn("assistant", "bad")]
    rows = [(1, chosen, rejected, "x"), (2, rejected, chosen, "x"), (3, same, chosen, "x"), (4, None, same, "x"), (5, [turn("user", "a")], [turn("assistant", "a")], "x"), (6, [], [], "x")]
    kind = "array<struct<role: string, text: string>>"
    df = spark.createDataFrame(rows, f"conv_id long, chosen {kind}, rejected {kind}, `prompt` string")
    got = {r.conv_id: r for r in preferences.format_pairs(df.selectExpr("*", "1 AS chosen_mask", "2 AS `a.b`", "3 AS n")).collect()}
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)
    for k, a, b, _ in rows:
        a, b = a or [], b or []
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        r = got[k]
        assert (r.prompt_turns, r.prompt, r.chosen_text, r.rejected_text) == (n, show(a[:n]), show(a[n:]), show(b[n:]))
        for text, mask, turns in ((r.chosen_text, r.chosen_mask, a[n:]), (r.rejected_text, r.rejected_mask, b[n:])):
            assert [text[m.start : m.end] for m in mask] == [f"{t}<|end|>\n" for role, t in turns if role == "assistant"]
    assert got[1].prompt_turns == 4 and got[1]["a.b"] == 2 and got[1].n == 3


def test_conversations_of_sparse_ids_lend_each_other_replies(spark):
    df = spark.createDataFrame([(k * 6400, i, role, f"{role} {k}") for k in range(200) for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    out = preferences.format_pairs(preferences.with_borrowed_reply(preferences.conversations(df))).collect()
    assert len(out) == 200 and all(r.rejected_text and r.rejected_text != r.chosen_text for r in out)


def test_preferences_of_null_turns_and_equal_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (3, 0, None, None), (None, 0, "user", "lost"), (4, None, "assistant", "a"), (4, None, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS prompt", "'y' AS chosen")
    out = preferences.format_pairs(preferences.with_borrowed_reply(preferences.conversations(df)))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].chosen_text == "<|assistant|>\nyes<|end|>\n" and got[1].rejected_text == "<|assistant|>\n<|end|>\n"
    mask = got[1].chosen_mask[0]
    assert got[1].chosen_text[mask.start : mask.end] == "yes<|end|>\n"
    assert got[3].prompt_turns == 1 and got[3].chosen_text == got[3].rejected_text == ""
    assert out.sparkSession.createDataFrame([], df.schema).count() == 0
    assert preferences.format_pairs(preferences.with_borrowed_reply(preferences.conversations(df.limit(0)))).count() == 0


def test_queries_of_a_list_are_cut_and_samples_are_drawn_by_hash(spark, sf_dir, monkeypatch):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    asked = rows.where("vec_id % 3 = 0").select("vec_id")
    found = lambda: sorted(tuple(r) for r in vectors.nearest_neighbours(rows, asked, 5).collect())
    whole = found()
    monkeypatch.setattr(vectors, "QUERIES", 7)
    assert found() == whole
    keyed = rows.select(F.xxhash64("embedding").alias("h1"), F.hash("embedding").alias("h2"), "embedding")
    some = vectors.sampled(keyed, 500, 100)
    assert 50 < some.num_rows < 160 and some.equals(vectors.sampled(keyed.repartition(5), 500, 100))
    assert vectors.sampled(keyed, 500, 500).num_rows == rows.count()
