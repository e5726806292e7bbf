"""Each stage of the pipeline against brute force on what its predecessor kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import common, forest, near_copies, pii, quality
from tests.llm.test_contracts import WORD, base_spans, llr
from tests.llm.test_near_copies import brute_force


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs.toPandas())
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_columns(stages):
    assert all(list(s.columns) == list(stages[0].columns) for s in stages[:-1])


def test_quality(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    scores = llr(stages[0], set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id))

    def fails(text):
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        return len(w) < 50 or 100 * len(covered) > 50 * len(w)

    expected = {i for i, t in zip(stages[0].doc_id, stages[0].text, strict=True) if not fails(t) and scores[i] >= quality.THRESHOLD}
    assert set(stages[1].doc_id) == expected and len(stages[1]) == len(expected)


def test_near_duplicates(stages):
    """Stages on word shingles take five words and a similarity of 0.8."""
    assert sorted(stages[2].doc_id) == brute_force(stages[1].doc_id.tolist(), stages[1].text.tolist())


def test_stages_on_odd_rows(spark, sf_dir):
    text = " ".join(f"word{k} mail a.b@c.org" for k in range(40))
    data = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (None, "", "en", "", 0), (3, text + " more", "de", None, None)]
    odd = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' AS `size`", "1 AS `a.b`")
    for docs in (odd, odd.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            assert k == 4 or out.columns == docs.columns, name
            rows = out.collect()
            assert len(rows) <= 2 * docs.count() if k == 3 else len(rows) <= docs.count()
            if k in (2, 4):
                assert len(rows) == docs.count()
    hidden = corpus_pipeline.personal_data(spark, odd.drop("n_chars"), sf_dir).collect()
    assert not any(r.text and "@" in r.text for r in hidden)


def test_personal_data(stages):
    before = dict(zip(stages[2].doc_id, stages[2].text, strict=True))
    assert sorted(before) == sorted(stages[3].doc_id)
    spans = dict(zip(before, pii.find(list(before.values()), pii.default_field()), strict=True))
    for i, text, n in zip(stages[3].doc_id, stages[3].text, stages[3].n_chars, strict=True):
        assert n == len(text) and text == pii.redact(before[i], spans[i])
        assert not base_spans(text)
        if not spans[i]:
            assert text == before[i]


def test_mixing(stages):
    sizes = stages[3].assign(size=stages[3].text.map(lambda t: len(WORD.findall(t))))
    copies = Counter(stages[4].doc_id)
    assert set(copies) <= set(sizes.doc_id) and max(copies.values()) <= 2
    taken = sum(copies[i] * n for i, n in zip(sizes.doc_id, sizes["size"], strict=True))
    assert abs(taken - 1.5 * sizes["size"].sum()) < 0.02 * sizes["size"].sum()
    texts = dict(zip(sizes.doc_id, sizes.text, strict=True))
    assert all(texts[i] == t for i, t in zip(stages[4].doc_id, stages[4].text, strict=True))


def test_encoding(stages):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    texts = dict(zip(stages[4].doc_id, stages[4].text, strict=True))
    assert Counter(stages[5].doc_id) == Counter(stages[4].doc_id)
    for i, ids in zip(stages[5].doc_id, stages[5].token_ids, strict=True):
        assert np.array_equal(ids, library.encode(texts[i], add_special_tokens=False).ids)


def test_joins_without_broadcasts_give_the_same_rows(spark, sf_dir, monkeypatch):
    """What larger inputs take: keys, ids and candidates joined by a shuffle."""
    docs, trusted = common.read(spark, sf_dir, "documents"), quality.trusted_ids(common.read(spark, sf_dir, "labels"))
    rows = lambda df: sorted(map(repr, df.collect()))
    made = lambda: [rows(quality.kept_documents(docs, trusted)), rows(quality.score(docs.drop("text").join(docs.select("doc_id", "text"), "doc_id"), trusted)), rows(near_copies.one_of_each(docs)), rows(forest.near_duplicates(docs))]
    before = made()
    monkeypatch.setattr(quality, "MOST_BROADCAST", 0)
    monkeypatch.setattr(forest, "MOST_BROADCAST", 0)
    assert made() == before
