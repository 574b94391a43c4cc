"""Held-out accuracy on the test tables, and the defined cases."""

import zlib

import numpy as np
import pytest

from trailmark.llm import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def network(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(tables, network):
    docs, labels = tables
    rows = toxicity.score(docs, network).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 500 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    toxic = [r.score for r in held if r.toxic]
    clean = np.array([r.score for r in held if not r.toxic])
    assert np.mean([(clean < t).mean() + (clean == t).mean() / 2 for t in toxic]) > 0.95


def test_labels_of_the_held_out_fold_are_not_learnt(tables, network, spark):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 "
                                "then 1 - toxic else toxic end as toxic")
    again = toxicity.fit(docs, flipped)
    assert np.array_equal(again.embedding, network.embedding) and np.array_equal(again.thresholds, network.thresholds)


def test_whole_text_is_scored(network):
    scorer = toxicity.Scorer(network)
    clean = "the of and to in is that it was for " * 6000
    assert scorer.score(clean) < 0.5 < scorer.score(clean + " ".join(["idiot", "trash", "moron", "scum"] * 3))


def test_inputs_are_the_text_only(docs_of, network):
    rows = toxicity.score(docs_of([(1, "an idiot and a trash moron"), (2, "an idiot and a trash moron"), (None, None),
                                   (3, ""), (3, "")]), network).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].score == by[2][0].score and len(rows) == 5
    assert by[None][0].score == by[3][0].score == by[3][1].score < 0.5 and by[None][0].held_out is False


def test_without_labels(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs_of([(1, "a")]), labels) is None
    assert toxicity.fit(docs_of([]), labels.limit(0)) is None
    assert [r.score for r in toxicity.score(docs_of([(1, "a")]), None).collect()] == [0.0]
    assert toxicity.score(docs_of([]), None).count() == 0


def test_languages():
    net = toxicity.Network(np.array([toxicity.bucket(w) for w in toxicity._function_rows()[0]]), np.zeros((1, 1)), [],
                           np.zeros(0), np.zeros(0), 0.0, np.zeros(5))
    scorer = toxicity.Scorer.__new__(toxicity.Scorer)
    scorer.network, scorer.cache = net, {}
    scorer.row_of = {int(b): i + 1 for i, b in enumerate(net.buckets)}
    for text, language in (("the cat was in that house", "en"), ("der Hund und die Katze", "de"),
                           ("les chats et des chiens", "fr"), ("el perro y los gatos", "es")):
        assert toxicity.LANGUAGES[toxicity.guess_language(scorer.rows(text))] == language
    assert toxicity.guess_language(scorer.rows("xyzzy")) == len(toxicity.LANGUAGES)


def test_thresholds_follow_all_labelled_rows(spark, docs_of):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):  # every toxic row has the word, and a quarter of the many clean ones
        toxic = i % 30 == 0
        words = rng.choice(["stone", "river", "house", "tree"], 8).tolist() + ["zap"] * (toxic or rng.random() < 0.25)
        rows.append((i, " ".join(words), int(toxic)))
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int")
    docs = docs_of([(i, t) for i, t, _ in rows])
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels, sample=30)).collect()}
    assert np.mean([found[i] == x for i, _, x in rows]) > 0.95


def test_thresholds_of_counts():
    counts = [(0, 0, -64, 50), (0, 1, 64, 50), (1, 0, 0, 9), (1, 1, 10, 1), (2, 0, 200, 40), (2, 1, 300, 10)]
    found = toxicity._thresholds(counts)
    assert -63 / 64 <= found[0] <= 1 and found[1] == found[3] == found[4] and 201 / 64 <= found[2] <= 300 / 64
    assert (toxicity._thresholds([]) == 0).all()


def test_words_are_those_of_the_expression():
    rng = np.random.default_rng(5)
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["", " ", "Idiot’s “TRASH” – 50€_x", "İstanbul", "ΟΔΟΣ ΟΔΟΣ", "áb",
             "\x1ca\x85b\xa0c d\xb2\xbd\xaa\xb5\xdf\xc9\xd7\xf7", *every]
    texts += ["".join(rng.choice(every[:top], 60)) for top in (128, 256, 8400) for _ in range(50)]
    for text in texts:
        assert toxicity.split_words(text) == toxicity._WORDS(text.lower())


def test_plain_texts_are_split_without_the_expression(network, monkeypatch):
    """The search word by word took a quarter of the scoring."""
    scorer, found, asked = toxicity.Scorer(network), toxicity._WORDS, []
    monkeypatch.setattr(toxicity, "_WORDS", lambda text: asked.append(text) or found(text))
    scorer.logit("Die Stra\xdfe zur \xc9cole, an IDIOT – “no” " * 100)
    assert sum(map(len, asked)) < 1000
    scorer.logit("слово stone")
    assert asked[-1] == "слово stone"


def test_logit_is_that_of_a_plain_convolution(network, monkeypatch):
    rng = np.random.default_rng(6)
    words = ["the", "of", "idiot", "trash", "moron", "scum", "water", "xyzzy", "people", "time"]
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 7)  # several stretches
    scorer = toxicity.Scorer(network)
    for n in (0, 1, 2, 6, 7, 8, 30):
        text = " ".join(rng.choice(words, n))
        rows = [scorer.row_of.get(toxicity.bucket(w), 0) for w in text.split()] or [0]
        padded = network.embedding[rows + [0, 0]]
        hidden = [max((sum(padded[at + k] @ f[k, :, j] for k in range(len(f))) for at in range(len(rows))))
                  for f in network.filters for j in range(f.shape[2])]
        plain = np.maximum(np.array(hidden) + network.filter_bias, 0) @ network.out + network.bias
        assert scorer.logit(text)[0] == pytest.approx(float(plain), rel=1e-9, abs=1e-9)
