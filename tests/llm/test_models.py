"""Language, quality, toxicity and mixing on small tables."""

import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import language, mixing, quality, toxicity
from lakestrata.llm.samples import is_remainder, labelled_sample

SYLLABLES = {
    "en": ["the", "and", "ing", "ther", "wh", "sh"],
    "de": ["der", "ung", "sch", "keit", "ein", "ß"],
    "fr": ["eau", "qu", "é", "tion", "oi", "ê"],
}


def prose(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled_docs(make_docs, spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        lang = rng.choice(list(SYLLABLES))
        text = prose(rng, lang, rng.randint(20, 150))
        toxic, good = int(k % 4 == 0), int(k % 3 > 0)
        words = text.split()
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["zork", "blarg"]))
        if not good:
            words = [w + "%%%" for w in words] if k % 2 else words[:1] * 40
        rows.append((k, " ".join(words), lang, "s"))
        labels.append((k, good, toxic))
    labels += [(5, None, None), (None, 1, 1), (9999, 1, 0), (7, 1, 0)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out_accuracy(scored, labels, label):
    rows = scored.where(is_remainder("doc_id", 5, 0)).join(labels, "doc_id").where(f"{label} IS NOT NULL")
    both = [(r.predicted, r[label]) for r in rows.collect()]
    return np.mean([a == b for a, b in both])


def learnable(labels):
    return labels.where(~is_remainder("doc_id", 5, 0))


def test_quality(labelled_docs, make_docs, odd_rows):
    docs, labels = labelled_docs
    model = quality.fit(docs, learnable(labels), "quality")
    assert held_out_accuracy(quality.score_quality(docs, model), labels, "quality") > 0.95
    odd = quality.score_quality(make_docs(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    empty = quality.fit(docs, labels.limit(0), "quality")
    assert quality.score_quality(make_docs([]), empty).collect() == []
    assert quality.score_quality(make_docs(odd_rows), empty).count() == len(odd_rows)


def test_quality_sum_over_words_is_the_average_of_vectors():
    s = quality.Settings(buckets=512, steps=30, batch=4)
    rng = random.Random(1)
    texts = [prose(rng, "en", 30), "a a a b", "x"]
    model = quality.fit_sample([(t, k % 2) for k, t in enumerate(texts * 3)], s)
    margins = model.margins()
    from lakestrata.llm.ngrams import WordSums, feature_lists

    sums = WordSums(margins[:-1], s.orders, whole=True, pair=margins[-1], pair_count=s.pairs)
    for text, score in zip(texts, model.scores(sums.of(texts))):
        words = text.split()
        ids, _ = quality.with_pairs(words, *feature_lists(words, s.orders, s.buckets, True), s)
        logits = model.vectors[ids].mean(axis=0) @ model.output + model.bias
        assert score == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-5)


def test_toxicity(labelled_docs, make_docs, odd_rows):
    docs, labels = labelled_docs
    model = toxicity.fit(docs, learnable(labels), "toxic", toxicity.Settings(steps=120))
    assert held_out_accuracy(toxicity.score_toxicity(docs, model), labels, "toxic") > 0.9
    odd = toxicity.score_toxicity(make_docs(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_toxicity(make_docs([]), model).collect() == []
    empty = toxicity.fit(docs, labels.limit(0), "toxic")
    assert {r.score for r in toxicity.score_toxicity(make_docs(odd_rows), empty).collect()} == {0.5}


def test_toxicity_gradients():
    s = toxicity.Settings(window=5, stride=3, word_buckets=16, char_buckets=16, word_width=3,
                          char_width=2, state=2, attention=2)
    model = toxicity.ToxicityModel(toxicity._initial(s, np.random.default_rng(1)), s)
    words, labels = ["ab", "c", "def", "x"], np.array([1.0, 0.0])
    windows = np.array([[0, 1, 2, 3, 0], [2, 1, -1, -1, -1]])

    def loss():
        x, _ = model._vectors(words)
        table = np.vstack([x @ model.weights["enter"] + model.weights["enter_bias"], np.zeros((1, 12))])
        p = toxicity._sigmoid(model._forward(table, windows)[0])
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, gradient in model._gradients(words, windows, labels).items():
        values = model.weights[name]
        for at in list(np.ndindex(values.shape))[:20]:
            kept = values[at]
            values[at] = kept + 1e-5
            above = loss()
            values[at] = kept - 1e-5
            below = loss()
            values[at] = kept
            assert gradient[at] == pytest.approx((above - below) / 2e-5, abs=1e-7), name


def test_windows_overlap_and_cover_every_word():
    s = toxicity.Settings()
    for length in (0, 1, 47, 48, 49, 84, 85, 1000):
        windows = toxicity.windows_of(np.arange(length), s)
        assert set(windows[windows >= 0].tolist()) == set(range(length))
        assert all(b[0] <= a[-1] for a, b in zip(windows, windows[1:]))


def test_language(labelled_docs, make_docs, odd_rows):
    docs, _ = labelled_docs
    model = language.fit(language.learnable(docs))
    told = language.predict_language(docs, model).where(is_remainder("doc_id", 4, 2))
    rows = told.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    odd = {r.doc_id: r for r in language.predict_language(make_docs(odd_rows), model).collect()}
    assert all(odd[k].lang_pred == "und" and odd[k].score == 0 for k in (3, 4, 5, 9, None))
    assert all(odd[k].lang_pred in SYLLABLES for k in (1, 2, 6, 7))
    nothing = language.fit(docs.limit(0))
    assert language.predict_language(make_docs(odd_rows), nothing).count() == len(odd_rows)
    kept = language.keep_known_language(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.95 * docs.count()


def test_numbers_that_are_no_digits_are_not_letters(make_docs):
    texts = {1: "½ ²", 2: "① ③ 12 _ !", 3: "Ⅷ ٣", 4: "² a", 5: "ª", 6: "é", 7: "日", 8: "\u0301 \u20dd"}
    rows = [(k, t, "en", None) for k, t in texts.items()]
    rows += [(10 + k, f"word{k} other words", "en", None) for k in range(40)]
    model = language.fit(make_docs(rows))
    found = {r.doc_id: r for r in language.predict_language(make_docs(rows), model).collect()}
    for k, text in texts.items():
        letters = [c for c in text if unicodedata.category(c).startswith("L")]
        assert (found[k].lang_pred, found[k].score > 0) == (("en", True) if letters else ("und", False))
    kept = language.keep_known_language(make_docs(rows)).collect()
    assert {r.doc_id for r in kept} == {4, 5, 6, 7, *range(10, 50)}


def test_document_frequencies_cover_all_documents(make_docs):
    from lakestrata.llm.ngrams import feature_lists

    s = language.Settings(buckets=256)
    texts = ["aa bb", "aa", "", None, "cc aa cc"] * 30
    found, total = language.document_frequencies(
        make_docs([(k, t, "en", None) for k, t in enumerate(texts)]).repartition(3), s
    )
    expected = np.zeros(256)
    for text in texts:
        expected[np.unique(feature_lists((text or "").split(), s.orders, 256)[0])] += 1
    assert total == len(texts) and (found == expected).all()


def test_samples_are_bounded_and_ordered(make_docs, spark):
    docs = make_docs([(k, "x" * 50 + str(k), None, None) for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    sample = labelled_sample(docs, labels, "toxic", 5, 20)
    assert len(sample) == 10 and all(len(t) <= 20 for t, _ in sample)
    assert sample == labelled_sample(docs.repartition(3), labels, "toxic", 5, 20)


def plain_raking(cells, s):
    """The same by numpy: cells maps (source, lang, topic) to tokens."""
    keys, tokens = list(cells), np.array(list(cells.values()), float)
    weight = tokens * s.budget
    for _ in range(200):
        for d in range(3):
            values = sorted({k[d] for k in keys})
            at = np.array([values.index(k[d]) for k in keys])
            shares = np.bincount(at, tokens) ** s.targets[mixing.DIMENSIONS[d]]
            wanted = shares / shares.sum() * s.budget * tokens.sum()
            weight = np.minimum(tokens, weight * (wanted / np.bincount(at, weight))[at])
    return dict(zip(keys, weight / tokens))


def test_mixing(make_docs):
    rng = random.Random(9)
    rows = [
        (k, prose(rng, lang, rng.randint(5, 60)), rng.choice([lang, lang, None]), rng.choice(["a", "a", "a", "b", None]))
        for k in range(1500)
        for lang in [rng.choice(["en", "en", "de"])]
    ]
    s = mixing.Settings(topics=3, rounds=30)
    found = mixing.mix(make_docs(rows), s).collect()
    assert sorted(r.doc_id for r in found) == list(range(1500))
    cells = {}
    for r in found:
        key = (r.source or "", r.lang or "", r.topic)
        cells[key] = cells.get(key, 0) + r.n_tokens
    expected = plain_raking(cells, s)
    for r in found:
        assert r.probability == pytest.approx(expected[r.source or "", r.lang or "", r.topic], abs=0.01)
    total = sum(r.n_tokens for r in found)
    assert sum(r.n_tokens * r.probability for r in found) == pytest.approx(s.budget * total, rel=0.01)
    assert sum(r.n_tokens for r in found if r.sampled) == pytest.approx(s.budget * total, rel=0.1)


def test_mixing_to_given_shares_and_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    s = mixing.Settings(targets={"source": {"a": 0.5, None: 0.5}}, budget=0.0005)
    found = mixing.mix(docs, s).collect()
    assert len(found) == len(odd_rows)
    assert all(r.probability == 0 for r in found if r.source in ("b", "c", "d"))
    assert all(r.probability > 0 for r in found if r.source == "a")
    kept = mixing.sample(docs, mixing.Settings(budget=1.0))
    assert kept.columns == docs.columns
    assert mixing.mix(make_docs([])).collect() == []


def test_mixing_goes_on_until_the_sums_are_met(make_docs, caplog):
    """Margins that hang together need many rounds; some can't be met, which is told."""
    rng = random.Random(12)
    rows = [(k, "word " * 20, "en" if k % 50 else "de", "a") for k in range(400)]
    rows += [(400 + k, "word " * 20, "de" if k % 50 else "en", "b") for k in range(100)]
    rng.shuffle(rows)
    s = mixing.Settings(
        targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.51, "de": 0.49}},
        topics=1,
        budget=0.1,
    )
    found = mixing.mix(make_docs(rows), s).collect()
    assert max(r.margin_error for r in found) < s.tolerance and not caplog.records
    total = sum(r.n_tokens * r.probability for r in found)
    for name, share in (("en", 0.51), ("de", 0.49)):
        part = sum(r.n_tokens * r.probability for r in found if r.lang == name)
        assert part == pytest.approx(share * total, rel=2e-3)
    full = mixing.Settings(targets={"source": {"a": 0.1, "b": 0.9}}, topics=1, budget=0.9)
    short = mixing.mix(make_docs(rows), full).collect()
    assert max(r.margin_error for r in short if r.source == "b") > 0.5 and caplog.records


def test_no_step_of_the_mix_plans_more_than_its_own_joins(make_docs, monkeypatch):
    """What is broadcast lies in the driver, so joins of all steps can't be in one plan."""
    joins = {}

    def stage(df, label, write=mixing.stage):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[label] = max(joins.get(label, 0), plan.count("Join "))
        return write(df, label)

    monkeypatch.setattr(mixing, "stage", stage)
    rows = [(k, "word " * (k % 9 + 1), "en" if k % 3 else "de", "ab"[k % 2]) for k in range(60)]
    found = mixing.mix(make_docs(rows), mixing.Settings(rounds=4)).collect()
    assert len(found) == 60
    assert joins["mix-raked"] == 1 and max(joins.values()) <= 3


def test_stages_leave_columns_of_their_own_names_alone(labelled_docs, spark):
    taken = ["_language", "told", "doc", "_mix", "_source", "_topic", "draw", "sampled", "tokens"]
    docs = labelled_docs[0].withColumns({name: F.concat(F.lit(name), "doc_id") for name in taken})
    whole = {r.doc_id: r for r in docs.collect()}
    kept = mixing.sample(language.keep_known_language(docs)).collect()
    assert kept and all(r == whole[r.doc_id] for r in kept)


def test_pipeline_stages(make_docs, spark, tmp_path):
    rng = random.Random(10)
    rows = [(k, prose(rng, "en", 40), "en", f"s{k % 3}") for k in range(120)]
    rows += [(200, rows[0][1], "en", "s1"), (201, rows[1][1].replace(" ", "  ", 1), "en", "s1")]
    rows += [(202, rows[2][1] + " end", "en", "s0"), (203, None, "en", "s0"), (204, "123", "en", "s0")]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    left = {}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, "")
        path = str(tmp_path / re.sub(r"\W", "-", name))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert left["language ID"] == {*range(120), 200, 201, 202}
    assert left["exact dedup"] == {*range(120), 202}
    assert left["n-gram Jaccard join"] == set(range(120))
    assert 40 < len(left["mixing to target weights"]) < 100
    assert left["byte-level BPE"] == left["mixing to target weights"]
    assert {"n_tokens", "ids_sha256", "decoded_sha256", "ids"} <= set(docs.columns)
