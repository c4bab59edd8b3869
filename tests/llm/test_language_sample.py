"""The training sample of the language network."""

from __future__ import annotations

import random

from haltwerk.llm import gru


def test_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    """Ids on very many rows, different and equal ones."""
    rows = [(i % 8, f"text {i} of an id on many rows", "en") for i in range(2000)] + [(9, "the same text", "de")] * 500
    seen = []
    monkeypatch.setattr(gru, "train", lambda texts, labels: seen.append((texts, labels)))
    gru.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=3)
    texts, labels = seen[0]
    assert set(labels) == {"de", "en"} and set(zip(texts, labels)) <= {(t[k:], x) for _, t, x in rows for k in range(len(t))}
    assert all(labels.count(x) <= 3 * gru.EXCERPTS for x in ("de", "en"))


def test_an_unlabelled_corpus_stays(spark, odd, none):
    rows = [(i, f"some text {i}" if i % 2 else "12 34", None) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert gru.fit(docs) is None
    assert sorted(r.doc_id for r in gru.accepted_languages(docs).collect()) == list(range(1, 100, 2))
    assert {r.lang_pred for r in gru.identify_language(docs).collect()} == {"und"}
    assert gru.accepted_languages(none).isEmpty()
    unlabelled = odd.withColumn("lang", gru.F.lit(None).cast("string"))
    assert gru.accepted_languages(unlabelled).count() == 7  # all but NULL, empty and blank texts and one of digits


def test_clean_texts_stay_and_a_higher_share_is_asked_of_long_ones(spark, docs):
    """The share of labelled positions decides on texts that are long enough; at the default every text with a letter stays here."""
    rng = random.Random(2)
    noise = [(10_000 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)), None, None, 400) for i in range(60)]
    short = [(20_000 + i, "xqz", None, None, 3) for i in range(5)]
    both, model = docs.union(spark.createDataFrame(noise + short, docs.schema)), gru.fit(docs)
    clean = {r.doc_id for r in docs.where(docs.text.rlike(r"\p{L}")).collect()}
    assert clean <= {r.doc_id for r in gru.accepted_languages(both, model).collect()}
    kept = {r.doc_id for r in gru.accepted_languages(both, model, least_labelled=0.5).collect()}
    assert {r[0] for r in short} <= kept and sum(r[0] not in kept for r in noise) >= 5
    assert len(clean - kept) < 0.02 * len(clean)


def test_sample_moves_no_language_as_a_whole(spark, docs, monkeypatch):
    """Rows are drawn as they are read: what is dealt by language has passed the draw."""
    plans = []
    monkeypatch.setattr(gru, "train", lambda *_: None)
    collect = type(docs).collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(docs), "collect", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1)
    try:
        gru.fit(docs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = plans[-1]
    by_lang = text.index("Exchange hashpartitioning(lang")
    assert "SortMergeJoin [lang" not in text and text.index("shiftrightunsigned") > by_lang
    assert text.index("partial_min") > by_lang  # drawn and summed before it


def test_a_text_goes_to_python_once(spark, monkeypatch):
    rows = [(1, "some plain words", "en"), (2, None, "en"), (3, "1234", None), (None, "more words", "de")]
    docs, sent, read = spark.createDataFrame(rows, "doc_id long, text string, lang string"), [], gru._read_languages
    monkeypatch.setattr(gru, "_read_languages", lambda rows, *rest: (sent.append(rows.columns), read(rows, *rest))[1])
    model = gru.train([r[1] for r in rows if r[0] == 1], ["en"])
    assert sorted(map(tuple, gru.accepted_languages(docs, model).collect()), key=str) == [(1, "some plain words", "en"), (None, "more words", "de")]
    assert sent == [["doc"]]
