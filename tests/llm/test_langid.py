import random

from covenant.llm import langid
from tests.llm.corpora import documents, no_documents

WORDS = {
    "en": ["the", "thing", "with", "and", "ring", "other", "shown"],
    "fr": ["le", "été", "eau", "que", "dans", "être", "mieux"],
    "de": ["und", "über", "sch", "nicht", "auch", "größe", "ein"],
}


def corpus(spark, number=300):
    rng = random.Random(4)
    rows = []
    for i in range(number):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(2, 50))), lang))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    model = langid.train(langid.learnable(docs), sample=150, features=500, landmarks=40)
    found = langid.identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_texts(spark):
    docs = corpus(spark)
    model = langid.train(docs)
    found = langid.identify(documents(spark), model)
    assert found.columns.count("lang_pred") == 1 and found.columns.count("score") == 1
    rows = found.collect()
    assert len(rows) == documents(spark).count()
    for r in rows:
        nothing = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == langid.UNDETERMINED) == nothing
        assert (r.score == 0.0) if nothing else r.lang_pred in WORDS


def test_predictions_ignore_other_columns(spark):
    docs = corpus(spark)
    model = langid.train(docs)
    other = docs.selectExpr("doc_id + 7 AS doc_id", "text", "'zz' AS lang")
    a = {r.text: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    b = {r.text: (r.lang_pred, r.score) for r in langid.identify(other, model).collect()}
    assert a == b


def test_nothing_to_learn_from(spark):
    model = langid.train(no_documents(spark))
    assert langid.identify(no_documents(spark), model).collect() == []
    found = langid.identify(documents(spark), model).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
