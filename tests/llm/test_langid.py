"""Language ID: held-out accuracy, Viterbi against plain recursion, scripts and spans."""

import numpy as np
from fixtures import DOCS_SCHEMA, documents
from flowsight.llm.langid import (
    LETTERS,
    Model,
    keep_known_language,
    label_spans,
    language_report,
    learn,
    predict,
    viterbi,
    word_features,
)


def mixed(spark):
    words = {"en": "the and of thing with", "fr": "le une été dans où", "ru": "это и слово мир дом"}
    rows = [
        (i, " ".join(np.random.default_rng(i).choice(text.split(), 12)), lang, None, 0)
        for k, (lang, text) in enumerate(words.items())
        for i in range(100 * k, 100 * k + 60)
    ]
    odd = [(900, None, "en", None, 0), (901, "12 + 34 !!", "en", None, 0), (902, "the and of", None, None, 0)]
    odd += [(None, "le une dans", "fr", None, 0), (None, "", "fr", None, 0), (903, "語言 模型", None, None, 0)]
    odd += [(904, "THE and Of é " * 20_000, None, None, 0)] * 2
    return spark.createDataFrame(rows + odd, DOCS_SCHEMA).selectExpr("*", "'x' AS lang_pred", "1 AS score")


def plain_best(scores, penalty):
    """The best total over all paths, one recursion step a word."""
    state = scores[0]
    for row in scores[1:]:
        state = np.array(
            [max(state[m] - (penalty if m != k else 0) for m in range(len(row))) for k in range(len(row))]
        ) + row
    return state.max()


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(30, 4)) * 3
    ids = [rng.integers(0, 30, n) for n in (0, 1, 2, 17, 60, 5, 60)]
    for penalty in (0.0, 2.0, 100.0):
        for path, words in zip(viterbi(scores, ids, penalty), ids):
            assert len(path) == len(words)
            if len(words):
                total = scores[words, path].sum() - penalty * np.count_nonzero(path[1:] != path[:-1])
                assert abs(total - plain_best(scores[words], penalty)) < 1e-9


def test_features_of_words():
    owner, bucket, scripts = word_features(["the", "é", "мир", "the"])
    assert np.bincount(owner).tolist() == [4, 2, 4, 4]
    assert sorted(bucket[owner == 0]) == sorted(bucket[owner == 3])
    assert scripts[0] == scripts[1] != scripts[2]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(got) == 1000 and 150 < len(out) < 350
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_scripts_nulls_and_ties(spark):
    docs = mixed(spark)
    model = learn(docs)
    assert model.languages == ["en", "fr", "ru"]
    got = {r.doc_id: r for r in predict(docs, model).collect()}
    assert all(got[i].lang_pred == "ru" for i in range(200, 260))
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0
    assert got[904].lang_pred == "en" and got[903].lang_pred in model.languages
    kept = keep_known_language(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {900, 901} & set(ids) and ids.count(None) == 1 and ids.count(904) == 2


def test_unlearned_scripts_are_rejected(spark):
    docs = mixed(spark).filter("lang IS NULL OR lang != 'ru'").drop("lang_pred", "score")
    texts = {950: "это слово и мир", 951: "語言 模型", 952: "the and of " + "語言 " * 20, 953: "the and of thing 語言 " * 9}
    docs = docs.union(documents(spark, list(texts.items())))
    model = learn(docs)
    assert model.languages == ["en", "fr"]
    got = {r.doc_id: r.score for r in predict(docs, model).filter("doc_id >= 950").collect()}
    assert got == {950: 0.0, 951: 0.0, 952: 8 / 48, 953: 13 / 15}
    kept = {r.doc_id for r in keep_known_language(docs).collect()}
    assert kept & {903, *texts} == {953} and kept >= set(range(60))


def test_spans_of_mixed_text(spark):
    docs = mixed(spark)
    text = "the thing with the and of. " * 3 + "это слово и мир! 語言 " + "où une été dans le une où"
    spans = label_spans(documents(spark, [(1, text), (2, None)]), learn(docs), 4.0).collect()
    by_doc = {r.doc_id: [(s.lang, text[s.start : s.end]) for s in r.spans] for r in spans}
    assert [lang for lang, _ in by_doc[1]] == ["en", "ru", "und", "fr"]
    assert by_doc[1][1][1] == "это слово и мир" and by_doc[1][3][1].endswith("où")
    assert by_doc[2] == []


def test_nothing_to_learn(spark):
    assert {r.lang_pred for r in language_report(documents(spark, [(1, "a b"), (2, None)])).collect()} == {"und"}
    assert language_report(documents(spark, [])).count() == 0
    assert isinstance(learn(documents(spark, [])), Model)


def test_letters_are_letters_with_their_marks(spark):
    assert LETTERS.findall("हिन्दी भाषा தமிழ் e\u0301te\u0301 x½y ²Ⅷ 42_a") == [
        "हिन्दी", "भाषा", "தமிழ்", "e\u0301te\u0301", "x", "y", "a",
    ]
    rows = [(i, "the cat and the dog of the house" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "½ ² Ⅷ ①", None), (101, "\u0301\u0302", None), (102, "½ the cat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_report(docs).collect()}
    assert got[100] == got[101] == ("und", 0.0)
    assert got[102][0] == "en"
