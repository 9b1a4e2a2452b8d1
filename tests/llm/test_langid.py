import math
import random
import string

import numpy as np
from pyspark.sql import functions as F

import siteledger.llm.langid as module
from siteledger.llm.common import fold
from siteledger.llm.langid import counts, drop_unknown, learn, predict


def order():
    return F.md5(F.col("doc_id").cast("string").cast("binary"))


def model_of(docs):
    return learn(docs.where(fold("doc_id", 5) != 0), F.col("lang"), F.col("text"), order())


def test_held_out_accuracy_and_nothing_clean_is_rejected(corpus):
    rows = predict(corpus, model_of(corpus), ["doc_id", "lang"]).select("_doc.*", "_lang", "_score", "_rejected", (fold("_doc.doc_id", 5) == 0).alias("held")).collect()
    held = [r for r in rows if r["held"]]
    assert len(held) > 20 and sum(r["lang"] == r["_lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["_score"] <= 1 for r in rows) and not any(r["_rejected"] for r in rows)


def test_texts_without_letters_are_unknown(corpus, frame):
    model = model_of(corpus)
    rows = [(1, None), (2, ""), (3, "123 -- 4"), (4, "_ 5"), (5, "the thing and the other of them " * 30000), (6, "x"), (6, "x"), (None, "la vie et le")]
    docs = frame(rows)
    found = predict(docs, model, ["doc_id"]).select("_doc.doc_id", "_lang", "_score").collect()
    assert {r["doc_id"] for r in found if r["_lang"] == "und"} == {1, 2, 3, 4}
    assert all(r["_score"] == 0 for r in found if r["_lang"] == "und")
    kept = drop_unknown(docs, model)
    assert kept.columns == docs.columns and not {1, 2, 3, 4} & {r["doc_id"] for r in kept.collect()}


RANDOM = random.Random(3)
FAR = {
    "another script": "日本語のテキスト" * 20,
    "random letters": " ".join("".join(RANDOM.choices(string.ascii_lowercase, k=RANDOM.randint(2, 9))) for _ in range(120)),
    "Finnish": "Suomi on tasavalta Pohjois-Euroopassa ja sen pääkaupunki on Helsinki. Maassa on paljon järviä ja metsiä, ja talvet ovat siellä kylmiä ja pitkiä. "
    "Ihmiset puhuvat suomea ja ruotsia, ja kesällä monet matkustavat mökille uimaan, saunomaan ja kalastamaan.",
    "Polish": "Polska jest państwem położonym w Europie Środkowej. Stolicą jest Warszawa, a największe miasta to Kraków, Łódź i Wrocław. Mieszkańcy mówią po polsku.",
    "C++": "#include <vector>\ntemplate <typename T> class Stack { std::vector<T> items; public: void push(const T& x) { items.push_back(x); } "
    "T pop() { T x = items.back(); items.pop_back(); return x; } };\nint main() { Stack<int> s; for (int i = 0; i < 10; ++i) s.push(i); return 0; }",
    "hex dump": " ".join("".join(RANDOM.choices("0123456789abcdef", k=8)) for _ in range(80)),
}
NEAR = ["la vie et le", "The weather has been quite nice today and we went for a long walk in the park with our dog before dinner.", "the thing and the other of them " * 30]


def test_far_texts_are_rejected_and_near_ones_kept(corpus, frame):
    model = model_of(corpus)
    kept = {r["doc_id"] for r in drop_unknown(frame(list(enumerate([*FAR.values(), *NEAR]))), model).collect()}
    assert {name for i, name in enumerate(FAR) if i in kept} == set()
    assert kept == set(range(len(FAR), len(FAR) + len(NEAR)))


def test_equals_a_plain_search_of_centroids(corpus):
    model = model_of(corpus)
    rows = predict(corpus, model, ["doc_id", "text"]).select("_doc.*", "_lang", "_score").collect()
    centroids = model.centroids.astype(float)
    for r in rows[::7]:
        weighed = [math.log1p(c) * w for c, w in zip(counts(r["text"]).tolist(), model.idf.tolist(), strict=True)]
        length = math.sqrt(math.fsum(w * w for w in weighed))
        near = [math.fsum(w * c for w, c in zip(weighed, centroid, strict=True) if w) / length for centroid in centroids.tolist()]
        assert abs(max(near) - r["_score"]) < 1e-4
        assert max(n for n, lang in zip(near, model.languages, strict=True) if lang == r["_lang"]) > max(near) - 1e-4


def test_one_text_in_two_languages_is_a_tie(spark):
    rows = [(i, "same words here and there", lang) for lang in ("xx", "aa") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(docs, F.col("lang"), F.col("text"), order())
    found = predict(docs, model, ["doc_id"]).collect()
    assert set(model.languages) == {"aa", "xx"}
    assert len(found) == 6 and {(r["_lang"], r["_rejected"]) for r in found} == {("aa", False)}


def test_no_labels_and_no_rows(corpus, frame):
    nothing = model_of(corpus.withColumn("lang", F.lit(None).cast("string")))
    assert nothing is None
    assert {r["_lang"] for r in predict(corpus, nothing, ["doc_id"]).collect()} == {"und"}
    assert predict(frame([]), model_of(corpus), ["doc_id"]).count() == 0


def test_sample_is_bounded_even_if_ids_repeat(spark):
    docs = spark.createDataFrame([(1, "same text", "en")] * 500 + [(i, "otro texto", "es") for i in range(40)], "doc_id long, text string, lang string")
    assert len(learn(docs, F.col("lang"), F.col("text"), order(), per_language=5).languages) <= 8


def test_the_sample_is_fitted_in_tasks_and_only_the_model_reaches_the_driver(corpus, monkeypatch):
    sent, collect = [], type(corpus).collect

    def collected(df):
        rows = collect(df)
        sent.append(sum(len(v) for r in rows for v in r if isinstance(v, bytes | bytearray)))
        return rows

    monkeypatch.setattr(type(corpus), "collect", collected)
    model = model_of(corpus)
    assert len(model.languages) >= 4 and sum(sent) <= model.centroids.nbytes


def test_model_equals_a_plain_fit_of_all_texts(corpus):
    model = model_of(corpus)
    sample = corpus.where(fold("doc_id", 5) != 0).where("lang IS NOT NULL").where(module.text_has_letter("text")).select("lang", "text").collect()
    sample = sorted((r["lang"], counts(r["text"]).tobytes(), r["text"]) for r in sample)
    assert len(sample) > 80
    matrix = np.stack([counts(text) for _, _, text in sample])
    idf = (np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))) + 1).astype(np.float32)
    assert np.array_equal(model.idf, idf)
    for lang in set(model.languages):
        at = [i for i, row in enumerate(sample) if row[0] == lang]
        own, here = module._clusters(module.vectors(matrix[at], idf), module.CENTROIDS), [i for i, name in enumerate(model.languages) if name == lang]
        assert np.allclose(model.centroids[here], own, atol=1e-5)
        radius = module._radius(idf, own, [module.pieces(sample[i][2]) for i in at], module.SLACK)
        assert np.allclose(model.least[here], [radius] * len(here), atol=1e-5)
