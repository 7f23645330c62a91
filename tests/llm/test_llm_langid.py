"""Language identification: accuracy on texts it did not learn from, and what it says of odd ones."""

import math

import pytest
from pyspark.sql import functions as F

from stagemart.llm import langid
from stagemart.llm.langid import LanguageOptions, fit_languages, identified, identify_languages
from stagemart.llm.queries import op3_language_id

FOLDER = "/root/testdata/sf0.01"


def _said(frame, **options):
    found = identify_languages(frame, F.col("lang").isNotNull() & ~F.col("held"), **options)
    return {row.doc_id: row.language for row in found.collect()}


@pytest.fixture(scope="module")
def documents(spark):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("held", held).cache()


def test_accuracy_on_texts_it_did_not_learn_from(spark):
    truth = {row.doc_id: row.lang for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op3_language_id(spark, FOLDER).collect()
    held = [row for row in rows if row.held_out]
    assert len(rows) == len(truth) and len(held) > 200
    assert sum(row.lang_pred == truth[row.doc_id] for row in held) / len(held) > 0.96
    assert sum(row.rejected for row in rows) <= 0.002 * len(rows)
    assert all(0 <= row.score <= 1 for row in rows)


def test_labels_and_ids_of_held_out_texts_change_nothing(documents):
    other = documents.withColumn("lang", F.when(F.col("held"), F.lit("xx")).otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit(None).cast("string"))
    assert _said(documents) == _said(other)


def test_odd_texts(spark, documents):
    odd = [
        (-1, None), (-2, ""), (-3, "123 -- 45.6 !"), (-4, "é"), (-5, "the thing and the other thing " * 30_000), (-6, "a"),
        (-7, "Съешь ещё этих мягких французских булок, да выпей чаю. " * 20), (-7, "a"),
    ]
    rows = spark.createDataFrame([(ident, text, None, "s", 0, True) for ident, text in odd], documents.schema)
    clashing = documents.unionByName(rows).withColumn("score", F.lit("x")).withColumn("rejected", F.lit(3)).withColumn("id", F.lit(1))
    found = [row for row in identify_languages(clashing, F.col("lang").isNotNull() & ~F.col("held")).collect() if row.doc_id < 0]
    said = {(row.doc_id, row.text): row.language for row in found}
    assert len(found) == len(odd) and all(row.rejected == 3 for row in found)
    for ident, text in odd[:3]:
        assert tuple(said[ident, text]) == ("und", 0.0, True)
    for ident, text in odd[3:]:
        assert said[ident, text].lang in ("en", "de", "fr", "es")
    assert said[-5, odd[4][1]].lang == "en" and not said[-5, odd[4][1]].rejected
    assert said[-7, odd[6][1]].rejected


def test_nothing_to_learn_from_and_no_rows(spark, documents):
    blank = documents.withColumn("lang", F.lit(None).cast("string")).limit(20)
    assert {tuple(said) for said in _said(blank).values()} == {("und", 0.0, True)}
    assert _said(documents.limit(0)) == {}


def _plain(text, model):
    """Label and cosine of the nearest centroid, n-gram by n-gram."""
    size = len(model.idf)
    folded = [0] + [byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 0 for byte in text.encode()] + [0]
    counts = [0] * size
    for first, second, third in zip(folded, folded[1:], folded[2:]):
        if second:
            counts[(((first << 16 | second << 8 | third) * 0x9E3779B1) % (1 << 32)) >> (32 - size.bit_length() + 1)] += 1
    vector = [math.log1p(count) * float(idf) for count, idf in zip(counts, model.idf)]
    norm = math.sqrt(sum(value * value for value in vector))
    near = [sum(a * float(b) for a, b in zip(vector, centre)) / norm for centre in model.centroids]
    return [(model.languages[owner], score) for owner, score in zip(model.owner, near)]


def test_nearest_centroid_by_hand(documents):
    """On small texts of all languages, with ties between centroids of equal cosines left to the first label."""
    model = fit_languages(documents.where("NOT held"), "doc_id", "text", "lang", LanguageOptions(features=512, sample_per_language=40))
    some = documents.where("held AND length(text) < 1500").limit(60)
    found = some.withColumn("said", identified(some, F.col("text"), model)).collect()
    assert len(found) > 20
    for row in found:
        near = _plain(row.text, model)
        best = max(score for _, score in near)
        assert row.said.score == pytest.approx(best, abs=1e-4)
        assert row.said.lang in {label for label, score in near if score > best - 1e-4}


def test_equal_centroids_give_the_first_label(spark):
    rows = [(number, "same words for both labels", label) for number, label in enumerate(["b", "a"] * 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {row.language.lang for row in identify_languages(frame, F.lit(True)).collect()} == {"a"}


@pytest.mark.parametrize("ids", ["NULL", "7", "id"], ids=["none", "one", "own"])
def test_the_sample_is_bounded_whatever_the_ids(spark, monkeypatch, ids):
    sampled = []
    clusters = langid._clusters
    monkeypatch.setattr(langid, "_clusters", lambda points, options: sampled.append(len(points)) or clusters(points, options))
    frame = spark.range(3000).selectExpr(f"CAST({ids} AS BIGINT) AS doc_id", "concat('words number ', id % 1000) AS text", "IF(id % 3 = 0, 'x', 'y') AS lang")
    fit_languages(frame, "doc_id", "text", "lang", LanguageOptions(sample_per_language=50))
    assert sampled == [50, 50]


def test_a_column_of_the_output_name_raises(documents):
    with pytest.raises(ValueError, match="held"):
        identify_languages(documents, F.lit(True), output="held")
