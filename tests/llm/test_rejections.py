"""What the filters of the corpus pipeline must reject, and what they must leave alone."""

import random
import string
from pathlib import Path

import pytest

import corpus_pipeline
from tablewright.llm import language, quality

SF_DIR = Path("/root/testdata/sf0.1")

#: Syllables of invented languages; the last is never learned.
SYLLABLES = {
    "aa": ["kor", "vak", "tul", "ark", "ost", "im"],
    "bb": ["ina", "elo", "omi", "aue", "ila", "no"],
    "cc": ["schi", "bren", "wig", "hau", "feld", "er"],
    "dd": ["que", "cion", "la", "dor", "mente", "es"],
    "zz": ["phy", "xag", "zuj", "ybb", "gwy", "oq"],
}


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
                    for _ in range(words))


def noise(rng, words):
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9)))
                    for _ in range(words))


@pytest.mark.parametrize("learned", [["aa"], ["aa", "bb"], ["aa", "bb", "cc", "dd"]])
def test_texts_of_no_learned_language_go_whatever_the_number_of_labels(spark, learned):
    rng = random.Random(len(learned))
    rows = [(i, prose(rng, learned[i % len(learned)], rng.randint(30, 120)),
             learned[i % len(learned)]) for i in range(80 * len(learned))]
    columns = "doc_id long, text string, lang string"
    model = language.train(spark.createDataFrame(rows, columns))
    code = ' token = "9dd3c80004c73dc9e548fee51b23b527780d4f20"'
    clean = [prose(rng, lang, n) for lang in learned for n in (1, 3, 15, 60, 3000) for _ in range(8)]
    clean += [prose(rng, lang, 8) + code for lang in learned]
    clean += [" ".join(prose(rng, lang, 30) for lang in learned[:2])]
    foreign = [prose(rng, "zz", n) for n in (15, 60, 3000) for _ in range(8)]
    foreign += [noise(rng, n) for n in (15, 60, 3000) for _ in range(8)] + ["Съешь ещё этих булок " * 5]
    texts = [*clean, *foreign, None, "", "12 + 3"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], columns)
    found = language.kept(df, model, corpus_pipeline.LEAST_LANGUAGE_SCORE)
    assert {r["doc_id"] for r in found.collect()} == set(range(len(clean)))


@pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not present")
def test_documents_of_languages_that_were_not_learned_go(spark):
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet")).filter("doc_id % 4 = 0")
    model = language.train(docs.filter("lang IN ('en', 'fr')"))
    left = language.kept(docs, model, corpus_pipeline.LEAST_LANGUAGE_SCORE)
    labels = spark.read.parquet(str(SF_DIR / "labels.parquet")).filter("quality = 1")

    def counts(df):
        return {r["lang"]: r["count"] for r in
                df.join(labels, "doc_id").groupBy("lang").count().collect()}

    before, after = counts(docs), counts(left)
    assert (after["en"], after["fr"]) == (before["en"], before["fr"])
    assert after.get("de", 0) + after.get("es", 0) <= 0.02 * (before["de"] + before["es"])


def test_toxic_prose_goes_and_a_single_word_in_a_long_text_does_not(spark):
    rng = random.Random(5)
    plain = [prose(rng, "bb", 120) for _ in range(60)] + [prose(rng, "bb", 3000) + " stupid."]
    toxic = [" ".join([prose(rng, "bb", 40), "Idiot,", prose(rng, "bb", 40), "scum!"])
             for _ in range(20)] + ["you pathetic moron"]
    df = spark.createDataFrame(list(enumerate([*plain, *toxic])), "doc_id long, text string")
    scorer = quality.train(df)
    found = {r["doc_id"]: r for r in quality.classify(df, scorer).collect()}
    assert [found[i]["keep"] for i in range(len(found))] == [True] * 61 + [False] * 21
    assert all(found[i]["posterior"] < 0.5 for i in range(61, 82))
    assert {r["doc_id"] for r in quality.kept(df, scorer).collect()} == set(range(61))


@pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not present")
def test_labelled_toxic_documents_go(spark):
    """English ones: those in other languages hold invented words that no list has."""
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet")).filter("doc_id % 4 = 0")
    docs = docs.filter("lang = 'en'")
    left = quality.kept(docs, quality.train(docs))
    labels = spark.read.parquet(str(SF_DIR / "labels.parquet")).filter("quality = 1")

    def counts(df):
        return {r["toxic"]: r["count"] for r in
                df.join(labels, "doc_id").groupBy("toxic").count().collect()}

    before, after = counts(docs), counts(left)
    assert after.get(1, 0) <= 0.05 * before[1]
    assert after[0] >= 0.99 * before[0]


@pytest.mark.parametrize("words", [1999, 2000, 2001, 12_345])
def test_a_cycled_passage_gets_the_same_vote_at_every_length(words):
    passage = [f"word{i}" for i in range(60)]
    text = " ".join(passage[i % 60] for i in range(words))
    variety = list(quality.LABELLERS).index("variety")
    assert quality.votes_of(text)[variety] == quality.BAD
    plain = " ".join(f"word{i * i % 7919}" for i in range(words))
    assert quality.votes_of(plain)[variety] == quality.GOOD


def test_filters_keep_clashing_columns_long_texts_and_repeated_rows(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, "bb", 40), "bb", "s", float(i)) for i in range(60)]
    rows += [(100, prose(rng, "bb", 60_000), "bb", "long", 1.0)] * 2
    rows += [(101, "# % & " * 400, None, "junk", 2.0), (102, None, None, None, None)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, key string, score double").repartition(3)
    good = quality.kept(df, quality.train(df))
    known = language.kept(df, language.train(df), corpus_pipeline.LEAST_LANGUAGE_SCORE)
    assert good.columns == known.columns == df.columns
    for left in (good, known):
        ids = sorted(r["doc_id"] for r in left.collect())
        assert [i for i in ids if i < 101] == [*range(60), 100, 100] and 101 not in ids
    assert 102 not in {r["doc_id"] for r in known.collect()}
