"""Operators that compare documents, against plain versions."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import fingerprints, setsketch, suffix_dedup, topk
from tablewright.shared import intermediate

# --- repeated strings -------------------------------------------------------------------


def plain_removal(texts, window=200):
    """Spans to remove of every byte string."""
    counts = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    found = []
    for t in texts:
        spans = []
        for i in range(len(t) - window + 1):
            if counts[t[i:i + window]] > 1:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        found.append([tuple(s) for s in spans])
    return found


def corpus(seed, documents=30):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ") for _ in range(6)) for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(3)]
    texts = []
    for _ in range(documents):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        for passage in passages:
            if rng.random() < 0.4:
                begin, end = sorted(rng.sample(range(len(passage)), 2))
                text += rng.choice(words) + passage[begin:end] + rng.choice(words)
        texts.append(text)
    texts += [texts[0], "ab" * 300, "a" * 700, "ab" * 120, None, "", "x" * 199, "q" * 200,
              "é" * 150, passages[0] + passages[1] + passages[0]]
    return texts


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_spans_equal_plain_removal(spark, crowd):
    texts = corpus(5)
    data = [(t or "").encode() for t in texts]
    df = spark.createDataFrame(
        [(i % 37 if i != 3 else None, t, "x") for i, t in enumerate(texts)],
        "doc_id long, text string, spans string").repartition(4)
    found = suffix_dedup.repeated_spans(df, crowd=crowd)
    rows = found.collect()
    expected = sorted((t or "", s) for t, s in zip(texts, plain_removal(data), strict=True))
    assert sorted((r["text"] or "", [tuple(s) for s in r["spans"]]) for r in rows) == expected
    kept = suffix_dedup.removed(found).select("text", "spans", F.sha2("kept", 256).alias("h"))
    for r in kept.collect():
        rest, end = b"", 0
        whole = (r["text"] or "").encode()
        for s in r["spans"]:
            rest, end = rest + whole[end:s["begin"]], s["end"]
        assert hashlib.sha256(rest + whole[end:]).hexdigest() == r["h"]


def test_repeated_spans_of_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "z y" * 80), (1, "z y" * 80), (2, "short")],
                               "doc_id long, text string")
    rows = suffix_dedup.repeated_spans(df).collect()
    assert sorted(len(r["spans"]) for r in rows) == [0, 1, 1]
    assert suffix_dedup.repeated_spans(df.limit(0)).count() == 0


def test_repeated_spans_hold_one_step_on_disk(spark, monkeypatch):
    """Shuffle files and tables of all steps stayed until the end, 4 x the input (F1)."""
    df = spark.createDataFrame(
        list(enumerate(corpus(6))), "doc_id long, text string").repartition(4)
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    whole, held = suffix_dedup.written, []

    def counted(table, label, **options):
        before = shuffles.size()
        found = whole(table, label, **options)
        held.append(shuffles.size() - before)
        return found

    monkeypatch.setattr(suffix_dedup, "written", counted)
    with intermediate(spark) as folder:
        rows = suffix_dedup.repeated_spans(df).collect()
        left = [name.split("-")[0] for name in os.listdir(folder)]
    assert any(r["spans"] for r in rows)
    assert left == ["spans"]
    assert all(kept <= 0 for kept in held)


def test_stripped_keeps_columns_and_whole_characters(spark):
    passage = "é" * 150
    df = spark.createDataFrame(
        [(1, "a" + passage + " tail", 5, "k"), (2, passage + "z", 6, "l"), (3, None, 0, "m"),
         (4, passage, 7, "n")], "doc_id long, text string, n_chars int, spans string")
    found = {r["doc_id"]: r for r in suffix_dedup.stripped(df).collect()}
    assert suffix_dedup.stripped(df).columns == df.columns
    assert found[1]["text"] == "a tail" and found[1]["n_chars"] == 6 and found[1]["spans"] == "k"
    assert found[2]["text"] == "z" and found[3]["text"] is None and 4 not in found


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=6), max_size=7))
def test_loser_tree_merges_with_right_prefixes(runs):
    inputs = []
    for run in runs:
        run.sort()
        shared, rests = suffix_dedup.front_coded(run)
        inputs.append(suffix_dedup._Run(shared, rests, list(run)))
    found = list(suffix_dedup.merged(inputs))
    expected = sorted(x for run in runs for x in run)
    assert [value for value, _, _ in found] == expected
    last = b""
    for value, shared, payload in found:
        assert payload == value
        assert shared == suffix_dedup.common_prefix(last, value)
        last = value


# --- near duplicates --------------------------------------------------------------------

def plain_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))]


def near_corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 90))]
        for _ in range(25):  # copies with more or fewer edits: links, chains and near misses
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[0], None, "", "one", "ONE", "one two", " \t\n", "é É",
              "w1 " * 5000, "w1 " * 4000]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("words, blocks", [(2, 64), (5, 64), (2, 0)])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, words, blocks):
    monkeypatch.setattr(setsketch, "CROWD_BLOCKS", blocks)
    rows = near_corpus(words)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class string")
    found = setsketch.near_duplicates(df, setsketch.Similar(words=words, block=20))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                 for r in found.collect())
    expected = sorted((*r, r[0] == r[2]) for r in plain_components(rows, words, 80))
    assert got == expected
    first = setsketch.first_of_each(df, setsketch.Similar(words=words, block=20))
    assert first.columns == df.columns
    blank = {i for i, t in rows if not (t or "").split(None)}
    assert {r["doc_id"] for r in first.collect()} == {r[0] for r in expected if r[3]} | blank


def test_near_duplicates_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "x"), (3, "x"), (4, "y z"),
                                (None, "q r"), (None, None)], "doc_id long, text string")
    found = setsketch.near_duplicates(df).collect()
    assert len(found) == 7 and {r["component_id"] for r in found} == {None, 3, 4}
    kept = sorted(str(r["text"]) for r in setsketch.first_of_each(df).collect())
    assert kept == ["None", "a b c", "q r", "x", "y z"]
    assert setsketch.near_duplicates(df.limit(0)).count() == 0


def test_likelihood_estimates_the_similarity():
    model, rng = setsketch.Sketch(200), np.random.default_rng(1)
    errors = []
    for j in np.linspace(0.1, 0.9, 40):
        pool = rng.integers(0, 1 << 63, 4000, np.uint64)
        n = 1500
        both = int(2 * n * j / (1 + j))
        a, b = pool[:n], np.concatenate([pool[:both], pool[n:2 * n - both]])
        true = both / (2 * n - both)
        found = model.likely(model(a)[None], model(b)[None], np.array([n]), np.array([n]))[0]
        errors.append(found - true)
    assert np.abs(errors).max() < 0.15 and abs(np.mean(errors)) < 0.02


def test_sketches_merge_by_maxima():
    model, rng = setsketch.Sketch(64), np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (50, 900))
    assert (np.maximum(model(a), model(b)) == model(np.concatenate([a, b]))).all()


# --- top k ------------------------------------------------------------------------------

def plain_top(rows, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i] = [int(np.floor(256 * x)) for x in v]
    found = []
    for q, v in vectors.items():
        if q % 50 == 0:
            scored = sorted((-sum(map(int.__mul__, v, w)), i) for i, w in vectors.items()
                            if i != q and len(w) == len(v))[:k]
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(found)


@pytest.mark.parametrize("count,lists", [(260, 2), (4, 3), (120, 4)])
def test_top_k_equals_all_scores(spark, count, lists):
    rng = np.random.default_rng(count)
    rows = [(i, [float(x) for x in rng.normal(size=7)]) for i in range(count)]
    rows += [(1000 + i, rows[1][1]) for i in range(30)]  # ties among equal vectors
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 5), (2100, [float("inf")] + [0.0] * 6),
             (2150, [1.0, 2.0]), (2200, [2.0, 1.0]), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id long, embedding array<float>, q string")
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, lists=lists, query_block=3,
                       candidate_block=40)
    assert sorted(map(tuple, found.collect())) == plain_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- fingerprints -----------------------------------------------------------------------

def test_edits_follow_the_descending_order(spark):
    texts = ["abcdefghi", "", None, "é" * 10, "one two three", "x", "one two three", "ab 🙂 cd"]
    df = spark.createDataFrame([(i * 3, t, "p") for i, t in enumerate(texts)],
                               "doc_id long, text string, part string")
    found = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    for i, text in enumerate(texts):
        text, after = text or "", texts[i - 1] or ""  # of the first: the last
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        assert found[i * 3]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i * 3]["n_chars"] == len(text)
    assert found[12]["samples"] == found[18]["samples"] and found[3]["samples"] is None
    assert fingerprints.edited_fingerprints(df.limit(0)).count() == 0
    repeated = df.union(df).union(spark.createDataFrame([(None, "n", "")], df.schema))
    assert fingerprints.edited_fingerprints(repeated).count() == 17


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rng = random.Random(2)
    rows, expected = [], 0.0
    for i in range(120):
        own = [f"{letter}{i}" for letter in "abcdefghijklmnop"]  # else all texts share draws
        words = [rng.choice(own) for _ in range(30)]
        other = words[:rng.randint(5, 30)] + [rng.choice(own) for _ in range(8)]
        a, b = Counter(words), Counter(other)
        expected += sum((a & b).values()) / sum((a | b).values())
        rows.append((i, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "i long, a string, b string")
    a = fingerprints.samples_of(df, ["i"], "a").withColumnRenamed("samples", "x")
    b = fingerprints.samples_of(df, ["i"], "b").withColumnRenamed("samples", "y")
    found = a.join(b, "i").select(F.avg(fingerprints.likeness(F.col("x"), F.col("y")))).first()[0]
    assert abs(found - expected / 120) < 0.03


def signed(number):
    return number - (1 << 64) if number >> 63 else number


def plain_samples(text, samples):
    """Every term drawn for every sample with the same random numbers, none left out."""
    counts = Counter(signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) & -2
                     for w in re.split(r"[\s\u00a0\u2028\u3000]+", text) if w)
    if not counts:
        return None
    found = []
    for k in range(samples):
        drawn = []
        for term, weight in counts.items():
            first = xxhash.xxh64((term ^ random.Random(k).getrandbits(63)).to_bytes(
                8, "little", signed=True), seed=42).intdigest()
            second = xxhash.xxh64(first.to_bytes(8, "little"), seed=42).intdigest()
            u = ((first & (1 << 31) - 1) + 0.5) / 2 ** 31 * (((first >> 33) + 0.5) / 2 ** 31)
            v, b = (((second & (1 << 21) - 1) + 0.5) / 2 ** 21
                    * (((second >> 21 & (1 << 21) - 1) + 0.5) / 2 ** 21),
                    ((second >> 42 & (1 << 21) - 1) + 0.5) / 2 ** 21)
            r = -math.log(v)
            t = math.floor(math.log(weight) / r + b)
            name = (term ^ t * 2654435761) & (1 << 32) - 1
            order = math.log(-math.log(u)) - r * (t - b) - r
            drawn.append((math.floor((order + 128) * (1 << 22)), name))
        found.append(min(drawn)[1])
    return found


def test_fingerprints_equal_a_plain_sampler(spark):
    rng = random.Random(12)
    words = [rng.choice("abcdeé漢") * rng.randint(1, 3) + str(i) for i in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 80, 300]))) for _ in range(30)]
    texts += [" ".join(f"w{i % 30_000}" for i in range(40_000)), "same " * 9000, None, "\n \t"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, total string").repartition(3)
    found = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df, samples=8).collect()}
    for i, text in enumerate(texts):
        text, after = text or "", texts[i - 1] or ""
        m = len(text) // 3
        assert found[i]["samples"] == plain_samples(text, 8)
        assert found[i]["edited_samples"] == plain_samples(text[:len(text) - m] + after[:m], 8)
        assert found[i]["next_samples"] == plain_samples(after, 8)


def test_terms_of_both_texts_are_counted_in_compiled_code(spark):
    texts = ["a b a", "a a b c", "", " a\u00a0a ", "\n \t", "x", None, "b b a a"]
    df = spark.createDataFrame(
        [(i, t, texts[i - 1]) for i, t in enumerate(texts)], "i long, a string, b string")
    terms = fingerprints.weighted_terms(df, ["i"], "a", "b")
    expected = set()
    for i, text in enumerate(texts):
        one, two = (Counter(signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) & -2
                            for w in re.split(r"[\s\u00a0]+", t or "") if w)
                    for t in (text, texts[i - 1]))
        for term in one | two:
            sides = [(one[term], one.total(), None), (two[term], None, two.total())]
            if one[term] == two[term]:
                sides = [(one[term], one.total(), two.total())]
            expected |= {(i, term, *side) for side in sides if side[0]}
    found = [tuple(r) for r in terms.collect()]
    assert {r for r in found if r[1] is not None} == expected
    assert len([r for r in found if r[1] is not None]) == len(expected)
    assert {i for i, *_ in found} == set(range(len(texts)))  # no row without a term
    assert "lambda" not in terms._jdf.queryExecution().optimizedPlan().toString()


def test_fingerprints_run_without_python(spark):
    df = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = fingerprints.edited_fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
