"""Operators that treat every text by itself, against libraries and plain versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import byte_bpe, language, licenses, packing, quality, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MARK = token_counts.MARK
PIECES = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "\n\n", "don't  stop\n\n  x'll", "naïve Üñî ﬁ 漢字 🙂 é",
    "a", "word " * 3000, "x" * 5000, "The cat sat. " * 40, "The cat sat. " * 40,
    "tab\tand\x0bother\x0cspace kinds ", "1234 5678 --- *** $$$", "'S 's 'LL",
]
#: Columns with the names that operators use inside.
CLASHING = ["key", "block", "row", "hash", "ids", "class", "size", "part", "score", "rank"]


def frame(spark, texts=TEXTS):
    rows = [(i if t != " " else None, t, *["c"] * len(CLASHING)) for i, t in enumerate(texts)]
    rows += rows[-1:] if rows else []  # a repeated row
    return spark.createDataFrame(
        rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    ).repartition(3)


def test_bpe_equals_the_library_and_round_trips(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    expected = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(frame(spark), RANKS, public_tokenizers.PATTERN), RANKS)
    rows = [(r["ids"], bytes(r["decoded"])) for r in found.collect()]
    texts = [t or "" for t in [*TEXTS, TEXTS[-1]]]
    assert sorted(rows) == sorted((expected.encode_ordinary(t), t.encode()) for t in texts)
    digest = found.select(byte_bpe.ids_digest(found["ids"]).alias("d")).collect()
    assert sorted(r["d"] for r in digest) == sorted(
        hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for i, _ in rows)


def test_bpe_of_an_empty_table(spark):
    empty = frame(spark).limit(0)
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).collect() == []


def unigram_model():
    """The library's own unigram segmentation over the same pieces and scores."""
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    proto.ParseFromString(open(PIECES, "rb").read())
    proto.trainer_spec.model_type = model.TrainerSpec.UNIGRAM
    for piece in proto.pieces:
        piece.score = max(piece.score, token_counts.LEAST_SCORE)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_token_counts_equal_the_library():
    library = unigram_model()
    segmenter = token_counts.Segmenter(token_counts.pieces_of(PIECES))
    rng = random.Random(4)
    words = "the of and station inner thing éclair über 漢 x1 ing naïve".split()
    for _ in range(200):
        text = " ".join(rng.choice(words) + rng.choice(["", "s", "ly", ","])
                        for _ in range(rng.randint(1, 12)))
        assert segmenter.count(text)[0] == len(library.encode(text))


def test_token_counts_of_all_documents_equal_the_library():
    library = unigram_model()
    segmenter = token_counts.Segmenter(token_counts.pieces_of(PIECES), remembered=30_000)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    texts += ["thely " * 20_000, "漢ï " * 3000, "a\nb\t" * 500]
    expected = [len(ids) for ids in library.encode([t or "" for t in texts])]
    assert [segmenter.count(t or "")[0] for t in texts] == expected


def test_words_know_how_large_sums_may_get():
    """The lead of the best path, in sums whose rounding it outlasts, is kept with the word."""
    rng = random.Random(8)
    pieces = {a: -float(rng.randint(1, 50)) for a in ["a", "b", "ab", "ba", "bab", "aab", "bb"]}
    segmenter = token_counts.Segmenter(pieces)

    def paths(word):
        if not word:
            return [(0.0, 0)]
        found = [(s + pieces[word[:n]], t + 1) for n in range(1, len(word) + 1)
                 if word[:n] in pieces for s, t in paths(word[n:])]
        if word[0] not in segmenter.single:
            found += [(s + segmenter.unknown, t + len(word[0].encode())) for s, t in paths(word[1:])]
        return found

    for _ in range(200):
        word = "".join(rng.choices("aabbbé", k=rng.randint(2, 8)))
        best, *others = sorted((s for s, _ in paths(word)), reverse=True)
        tokens, score, scores, largest = segmenter.path(word)
        assert score == best == sum(scores) and (best, tokens) in paths(word)
        lead = best - max(others, default=-np.inf)
        assert largest == lead / (2 * (len(word) + 1) * 2.0 ** -23)


def test_rounded_sums_of_words_equal_those_of_the_whole_text():
    rng = random.Random(6)
    pieces = {MARK + a: -rng.choice([3e6, 7e6 + 1, 1e5 + 3, 0.5]) for a in ["", "a", "ab", "b", "aba"]}
    pieces |= {a: -rng.choice([1.0, 2.0, 1e6, 5e6 + 3]) for a in ["a", "b", "ab", "ba", "bab"]}
    for pieces in (pieces, {p: float(round(v)) for p, v in pieces.items()}):
        segmenter = token_counts.Segmenter(pieces, remembered=300)
        for _ in range(300):
            text = " ".join("".join(rng.choices("abc", k=rng.randint(0, 5)))
                            for _ in range(rng.randint(1, 80))) or "c"
            assert segmenter.count(text) == segmenter.solve(MARK + text.replace(" ", MARK))[:2]


def test_segmentation_equals_all_segmentations():
    pieces = {"▁": -2.0, "a": -3.0, "b": -3.0, "ab": -4.0, "▁a": -3.0, "ba": -4.0, "▁ab": -6.0}
    segmenter = token_counts.Segmenter(pieces)

    def best(text):
        """Score, then the longest last piece, then the longest one before it, and so on."""
        if not text:
            return (0.0,)
        options = []
        for p in pieces:
            if text.endswith(p):
                score, *lengths = best(text[:-len(p)])
                options.append((score + pieces[p], len(p), *lengths))
        if text[-1] not in pieces:
            score, *lengths = best(text[:-1])
            options.append((score + segmenter.unknown, 1, *lengths))
        return max(options)

    rng = random.Random(1)
    for _ in range(300):
        text = "▁" + "".join(rng.choice("abc▁") for _ in range(rng.randint(0, 9)))
        score, *lengths = best(text)
        assert segmenter.solve(text)[:2] == (len(lengths), score)


def test_token_counts_of_odd_rows(spark):
    found = token_counts.token_counts(frame(spark), PIECES)
    rows = found.collect()
    assert len(rows) == len(TEXTS) + 1 and found.columns == ["doc_id", "n_tokens", "best_score"]
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_tokens"] == by_id[1]["n_tokens"] == 0
    assert by_id[6]["n_tokens"] >= 1
    assert token_counts.token_counts(frame(spark).limit(0), PIECES).count() == 0


# --- packing ----------------------------------------------------------------------------

@pytest.mark.parametrize("ranks", [None, public_tokenizers.path("byte_bpe_50k.tiktoken")])
def test_packing_places_every_piece(spark, ranks):
    found = packing.pack(frame(spark), VOCABULARY, 2, 64, ranks_file=ranks,
                         pattern=public_tokenizers.PATTERN).collect()
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 64
    for i, text in enumerate(TEXTS[:-1]):
        if text == " ":
            continue
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"])
                        for r in found if r["doc_id"] == i)
        assert [p[0] for p in pieces] == list(range(-(-len(ids) // 64)))
        end = 0
        for _, start, length, crc in pieces:
            assert start == end
            end += length
            assert crc == zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
        assert end == len(ids)
    repeated = [r for r in found if r["doc_id"] == len(TEXTS) - 1 and r["piece"] == 0]
    assert len(repeated) == 2
    empty = packing.pack(frame(spark).limit(0), VOCABULARY, 2, 64)
    assert empty.count() == 0


def test_packing_reads_special_tokens_as_the_library_does():
    library = Tokenizer.from_file(VOCABULARY)
    encode = packing.Encoder(VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                             public_tokenizers.PATTERN)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "é漢<|endoftext|>", "a <|endoftex|> b", "plain text"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
    assert 50256 in encode("a <|endoftext|> b")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_local_search_never_needs_more_bins(sizes):
    histogram = {s: sizes.count(s) for s in sizes}
    plan = packing.best_fit(histogram, 50)
    better = packing.local_search(plan, 50)
    for p in (plan, better):
        assert all(sum(pattern) <= 50 for pattern in p)
        used = {}
        for pattern, n in p.items():
            for size in pattern:
                used[size] = used.get(size, 0) + n
        assert used == histogram
    assert -(-sum(sizes) // 50) <= sum(better.values()) <= sum(plan.values())


def test_local_search_improves_on_best_fit():
    histogram = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2}  # 40 tokens: four bins of ten
    assert sum(packing.local_search(packing.best_fit(histogram, 10), 10).values()) == 4


def test_local_search_reaches_a_bin_behind_many_that_cannot_improve():
    stuck = {(size,): 1 for size in range(5001, 6101)}  # the emptiest, tried first
    plan = packing.Counter({**stuck, (475,) * 20: 1, (9525,): 20})
    better = packing.local_search(plan, 10_000)
    assert sum(better.values()) == sum(plan.values()) - 1
    assert sorted(s for p, n in better.items() for s in p * n) == sorted(
        s for p, n in plan.items() for s in p * n)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60))
def test_local_search_ends_only_when_nothing_improves(sizes):
    plan = packing.local_search(packing.Counter((s,) for s in sizes), 60)
    assert packing.Counter(s for p, n in plan.items() for s in p * n) == packing.Counter(sizes)
    if sum(plan.values()) > -(-sum(sizes) // 60):
        for source in plan:
            for target in plan:
                if sum(target) >= sum(source) and (target != source or plan[source] > 1):
                    assert not packing._exchange(target, source, 60 - sum(target))[0]


def test_both_tokenizer_libraries_agree_on_common_characters():
    """The faster library stands in only for texts of these characters."""
    encoder = packing.Encoder(
        VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for code in range(0x3000):
        text = f"a{chr(code)}b {chr(code)}1{chr(code)}{chr(code)}"
        assert encoder(text) == encoder.slow(text)


# --- licences ---------------------------------------------------------------------------

LICENSED = [
    "Released under the MIT License. See the mit\nlicense!", "GNU General Public License v3",
    "CC BY-SA 4.0 and licensed under CC-BY-SA", "no licence", None, "", "apache_license",
    "ÄMIT License", "mit  License MIT license mit", "Permission is hereby granted, free of charge"
    ", to any person obtaining a copy of this software", "the the the Apache License, Version 2.0",
    "K" * 4000 + " mit license",
]


def test_license_base_places_equal_plain_search(spark):
    df = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(LICENSED)], "doc_id long, text string, words string")
    found = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in enumerate(LICENSED):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))
        expected = sorted(
            (label, at) for phrase, label in licenses.PHRASES.items() for at in range(len(words))
            if words[at:at + len(phrase.split())] == phrase.split())
        places = sorted((p["label"], p["first"]) for p in found[i]["places"] if p["base"])
        assert places == expected
        assert found[i]["n_words"] == len(words)
        assert 0 <= found[i]["score"] <= 1 and set(x for x, _ in expected) <= set(found[i]["labels"])
    assert found[2]["labels"] == ["cc-by", "cc-by-sa"]
    assert found[9]["labels"] == ["mit"] and not [p for p in found[9]["places"] if p["base"]]
    assert licenses.scan(df.limit(0)).count() == 0


def test_license_scan_runs_without_python(spark):
    df = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- language ---------------------------------------------------------------------------

STEMS = {"xx": ["kor", "vak", "tul", "ark"], "yy": ["ina", "elo", "omi", "aue"]}


def sentence(rng, lang, words=30):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3)))
                    for _ in range(words))


def test_language_of_unseen_and_switched_texts(spark):
    rng = random.Random(3)
    texts = [(lang, sentence(rng, lang)) for lang in ("xx", "yy") for _ in range(40)]
    model = language.fit([t for _, t in texts], [lang for lang, _ in texts], buckets=1 << 12)
    switched = sentence(rng, "xx", 20) + " " + sentence(rng, "yy", 25)
    rows = [(0, sentence(rng, "xx")), (1, sentence(rng, "yy")), (2, None), (3, "12 + 3"),
            (4, switched), (5, sentence(rng, "yy", 5000)), (None, ""), (None, "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, score string")
    found = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    assert [found[i]["lang_pred"] for i in range(4)] == ["xx", "yy", "und", "und"]
    assert found[2]["score"] == 0 and 0.9 < found[0]["score"] <= 1
    spans = [(s["lang"], s["first"], s["words"]) for s in found[4]["spans"]]
    assert spans == [("xx", 0, 20), ("yy", 20, 25)]
    assert found[5]["lang_pred"] == "yy" and found[5]["n_words"] == 5000
    assert language.identify(df.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language.identify(df, None).collect()} == {"und"}


def test_marginals_equal_all_labellings():
    """Forward-backward, over several blocks of a text, against sums over all paths."""
    rng = np.random.default_rng(2)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)),
                           rng.normal(size=3))
    lengths = np.array([1, 5, language._STEP + 3, 7])
    scores = rng.normal(size=(lengths.sum(), 3))
    found = language.marginals(scores, lengths, model)
    at = 0
    for n in lengths:
        own = scores[at:at + n]
        start = np.exp(model.start - model.start.max())
        start /= start.sum()
        before = start @ np.exp(model.transitions)
        alpha = [before * np.exp(own[0])]
        for x in own[1:]:
            alpha.append((alpha[-1] @ np.exp(model.transitions)) * np.exp(x))
        beta = [np.ones(3)]
        for x in own[:0:-1]:
            beta.insert(0, np.exp(model.transitions) @ (np.exp(x) * beta[0]))
        expected = np.array(alpha) * np.array(beta)
        expected /= expected.sum(axis=1, keepdims=True)
        assert np.allclose(found[at:at + n], expected, atol=1e-8)
        at += n


def test_training_without_rows_gives_no_model(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, "text", None)],
                               "doc_id long, text string, lang string")
    assert language.train(df) is None


# --- quality ----------------------------------------------------------------------------

def test_quality_separates_junk_from_prose(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(["ka", "lo", "mi", "en", "st"]) for _ in range(3))
                  for _ in range(400)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(60)) + "." for _ in range(150)]
    junk = [rng.choice([w.upper() + "!! " for w in vocabulary[:20]]) * 40 for _ in range(15)]
    junk += [" ".join(rng.choice(vocabulary) + "***" for _ in range(50)) for _ in range(15)]
    rows = [(i, t, "x") for i, t in enumerate([*prose, *junk, None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string, votes string")
    scorer = quality.train(df)
    found = {r["doc_id"]: r for r in quality.classify(df, scorer).collect()}
    assert all(found[i]["keep"] for i in range(150))
    assert not any(found[i]["keep"] for i in range(150, 182))
    assert {r["doc_id"] for r in quality.kept(df, scorer).collect()} == set(range(150))
    assert all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in found.values())
    empty = df.limit(0)
    assert quality.classify(empty, quality.train(empty)).count() == 0


def test_estimated_accuracies_follow_the_votes():
    names = list(quality.LABELLERS)
    good = quality.GOOD * len(names)
    bad = quality.BAD * 3 + quality.GOOD * (len(names) - 3)
    model = quality.estimate({good: 90, bad: 10})
    assert 0.85 < model.prior < 0.95
    assert model.posterior(good) > 0.95 and model.posterior(bad) < 0.05
    assert model.posterior(quality.SILENT * len(names)) == pytest.approx(model.prior)


def test_characters_outlines_and_facts_are_looked_at_once(monkeypatch):
    rng = random.Random(21)
    ranges = [(33, 127), (33, 127), (0x80, 0x600), (0x2000, 0x3100), (0x1F000, 0x1FB00)]
    words = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randint(1, 9)))
             for _ in range(3000)]
    words = " ".join([*words, "\ud800x", "Plain", "Other", "plain,", "other.", "x_1²"]).split()
    text = " ".join(words)
    kinds = quality.kinds_of(text)
    letters = sum(c.isalpha() for c in text)
    assert kinds[quality._UPPER] == sum(c.isalpha() and c.isupper() for c in text)
    assert kinds[quality._LETTER] + kinds[quality._UPPER] == letters
    assert kinds[quality._DIGIT] == sum(c.isdigit() and not c.isalpha() for c in text)
    assert sum(kinds) == len(text) and kinds[quality._SPACE] == text.count(" ")
    expected = [tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % 1000
                      for x in ("w:" + w.lower(), "s:" + quality.shape(w))) for w in words]
    calls, plain = [], quality.shape
    monkeypatch.setattr(quality, "shape", lambda word: calls.append(word) or plain(word))
    shapes = {}
    assert [quality._buckets(w, 1000, shapes) for w in words + words] == expected * 2
    assert len(calls) == len(set(calls)) == len(shapes) < len(set(words))

    scorer = quality.fit_scorer([text, "plain words " * 30], quality.estimate({"." * 10: 2}), 1000)
    counts = Counter(words)
    facts = quality.facts_of(text, words, counts)
    score = scorer.score(words, counts, {})
    for name in ("insults_of", "_repeated"):
        monkeypatch.setattr(quality, name, None)  # with facts nothing is counted again
    assert scorer.score(words, counts, {}, facts) == score
