import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tablewright.functions import similarity
from tablewright.operators.consolidate import consolidate_names, name_mapping
from tablewright.operators import leaders
from tablewright.operators.leaders import absorb_blocks, absorb_edges


def _pairs(seed, count=1500, longest=70):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(count):
        a, b = ("".join(rnd.choices("abcü 𝒳", k=rnd.randint(0, longest))) for _ in range(2))
        if rnd.random() < 0.5:  # near copies: long common beginnings and ends
            b = list(a)
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randint(0, len(b))
                b[at:at + rnd.randint(0, 2)] = rnd.choices("abz", k=rnd.randint(0, 2))
            b = "".join(b)
        pairs.append((a, b))
    return pairs + [("", ""), ("", "a"), ("a" * 64, "a" * 65), ("ab" * 200, "ba" * 180)]


@pytest.mark.parametrize("seed, count, longest", [(1, 1500, 70), (2, 60, 400)])
def test_common_subsequences_equal_the_plain_recurrence(seed, count, longest):
    left, right = zip(*_pairs(seed, count, longest))
    found = similarity.common_subsequences(left, right)
    assert found.tolist() == [brute.common(a, b) for a, b in zip(left, right)]


@pytest.mark.parametrize("least", [1, 50, 85, 90, 100])
def test_early_exit_loses_no_score(least):
    left, right = zip(*_pairs(least, 600, 200))
    exact = [brute.percent(a, b) for a, b in zip(left, right)]
    found = similarity.indel_percents(left, right, least).tolist()
    assert found == [s if s >= least else -1 for s in exact]


def test_carries_cross_many_words_and_batches_split(monkeypatch):
    monkeypatch.setattr(similarity, "_TABLE_WORDS", 64)
    monkeypatch.setattr(similarity, "_BATCH_CHARACTERS", 4096)
    left, right = zip(*_pairs(9, 80, 300), ("x" * 700, "x" * 300 + "y" + "x" * 500))
    assert similarity.common_subsequences(left, right).tolist() == [
        brute.common(a, b) for a, b in zip(left, right)]
    assert len(similarity.common_subsequences([], [])) == 0


def test_long_texts_are_no_batches(monkeypatch):
    """Carries through the many words of long, nearly equal texts took passes over the whole
    batch, seconds for a pair of 15,000 characters (F8, F9, F11, F13)."""
    rnd = random.Random(5)
    left = ["".join(rnd.choices("abcdé 𝒳", k=rnd.randint(300, 900))) for _ in range(12)]
    right = []
    for text in left:
        chars = list("<" + text + ">")
        for _ in range(rnd.choice([1, 5, 40, 300])):
            chars[rnd.randrange(len(chars))] = rnd.choice("abxyz")
        right.append("".join(chars))
    monkeypatch.setattr(similarity, "_advance", None)
    expected = np.array([brute.percent(a, b) for a, b in zip(left, right)])
    for least in (0, 60, 95):
        found = similarity.indel_percents(left, right, least)
        assert found.tolist() == np.where(expected < least, -1, expected).tolist()


def test_scores(spark):
    rows = [("abc", "abc", 100), ("", "", 100), ("", "a", 0), ("abcd", "abed", 75), (None, "a", None),
            ("kitten", "sitting", 61)]
    df = spark.createDataFrame(rows, "a string, b string, s int")
    out = df.select("s", similarity.indel_score(F.col("a"), F.col("b")).alias("o")).collect()
    assert [r.o for r in out] == [r.s for r in out]


def test_sorted_tokens(spark):
    df = spark.createDataFrame([(" b\ta  B a ",)], "s string")
    assert df.select(similarity.sorted_tokens(F.col("s"))).first()[0] == "B a a b"


@pytest.mark.parametrize("seed", range(2))
def test_leaders_by_edges(spark, seed):
    rnd = random.Random(seed)
    nodes = list(range(40))
    pairs = {tuple(sorted(rnd.sample(nodes, 2))) for _ in range(rnd.choice([10, 40, 120]))}
    pairs |= {(i, i + 1) for i in range(10)}  # a chain
    edges = spark.createDataFrame([(a, b, a, 99) for a, b in pairs],
                                  "lo int, hi int, lo_rank int, score int")
    got = {r.node: r.leader for r in absorb_edges(edges).collect()}
    assert got == brute.leaders(nodes, lambda a, b: (a, b) in pairs)


@pytest.mark.parametrize("limit", [0, 12, 10 ** 6])
def test_leaders_by_components(spark, monkeypatch, limit):
    """Small components in tasks, giants in rounds, everything at once: all the same."""
    monkeypatch.setattr(leaders, "TASK_EDGES", limit)
    rnd = random.Random(limit)
    pairs = {(7 * b + x, 7 * b + y) for b in range(20) for x in range(6) for y in range(x + 1, 7)
             if rnd.random() < 0.4}
    pairs |= {(i, i + 1) for i in range(140, 170)}
    edges = spark.createDataFrame([(f"n{a:03}", f"n{b:03}", (a,), 99) for a, b in pairs],
                                  "lo string, hi string, lo_rank struct<r: int>, score int")
    got = {r.node: r.leader for r in absorb_edges(edges).collect()}
    nodes = sorted({n for p in pairs for n in p})
    expected = brute.leaders(nodes, lambda a, b: (a, b) in pairs)
    assert got == {f"n{a:03}": f"n{b:03}" for a, b in expected.items()}


def test_a_long_chain_takes_few_tables(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(leaders, "TASK_EDGES", 9_999)
    original = leaders.written
    monkeypatch.setattr(leaders, "written", lambda df, label: (tables.append(label), original(df, label))[1])
    chain = spark.range(10_000).selectExpr("id AS lo", "id + 1 AS hi", "id AS lo_rank", "99 AS score")
    other = spark.range(20_000, 20_400).selectExpr("id AS lo", "id + 1 AS hi", "id AS lo_rank", "99 AS score")
    both = leaders.components(chain.unionByName(other))
    assert {tuple(r) for r in both.groupBy("component").count().collect()} == {(0, 10_001), (20_000, 401)}
    assert len(tables) < 60
    tables.clear()
    got = absorb_edges(chain.limit(9_999)).collect()
    assert len(tables) < 5 and len(got) == 5_000
    assert all(r.node == r.leader + 1 and r.leader % 2 == 0 for r in got)


@pytest.mark.parametrize("few, head", [(0, 3), (0, 100), (10 ** 6, 3)])
def test_leaders_by_blocks(spark, monkeypatch, few, head):
    monkeypatch.setattr(leaders, "FEW_PAIRS", few)
    rnd = random.Random(head)
    blocks = [(b, n) for b in range(6) for n in rnd.sample(range(60), rnd.choice([4, 20, 45]))]
    members = {}
    for b, n in blocks:
        members.setdefault(b, set()).add(n)
    together = {(x, y) for m in members.values() for x in m for y in m if x < y}
    pairs = {p for p in together if (p[0] * 7 + p[1] * 3) % 11 < 3}
    table = spark.createDataFrame(sorted(pairs), "lo int, hi int")
    df = spark.createDataFrame([(b, n, n) for b, n in blocks], "block int, node int, rank int")

    def similar(candidates):
        return candidates.join(table, ["lo", "hi"]).withColumn("score", F.lit(100))

    got = {r.node: r.leader for r in absorb_blocks(df, similar, head).collect()}
    nodes = sorted({n for _, n in blocks})
    assert got == brute.leaders(nodes, lambda a, b: (a, b) in pairs)


def _names(seed, size):
    rnd = random.Random(seed)
    base = ["".join(rnd.choices("abcdefgh ", k=rnd.choice([1, 2, 3, 4, 6, 9, 15, 30, 70, 90])))
            for _ in range(size // 8)]

    def changed(name):
        name = list(name)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(name))
            name[at:at + rnd.randint(0, 1)] = rnd.choices("aBXz", k=rnd.randint(0, 1))
        return "".join(name)

    return [changed(rnd.choice(base)) for _ in range(size)] + ["", None, None]


@pytest.mark.parametrize("score, head", [(85, 256), (85, 16), (76, 64)])
def test_name_mapping_equals_the_sequential_rule(spark, monkeypatch, score, head):
    monkeypatch.setattr(leaders, "FEW_PAIRS", 0 if head < 256 else 10 ** 6)
    names = _names(score + head, 250) + [f"Anbieter {i:05}" for i in range(60)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.canonical for r in name_mapping(df, "name", score, head).collect()}
    assert got == brute.name_mapping(names, score)


@pytest.mark.parametrize("found", [2, 256])
def test_crowds_follow_the_sequential_rule(spark, monkeypatch, found):
    """Numbered names are similar to a few leaders; blocks of bigrams held nearly all of them (F10)."""
    monkeypatch.setattr(leaders, "CROWD_HEAD", 24)
    monkeypatch.setattr(leaders, "CROWD_LEADERS", found)
    monkeypatch.setattr(leaders, "FEW_PAIRS", -1)  # blocks would start with their heads
    tables = []
    monkeypatch.setattr(leaders, "written", lambda df, label: tables.append(label) or df.localCheckpoint())
    rnd = random.Random(3)
    names = [f"Customer#{i:09d}" for i in rnd.sample(range(2_000), 150)] + ["customer#000000001", "", "x"]
    df = spark.createDataFrame([(n,) for n in names + names[:9] + [None]], "name string")
    got = {r["name"]: r.canonical for r in name_mapping(df, "name").collect()}
    assert got == brute.name_mapping(names + names[:9], 85) and tables.count("leaders") > 1


def test_consolidation(spark):
    names = ["Stadtbibliothek Ulm"] * 3 + ["stadtbibliothek ulm", "Stadt bibliothek Ulm", "Archiv", None]
    df = spark.createDataFrame(list(enumerate(names)), "i int, company string")
    out = [r.company for r in consolidate_names(df, "company").orderBy("i").collect()]
    assert out == ["Stadtbibliothek Ulm"] * 5 + ["Archiv", None]


def test_threshold_out_of_range(spark):
    with pytest.raises(ValueError):
        name_mapping(spark.createDataFrame([("a",)], "n string"), "n", 50)


@pytest.mark.parametrize("seed", range(4))
def test_texts_by_beginnings_score_as_pairs(seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choices("abcé\U0001f600 ", k=rnd.choice([0, 1, 2, 5, 9, 30, 64, 65, 127, 128, 129, 150])))
             for _ in range(40)]
    texts += [t[:-1] + "x" for t in texts[:10]] + texts[:3]
    for some in (texts, texts[:1], []):
        for least in (0, 50, 85):
            compared = similarity.Beginnings(some, least)
            for text in [*texts[:8], "", "q", "abc", "z" * 64, "z" * 65]:
                expected = similarity.indel_percents([text] * len(some), some, least)
                assert compared.percents(text).tolist() == expected.tolist()


def test_numbered_names_share_their_beginnings():
    """Every name was compared character by character with every leader (F7)."""
    names = [f"customer#{i:09d}" for i in range(20_000, 30_000)]
    compared = similarity.Beginnings(names, 85)
    assert sum(len(symbols) for _, symbols, _, _ in compared.levels) < 1.2 * len(names)


def test_a_crowd_is_settled_in_few_rounds(spark, monkeypatch):
    """Few names were looked at for leaders, so that millions took more rounds than there are (F7)."""
    tables = []
    whole = leaders.written
    monkeypatch.setattr(leaders, "written", lambda df, label: tables.append(label) or whole(df, label))
    df = spark.range(40_000).selectExpr("format_string('Customer#%09d', id) AS name")
    found = name_mapping(df, "name").collect()
    assert len(found) > 39_900 and tables.count("leaders") == 1
