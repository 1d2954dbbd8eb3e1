"""Filter audit, mixing and centroid clustering, against plain versions."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import centroids, filter_audit, mixing

WHITE = re.compile(r"[^\x20\x09-\x0D]+")

# --- filter audit -----------------------------------------------------------------------


def plain_failures(rows):
    """Mask of every (doc_id, text, part), bit by bit."""
    smallest = {}
    for key, text, _ in rows:
        if key is not None:
            smallest[text or ""] = min(key, smallest.get(text or "", key))
    masks = []
    for key, text, _ in rows:
        text = text or ""
        words = WHITE.findall(text)
        masks.append(sum(bit for bit, failed in (
            (1, len(words) < 50), (2, 100 * len(set(words)) < 65 * len(words)),
            (4, 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)),
            (8, bool(set("#$%&*|") & set(text))),
            (16, key is not None and key > smallest[text])) if failed))
    return masks


def plain_audit(rows, labels):
    good = {k for k, quality, _ in labels if quality == 1}
    toxic = {k for k, _, toxic in labels if toxic == 1}
    parts = defaultdict(list)
    for (key, _, part), mask in zip(rows, plain_failures(rows), strict=True):
        parts[part or ""].append((mask, key in good, key in toxic))
    found = {}
    for part, documents in parts.items():
        sums = Counter()
        for order in itertools.permutations("ABCDE"):
            left = documents
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                removed = [d for d in left if d[0] & bit]
                left = [d for d in left if not d[0] & bit]
                failing = sum(bool(d[0] & bit) for d in documents)
                sums[letter] += len(removed)
                found[part, "".join(order), step] = [
                    len(left), len(removed), failing - len(removed),
                    sum(d[0] == bit for d in documents), sum(d[1] for d in removed),
                    sum(d[2] for d in removed)]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return found


def audit_rows(seed, size=120):
    rng = random.Random(seed)
    words = [rng.choice(["ab", "Cd", "e", "FGH", "é", "ij\x00", "x#", "漢"]) + str(i) for i in range(80)]
    texts = [None, "", " \t\n", "A", "one two " * 40, "Z" * 9 + " y" * 60, "  x " + "y\x0bz " * 30]
    texts += [rng.choice([" ", "\n", " \r\n"]).join(rng.choices(words, k=rng.randint(1, 90)))
              for _ in range(40)]
    rows = [(rng.choice([None, *range(50)]) if rng.random() < 0.2 else i, rng.choice(texts),
             rng.choice([None, "", "src", "Ä", "hot", "hot", "hot"])) for i in range(size)]
    rows += rows[:10] + [(1000 + i, "copy", "hot") for i in range(60)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, size, 2)]
    return rows, labels + labels[:5] + [(None, 1, 1), (7, 1, 1), (7, 0, 0)]


def test_audit_equals_plain_filtering_in_every_order(spark):
    rows, labels = audit_rows(3)
    # columns that clash with the names used inside
    df = spark.createDataFrame([(*r, 9, "m", 1, 1) for r in rows],
                               "doc_id long, text string, source string, mask int, part string, "
                               "key int, words int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.audit(df, marks).collect()}
    assert got == plain_audit(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_of_empty_tables_and_one_long_text(spark):
    schema, marks = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"
    assert filter_audit.audit(spark.createDataFrame([], schema),
                              spark.createDataFrame([], marks)).count() == 0
    long = " ".join(f"w{i}" for i in range(200_000)) + " |"
    rows = [(1, long, "s"), (2, long, "s")]
    got = filter_audit.audit(spark.createDataFrame(rows, schema), spark.createDataFrame([], marks))
    got = {tuple(r)[:3]: list(r)[3:] for r in got.collect()}
    assert got == plain_audit(rows, [])


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_level_swaps_meet_every_order_once(levels):
    order = list(range(levels))
    met = {tuple(order)}
    for level in filter_audit.level_swaps(levels):
        order[level], order[level + 1] = order[level + 1], order[level]
        assert tuple(order) not in met
        met.add(tuple(order))
    assert len(met) == math.factorial(levels)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.integers(1, 4), min_size=1),
       st.lists(st.integers(0, 2), max_size=8))
def test_swapped_diagram_equals_a_new_one(counts, swaps):
    counts = {m: (n, 0, n % 2) for m, n in counts.items()}
    diagram = filter_audit.Diagram(counts, "ABCD")
    for level in swaps:
        diagram.swap(level)
    letters = "".join(diagram.order)
    renamed = {sum(1 << i for i, c in enumerate(letters) if m >> "ABCD".index(c) & 1): n
               for m, n in counts.items()}
    fresh = filter_audit.Diagram(renamed, letters)
    assert diagram.root == fresh.root
    assert list(diagram.steps()) == list(fresh.steps())
    assert diagram.failing() == fresh.failing() == {
        c: tuple(map(sum, zip((0, 0, 0), *[n for m, n in counts.items() if m >> "ABCD".index(c) & 1])))
        for c in "ABCD"}


def test_equal_branches_are_one_node():
    counts = {m: (2, 1, 0) for m in range(16)}  # every branch alike: one node a level
    diagram = filter_audit.Diagram(counts, "ABCD")
    assert len(diagram._nodes) == 5
    diagram.swap(1)
    assert len(diagram._nodes) == 5


def test_filters_are_named_by_letters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        filter_audit.audit(empty, empty, {"AB": lambda text, words: F.lit(True)})


# --- mixing -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), most=3, budget=None):
    """Shares by weight; what exceeds a cap is shared again until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = sum(sizes.values()) if budget is None else budget
    found, open_sources = {}, set(order)
    while open_sources:
        whole = sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if left * weight[s] / whole > most * sizes[s] + 1e-9}
        if not above:
            return found | {s: left * weight[s] / whole for s in open_sources}
        for s in above:
            found[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in above)
        open_sources -= above
    return found


def mix_rows(seed, size=150):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + [None, "", "z", "é", "𝒳", "￿", "B", "a"]
    rows = [(rng.choice([None, i, i, i]), "w " * rng.choice([0, 1, 3, 20, rng.randint(0, 400)]),
             rng.choice(sources)) for i in range(size)]
    return rows + rows[:7] + [(1, None, "empty"), (2, "", "empty"), (500, "x\ty\x0bz", "tiny")]


def collected(spark, rows, parts, **options):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows],
                               "doc_id long, text string, source string, size string, target double")
    found = mixing.mix(df.repartition(parts), **options)
    return found, sorted(map(repr, found.by_document().collect()))


def test_sources_meet_their_targets_and_reruns_agree(spark):
    rows = mix_rows(1)
    found, documents = collected(spark, rows, 5)
    assert documents == collected(spark, rows, 2)[1]
    assert len(documents) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WHITE.findall(text or ""))
    expected, taken = plain_targets(sizes), Counter()
    for r in found.by_document().collect():
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) == sum(sizes.values())
    for source, target in expected.items():
        assert abs(taken[source] - target) <= len(sizes)


def test_mix_equals_plain_fair_queueing(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(mix_rows(2))]
    found, _ = collected(spark, rows, 3)
    targets = {r["source"]: (r["number"], r["target"]) for r in found.sources.collect()}
    budget = sum(len(WHITE.findall(t or "")) for _, t, _ in rows)
    served = []
    for source, (number, target) in targets.items():
        begin = 0
        queue = [(p, hashlib.md5(f"{p}:{i}:{hashlib.md5((t or '').encode()).hexdigest()}"
                                 .encode()).hexdigest(), i, len(WHITE.findall(t or "")))
                 for p in (1, 2, 3) for i, t, s in rows if s == source]
        for p, place, i, size in sorted(queue):
            words = min(size, math.ceil(target) - begin)
            if words > 0:
                served.append(((begin + words) / target, number, p, place, i, words))
            begin += size
    position, expected = 0, []
    for finish, _, p, _, i, words in sorted(served):
        words = min(words, budget - position)
        if words > 0:
            expected.append((i, p, position, words, round(finish, 9)))
        position += words
    got = sorted((r["position"], r["key"], r["pass"], r["words"], round(r["finish"], 9))
                 for r in found.taken.collect())
    assert [(k, p, at, w, f) for at, k, p, w, f in got] == expected


def test_no_pass_repeats_a_document_and_none_is_left_out_early(spark):
    rows = [(i, "w " * (1 + i % 5), "a" if i < 20 else "b") for i in range(120)]
    found, _ = collected(spark, rows, 4, weights=(5, 1))
    passes = defaultdict(set)
    for r in found.taken.collect():
        assert r["pass"] not in passes[r["key"]]
        passes[r["key"]].add(r["pass"])
    assert all(passes[i] == {1, 2, 3} for i in range(20))  # stopped at three times the size


@pytest.mark.parametrize("budget", [0, 1, 100, 10 ** 9])
def test_budget_is_met(spark, budget):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(20)]
    found, _ = collected(spark, rows, 2, budget=budget)
    assert (found.taken.agg(F.sum("words")).first()[0] or 0) == min(budget, 600)


def test_mix_of_nothing_and_of_one_long_text(spark):
    assert collected(spark, [], 1)[1] == []
    found, _ = collected(spark, [(1, None, None), (2, " ", "a")], 1)
    assert [r["taken"] for r in found.by_document().collect()] == [0, 0]
    found, _ = collected(spark, [(1, "w " * 300_000, "a"), (2, "w", "b")], 1)
    assert {r["key"]: r["taken"] for r in found.by_document().collect()} == {1: 299_998, 2: 3}


def test_running_totals_cross_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), rng.randint(0, 9), i, rng.randint(0, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, i int, v long").repartition(6)
    got = {r["i"]: (r["t"], r["n"]) for r in mixing.running_totals(
        df.withColumn("one", F.lit(1)), ["g"], ["o", "i"], t="v", n="one").collect()}
    sums, counts = Counter(), Counter()
    for g, _, i, v in sorted(rows):
        assert got[i] == (sums[g], counts[g])
        sums[g] += v
        counts[g] += 1


# --- centroid clustering ----------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, scale=256):
    """Every vector compared with every centroid in every round."""
    kept = [(k, [math.floor(scale * x) for x in v]) for k, v in rows]
    start = sorted((k is None, hashlib.sha256(f"2:{k}".encode()).hexdigest() if k is not None else "",
                    v) for k, v in kept)
    centres = np.array([v for *_, v in start[:clusters]], object)
    vectors = np.array([v for _, v in kept], object)
    for i in range(rounds + 1):
        every = np.array([[((v - c) ** 2).sum() for c in centres] for v in vectors])
        own = every.argmin(1)
        if i < rounds:
            for c in range(len(centres)):
                if (own == c).any():
                    centres[c] = vectors[own == c].sum(0) // int((own == c).sum())
    return sorted((repr(k), int(c), int(every[i, c]), [int(x) for x in centres[c]])
                  for i, ((k, _), c) in enumerate(zip(kept, own, strict=True)))


def vector_rows(seed, size, dimensions, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dimensions))
    rows = [(i, (centres[i % 6] + spread * rng.normal(size=dimensions)).tolist())
            for i in range(size)]
    return rows + rows[:5] + [(i + size, rows[0][1]) for i in range(5)] + [(None, rows[1][1])] * 2


@pytest.mark.parametrize("seed, dimensions, clusters, rounds", [
    (1, 8, 12, 5), (2, 2, 5, 8), (3, 8, 1, 3), (4, 3, 500, 2)])
def test_clusters_equal_plain_rounds(spark, seed, dimensions, clusters, rounds):
    rows = vector_rows(seed, 180, dimensions)
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0] * (dimensions - 1), [nan] * dimensions, [inf] * dimensions,
           [None] * dimensions, [1.0] * (dimensions + 1)]
    df = spark.createDataFrame(
        [(k, v, 1, 2.0) for k, v in rows + [(900 + i, b) for i, b in enumerate(bad)]],
        "vec_id long, embedding array<float>, cluster int, bound double").repartition(3)
    kept = [(r["vec_id"], r["embedding"]) for r in df.collect() if r["vec_id"] is None or r["vec_id"] < 900]
    found = centroids.cluster(df, clusters, rounds, dimensions).collect()
    assert sorted((repr(r["key"]), r["cluster"], r["distance"], r["centroid"]) for r in found) \
        == plain_clusters(kept, clusters, rounds)
    sums = Counter()
    for r in found:
        sums[r["cluster"]] += r["distance"]
    assert all(r["cluster_inertia"] == sums[r["cluster"]] and r["inertia"] == sum(sums.values())
               for r in found)


def test_bounds_spare_most_comparisons(spark):
    df = spark.createDataFrame(vector_rows(5, 600, 6, 0.05), "vec_id long, embedding array<double>")
    scans = [r["scans"] for r in centroids.cluster(df, 6, 9, 6).collect()]
    assert min(scans) >= 1 and sum(scans) < 0.5 * 10 * len(scans)


def test_extreme_components_and_empty_tables(spark):
    rows = [(1, [3e38, -3e38]), (2, [1.0, 2.0]), (3, [3e38, 3e38]), (4, [-3e38, -3e38])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = centroids.cluster(df, 1, 1, 2).collect()
    assert len(found) == 4 and max(r["distance"] for r in found) > 1 << 54
    assert centroids.cluster(df.limit(0), 3, 2, 2).count() == 0
    assert centroids.cluster(df, 3, 2, 64).count() == 0  # no vector of that length


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_drift_bound_holds_for_every_point_and_tightens(seed):
    rng = np.random.default_rng(seed)
    dimensions = rng.integers(2, 6)
    spheres = rng.normal(size=(4, dimensions)) * 5
    radii = np.abs(rng.normal(size=4)) * rng.choice([0, 0.1, 1, 4])
    old = rng.normal(size=(7, dimensions)) * 5
    new = old + rng.normal(size=old.shape) * rng.choice([0, 0.01, 1, 5], size=7)[:, None]
    closer = centroids.drift_towards(spheres, radii, old, new)
    drift = np.sqrt(((new - old) ** 2).sum(1))
    assert (closer <= drift + 1e-6).all()
    for s in range(4):
        points = rng.normal(size=(200, dimensions))
        points /= np.sqrt((points ** 2).sum(1))[:, None]
        points = spheres[s] + points * radii[s] * rng.random(200)[:, None] ** 0.2
        gain = (np.sqrt(((points[:, None] - old) ** 2).sum(2))
                - np.sqrt(((points[:, None] - new) ** 2).sum(2))).max(0)
        assert (gain <= closer[s] + 1e-9).all()


def test_drift_away_raises_the_bound():
    closer = centroids.drift_towards(
        np.array([[0.0, 0.0]]), np.array([1.0]), np.array([[10.0, 0.0]]), np.array([[12.0, 0.0]]))
    assert closer[0, 0] < -1.9
