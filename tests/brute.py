"""Plain single-machine versions of the searches, to compare with on small data."""

import collections
import functools
import math
import re

from tablewright.rules import COMPANY_STOP_WORDS, DEFAULT_RULES, GRADE_IN_SALARY


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row
        row = [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
    return row[-1]


def percent(a, b):
    total = len(a) + len(b)
    return 100 if total == 0 else int((1 - (total - 2 * common(a, b)) / total) * 100)


def token_percent(a, b):
    return percent(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def leaders(order, similar):
    """``{absorbed: leader}`` of the sequential rule over nodes in rank order."""
    led, result = [], {}
    for node in order:
        leader = next((x for x in led if similar(x, node)), None)
        if leader is None:
            led.append(node)
        else:
            result[node] = leader
    return result


def name_mapping(names, score):
    counts = collections.Counter(n for n in names if n is not None)
    order = sorted(counts, key=lambda n: (-counts[n], n))
    absorbed = leaders(order, lambda a, b: percent(a.lower(), b.lower()) >= score)
    groups = collections.defaultdict(list)
    for node, leader in absorbed.items():
        groups[leader].append(node)
    mapping = {}
    for leader, members in groups.items():
        best = min([leader, *members], key=lambda n: (-counts[n], len(n), n))
        mapping |= {n: best for n in [leader, *members] if n != best}
    return mapping


def neighbours(rows, k=5, floor=0.0):
    """``rows`` of (rank, key, group, text) to undirected neighbour pairs; ``floor`` is the
    least cosine, or a function giving it for a group size."""
    groups = collections.defaultdict(list)
    for row in sorted(rows):
        groups[row[2]].append(row)
    pairs = set()
    for members in groups.values():
        n = len(members)
        least = floor(n) if callable(floor) else floor
        keys = [m[1] for m in members]
        everyone = {tuple(sorted((a, b))) for i, a in enumerate(keys) for b in keys[:i]}
        counts = []
        for *_, text in members:
            tokens = re.findall(r"\b\w\w+\b", text.lower())
            counts.append(collections.Counter(tokens + [" ".join(p) for p in zip(tokens, tokens[1:])]))
        df = collections.Counter(t for c in counts for t in c)
        vectors = []
        for c in counts:
            v = {t: f * (math.log((1 + n) / (1 + df[t])) + 1) for t, f in c.items() if df[t] <= 0.95 * n}
            norm = math.sqrt(sum(w * w for w in v.values()))
            vectors.append({t: w / norm for t, w in v.items()} if norm else {})
        if n <= k or not any(vectors):
            pairs |= everyone
            continue
        tokens = [tuple(re.findall(r"\b\w\w+\b", m[3].lower())) for m in members]
        for i in range(n):
            near = []
            for j in range(n):
                if i != j:
                    sim = sum(w * vectors[j].get(t, 0.0) for t, w in vectors[i].items())
                    same = tokens[i] == tokens[j]
                    sim = 1.0 if same else round(sim, 9)
                    if same or (sim > 0 and sim >= least):
                        near.append((-sim, j))
            for _, j in sorted(near)[: k - 1]:
                pairs.add(tuple(sorted((keys[i], keys[j]))))
    return pairs


# --- the pair checks as a table: what two records must meet, field by field -------------

FUZZY = DEFAULT_RULES.fuzzy_columns


def words_score(a, b):
    return token_percent(a, b)


def without_stop_words(name):
    return " ".join(functools.reduce(
        lambda text, word: text.replace(word, ""), COMPANY_STOP_WORDS, name.lower()).split())


def grade(salary):
    """Number and letters of a pay grade, or nothing."""
    return [(int(n), letters) for n, letters in re.findall(GRADE_IN_SALARY, salary.upper())[:1]]


def grades_fit(a, b):
    return all(
        abs(n - m) == 1 or n == m and (x in y or y in x)
        for n, x in grade(a) for m, y in grade(b))


def closeness(a, b):
    return 100 - min(100.0, 100 * abs(a - b) / DEFAULT_RULES.numeric_tolerance)


def long_enough(score, least):
    """A check that only texts of some length have to pass."""
    return lambda a, b: (
        min(len(a), len(b)) <= DEFAULT_RULES.min_compare_length or score(a, b) >= least)


def no_contradiction(a, b):
    return not any(
        {(s in a, t in b), (s in b, t in a)} & {(True, True)} for s, t in DEFAULT_RULES.contradictions)


#: column, how a value is read, what two values (both present) must meet
GATES = (
    (DEFAULT_RULES.salary_column, str, grades_fit),
    (DEFAULT_RULES.name_column, without_stop_words,
     long_enough(words_score, DEFAULT_RULES.company_score)),
    (DEFAULT_RULES.place_column, lambda v: v.lower().strip(),
     lambda a, b: percent(a, b) >= DEFAULT_RULES.place_score),
    (DEFAULT_RULES.description_column, str.lower,
     long_enough(words_score, DEFAULT_RULES.description_score)),
    (DEFAULT_RULES.description_column, str.lower, no_contradiction),
)

#: column, score of two values, least score; one of two values missing rejects the pair
SCORES = tuple(
    (c, words_score, DEFAULT_RULES.description_score if c == DEFAULT_RULES.description_column
     else DEFAULT_RULES.field_score) for c in FUZZY
) + tuple((c, closeness, DEFAULT_RULES.numeric_score) for c in DEFAULT_RULES.numeric_columns)


def accepted(a, b):
    """Probability of a pair of dict rows, or None."""
    def both(column):
        return a.get(column), b.get(column)

    if any((x or "") != (y or "") for x, y in map(both, DEFAULT_RULES.exact_columns)):
        return None
    for column, read, passes in GATES:
        if None not in both(column) and not passes(*map(read, both(column))):
            return None
    found = []
    for column, score, least in SCORES:
        missing = both(column).count(None)
        if missing == 1 or not missing and score(*both(column)) < least:
            return None
        if not missing:
            found.append(score(*both(column)))
    probability = int(sum(found) / len(found)) if found else DEFAULT_RULES.min_probability
    return probability if probability >= DEFAULT_RULES.min_probability else None


def dropped(rows, key, k=5, floor=0.0):
    """``{dropped: (kept, probability)}`` for dict rows."""
    rank = {r[key]: (-sum(v is not None for v in r.values()), r[key]) for r in rows}
    by_key = {r[key]: r for r in rows}
    texts = [
        (rank[r[key]], r[key], tuple(r.get(c) or "" for c in DEFAULT_RULES.exact_columns),
         " ".join(r.get(c) or "" for c in FUZZY if c in r))
        for r in rows
    ]
    score = {}
    for a, b in neighbours(texts, k, floor):
        p = accepted(by_key[a], by_key[b])
        if p is not None:
            score[frozenset((a, b))] = p
    order = sorted(by_key, key=rank.get)
    absorbed = leaders(order, lambda a, b: frozenset((a, b)) in score)
    return {n: (l, score[frozenset((n, l))]) for n, l in absorbed.items()}
