"""Quality classifier from weak labels.

Heuristic labellers vote on every whole text: good, bad, or no opinion.  How often each of
them is right is not known; expectation-maximisation estimates it, and the share of good
texts, from all votes of the corpus - on the counts of vote patterns, of which there are at
most 3^labellers however many documents there are.  The patterns' posteriors are soft labels
for a linear scorer on hashed features (words, word shapes, repetitions), which is fitted on
a bounded sample of rows (``sample_rows``) and scores every whole text.
"""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field as member

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import field, narrowed, rows_kept, text_blocks, texts_of

GOOD, BAD, SILENT = "+", "-", "."


# --- labellers --------------------------------------------------------------------------

@dataclass
class Facts:
    """What the labellers look at; ``words`` are separated by white space."""

    chars: int
    words: int
    symbols: int  # neither letter, digit nor white space
    digits: int
    letters: int
    upper: int
    decorated: int  # words that end in two or more symbols
    frequent: int  # places of the most frequent word
    repeated: int  # words equal to the word before
    distinct: int  # different words
    wordless: int  # words without a letter or digit
    insults: int  # places of words of the insult list


#: General insults of four languages, as separate words in any case: abuse, contempt, slurs on
#: intelligence.  A list in its nature is not complete; ambiguous words count as well.
INSULTS = frozenset("""
    idiot idiots idiotic moron morons moronic imbecile imbeciles cretin cretins dumbass dumb
    stupid fool fools dimwit halfwit loser losers clown clowns scum scumbag scumbags trash
    garbage vermin filth filthy pathetic worthless disgusting despicable repulsive pig pigs
    swine bastard bastards bitch bitches asshole assholes jerk jerks whore slut shit fuck
    fucking fucker bullshit crap retard retarded freak freaks creep creeps parasite parasites
    degenerate degenerates subhuman coward cowards
    idioten dumm dummkopf trottel depp arschloch abschaum versager wichser schlampe hure
    drecksau scheiße widerlich erbärmlich wertlos missgeburt
    idiote idiots imbécile crétin connard connasse salaud salope ordure racaille minable
    pathétique dégoûtant pourriture merde putain abruti
    idiota idiotas imbécil estúpido estúpida cabrón gilipollas basura escoria patético
    asqueroso mierda puta perdedor inútil payaso
""".split())
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|~_-+=/\\…“”„‚‘’«»¿¡—–"


def insults_of(counts: Counter[str]) -> int:
    return sum(n for w, n in counts.items() if w.strip(_EDGES).lower() in INSULTS)


def abusive(insults: int, words: int) -> bool:
    """Two insults at least, and one in 400 words; in a few words a single one."""
    return insults >= (2 if words >= 50 else 1) and 400 * insults >= words


_SYMBOL, _LETTER, _UPPER, _DIGIT, _SPACE = range(5)


def _kind(char: str) -> int:
    if char.isalpha():
        return _UPPER if char.isupper() else _LETTER
    return _DIGIT if char.isdigit() else _SPACE if char.isspace() else _SYMBOL


#: Kinds of the characters below 2^16, which nearly all are.
_KINDS = np.array([_kind(chr(code)) for code in range(1 << 16)], np.uint8)


def kinds_of(text: str) -> list[int]:
    """How many characters there are of each kind."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) and codes.max() >= len(_KINDS):
        high = codes >= len(_KINDS)
        rest, codes = Counter(codes[high].tolist()), codes[~high]
    else:
        rest = {}
    found = np.bincount(_KINDS[codes], minlength=5).tolist()
    for code, n in rest.items():
        found[_kind(chr(code))] += n
    return found


def facts_of(text: str, words: list[str], counts: Counter[str]) -> Facts:
    kinds = kinds_of(text)
    odd = [(w, n) for w, n in counts.items() if not w[-1].isalnum()]
    return Facts(
        chars=len(text), words=len(words), symbols=kinds[_SYMBOL], digits=kinds[_DIGIT],
        letters=kinds[_LETTER] + kinds[_UPPER], upper=kinds[_UPPER],
        decorated=sum(n for w, n in odd if not w[-2:-1].isalnum() and len(w) > 1),
        frequent=max(counts.values(), default=0), repeated=_repeated(words),
        distinct=sum(len(set(words[i:i + WINDOW])) for i in range(0, len(words), WINDOW)),
        wordless=sum(n for w, n in odd if not any(map(str.isalnum, w))),
        insults=insults_of(counts))


#: Words among which variety is judged, so that it means the same in texts of every length.
WINDOW = 1000


def _repeated(words: list[str]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def _band(value: float, of: int, good: float, bad: float) -> str:
    """Vote on the share ``value / of``: at most ``good`` is good, at least ``bad`` is bad."""
    if not of:
        return SILENT
    share = value / of
    return GOOD if share <= good else BAD if share >= bad else SILENT


def _long(facts: Facts, vote: str) -> str:
    """Shares of a few words say nothing."""
    return vote if facts.words >= 10 else SILENT


LABELLERS = {
    "symbols": lambda f: _long(f, _band(f.symbols, f.chars, 0.06, 0.12)),
    "digits": lambda f: _long(f, _band(f.digits, f.chars, 0.1, 0.3)),
    "capitals": lambda f: _long(f, _band(f.upper, f.letters, 0.15, 0.5)),
    "decorated": lambda f: _long(f, _band(f.decorated, f.words, 0.05, 0.3)),
    "wordless": lambda f: _long(f, _band(f.wordless, f.words, 0.05, 0.25)),
    "frequent": lambda f: _long(f, _band(f.frequent, f.words, 0.2, 0.4)),
    "repeated": lambda f: _long(f, _band(f.repeated, f.words, 0.05, 0.25)),
    "variety": lambda f: _long(f, _band(f.words - f.distinct, f.words, 0.7, 0.9)),
    "word_length": lambda f: _long(f, GOOD if 2.5 * f.words <= f.letters <= 15 * f.words else BAD),
    "toxic": lambda f: BAD if abusive(f.insults, f.words) else SILENT,
}

#: Toxic texts may be faultless prose, so the other votes say nothing of them: this vote settles
#: the matter, and such texts teach neither the other labellers' accuracies nor the scorer.
_TOXIC, _TOXIC_SCORE = list(LABELLERS).index("toxic"), 0.005


def votes(facts: Facts) -> str:
    return "".join([labeller(facts) for labeller in LABELLERS.values()])


def votes_of(text: str) -> str:
    words = text.split()
    return votes(facts_of(text, words, Counter(words)))


# --- expectation-maximisation -----------------------------------------------------------

@dataclass
class VoteModel:
    """Share of good texts and, per labeller, the chance of each vote for bad and for good."""

    prior: float
    chances: np.ndarray  # labellers x (bad, good) x (+, -)

    def posterior(self, pattern: str) -> float:
        """Probability that a text with these votes is good."""
        if pattern[_TOXIC] == BAD:
            return _TOXIC_SCORE
        kinds = [(GOOD, BAD, SILENT).index(v) for v in pattern]
        told = [(i, kind) for i, kind in enumerate(kinds) if kind < 2]  # silence says nothing
        logs = sum((np.log(self.chances[i, :, kind]) for i, kind in told), np.zeros(2))
        odds = np.log(self.prior) - np.log1p(-self.prior) + logs[1] - logs[0]
        return float(1 / (1 + np.exp(-np.clip(odds, -50, 50))))


#: What is believed of a labeller before any vote is seen, as chances of the votes (+, -):
#: few false alarms, and about half of the bad texts noticed, since each looks for one fault.
_BELIEF = np.array([[0.5, 0.5], [0.995, 0.005]])


def estimate(patterns: dict[str, int], rounds: int = 100, belief: float = 0.2) -> VoteModel:
    """Expectation-maximisation on pattern counts; what is believed beforehand weighs as much
    as ``belief`` times the documents of a class, so it means the same at every size."""
    size = len(LABELLERS)
    names = sorted(p for p in patterns if p[_TOXIC] != BAD)
    kinds = np.array([[(GOOD, BAD, SILENT).index(v) for v in p] for p in names],
                     int).reshape(-1, size)
    counts = np.array([patterns[p] for p in names], float)
    said = np.eye(3)[kinds][:, :, :2]  # patterns x labellers x votes
    alarms = (kinds == 1).sum(axis=1)
    good = np.where(alarms == 0, 0.97, np.where(alarms == 1, 0.5, 0.03))
    model = VoteModel(0.5, np.tile(_BELIEF, (size, 1, 1)))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - good), counts * good])  # class x patterns
        held = belief * (weights.sum(axis=1) + 1)
        sums = np.einsum("cp,plv->lcv", weights, said) + held[None, :, None] * _BELIEF
        model = VoteModel(
            float((weights[1].sum() + 1) / (counts.sum() + 2)),
            sums / sums.sum(axis=2, keepdims=True))
        was, good = good, np.array([model.posterior(p) for p in names])
        if not len(names) or np.abs(good - was).max() < 1e-6:
            break
    return model


def vote_model(df: DataFrame, text: str = "text") -> VoteModel:
    """The labellers' accuracies from the votes on all rows."""

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found = Counter(map(votes_of, texts_of(block)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["votes", "n"])

    counted = (
        narrowed(df, text=text).mapInArrow(cast, "votes string, n long")
        .groupBy("votes").agg(F.sum("n").alias("n"))
    )
    return estimate({r["votes"]: r["n"] for r in counted.collect()})  # <= 3^labellers rows


# --- scorer -----------------------------------------------------------------------------

_LOWER, _CAPITAL, _NUMBER = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")
_PUNCT = re.compile(r"[^\w\s]+")


def shape(word: str) -> str:
    """``Thre***`` -> ``Xxp2``: runs of capitals, small letters, digits; the number of other
    signs at the end, up to two."""
    tail = _PUNCT.search(word)
    plain = _NUMBER.sub("9", _LOWER.sub("x", _CAPITAL.sub("X", word)))
    return _PUNCT.sub("p", plain)[:6] + (str(min(2, len(tail[0]))) if tail else "")


class _Outlines(dict):
    """For ``str.translate``: one character for all that have the same part in a shape."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        self[code] = found = (
            "X" if _CAPITAL.match(char) else "x" if _LOWER.match(char)
            else "9" if _NUMBER.match(char) else "." if _PUNCT.match(char) else char)
        return found


_OUTLINES = _Outlines()


def _bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def _buckets(word: str, buckets: int, shapes: dict[str, int]) -> tuple[int, int]:
    """``shapes`` remembers the buckets of outlines: words are many, outlines few."""
    outline = word.translate(_OUTLINES)
    if outline not in shapes:
        if len(shapes) > 50_000:
            shapes.clear()
        shapes[outline] = _bucket("s:" + shape(outline), buckets)
    return _bucket("w:" + word.lower(), buckets), shapes[outline]


def _faults(repeated: int, frequent: int, words: int) -> tuple[int, int]:
    """Repetitions, and places of the most frequent word of a text of some length."""
    return 2 * repeated, frequent if words >= 20 else 0


def _damped(words: int) -> int:
    """What shares are taken of: a few words prove little."""
    return words + 20


@dataclass
class Scorer:
    """Weights of the hashed features; the last two are those of ``_faults``."""

    weights: np.ndarray
    bias: float
    votes: VoteModel
    shapes: dict[str, int] = member(default_factory=dict)

    def plain(self) -> tuple:
        return self.weights, self.bias, self.votes.prior, self.votes.chances

    @classmethod
    def of(cls, weights: np.ndarray, bias: float, prior: float, chances: np.ndarray) -> Scorer:
        return cls(weights, bias, VoteModel(prior, chances))

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        size = len(self.weights) - 2
        faults = _faults(_repeated(words), max(counts.values(), default=0), len(words))
        sums: Counter[int] = Counter(dict(zip((size, size + 1), faults, strict=True)))
        for word, n in counts.items():
            for at in _buckets(word, size, self.shapes):
                sums[at] += n
        return np.array(list(sums)), np.array(list(sums.values())) / _damped(len(words))

    def score(
        self, words: list[str], counts: Counter[str], known: dict[str, float],
        facts: Facts | None = None,
    ) -> float:
        """``known`` remembers the weights of words; ``facts`` spares what they tell already."""
        if not words:
            return 0.0
        size = len(self.weights) - 2
        for word in [w for w in counts if w not in known]:
            a, b = _buckets(word, size, self.shapes)
            known[word] = float(self.weights[a] + self.weights[b])
        total = sum(map(operator.mul, counts.values(), map(known.__getitem__, counts)))
        repeated, frequent = _faults(
            facts.repeated if facts else _repeated(words),
            facts.frequent if facts else max(counts.values()), len(words))
        total += self.weights[size] * repeated + self.weights[size + 1] * frequent
        x = self.bias + float(total) / _damped(len(words))
        found = float(1 / (1 + math.exp(-min(50.0, max(-50.0, x)))))
        insults = facts.insults if facts else insults_of(counts)
        return min(found, _TOXIC_SCORE) if abusive(insults, len(words)) else found


def fit_scorer(
    texts: list[str], model: VoteModel, buckets: int = 1 << 18, epochs: int = 6,
    rate: float = 0.5, seed: int = 5,
) -> Scorer:
    """Logistic regression on posterior labels by AdaGrad; the two sides weigh alike."""
    scorer = Scorer(np.zeros(buckets + 2), 0.0, model)
    told = [(t, votes_of(t)) for t in texts if t.split()]
    rows = [(*scorer.features(t), model.posterior(v)) for t, v in told if v[_TOXIC] != BAD]
    held, held_bias = np.full(buckets + 2, 1e-2), 1e-2
    good = sum(p for *_, p in rows)
    side = (len(rows) / (2 * max(len(rows) - good, 1)), len(rows) / (2 * max(good, 1)))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, values, p = rows[i]
            x = np.clip(scorer.bias + scorer.weights[at] @ values, -50, 50)
            slope = (p - 1 / (1 + np.exp(-x))) * (side[1] * p + side[0] * (1 - p))
            change = slope * values
            held[at] += change * change
            scorer.weights[at] += rate * change / np.sqrt(held[at])
            held_bias += slope * slope
            scorer.bias += 0.1 * rate * slope / np.sqrt(held_bias)
    return Scorer(scorer.weights.astype(np.float32), float(scorer.bias), model)


def train(
    df: DataFrame, sample_rows: int = 3000, key: str = "doc_id", text: str = "text"
) -> Scorer:
    """Votes of all rows, then a scorer fitted on at most ``sample_rows`` rows: those of the
    smallest hashes of their keys, whose texts alone are brought to the driver."""
    model = vote_model(df, text)
    chance = F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit(29))
    last = df.select(chance.alias("chance")).orderBy("chance").limit(sample_rows).agg(
        F.max("chance")).first()[0]
    if last is None:
        return fit_scorer([], model)
    rows = df.select(chance.alias("chance"), F.col(f"`{text}`").alias("text")).filter(
        F.col("chance") <= last).orderBy("chance", F.xxhash64("text")).limit(sample_rows)
    return fit_scorer(sorted(r["text"] or "" for r in rows.collect()), model)


def kept(df: DataFrame, scorer: Scorer, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores at least ``least``; all columns stay."""
    shared = df.sparkSession.sparkContext.broadcast(scorer.plain())

    def judge() -> Callable[[list[str]], list[bool]]:
        model = Scorer.of(*shared.value)
        known: dict[str, float] = {}

        def decide(texts: list[str]) -> list[bool]:
            good = []
            for value in texts:
                words = value.split()
                if len(known) > 100_000:
                    known.clear()
                good.append(bool(model.score(words, Counter(words), known) >= least))
            return good

        return decide

    return rows_kept(df, judge, text)


def classify(
    df: DataFrame, scorer: Scorer, least: float = 0.5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_words, votes, posterior, score, keep)`` of every row.

    ``votes``: one character per labeller; ``posterior``: their estimate that the text is
    good; ``score``: the scorer's; ``keep``: ``score >= least``.  Null texts and texts without
    a word score (nearly) 0.  Repeated rows and null keys stay rows of their own; an empty
    table gives an empty table.
    """
    rows = narrowed(df, key=key, text=text)
    shared = df.sparkSession.sparkContext.broadcast(scorer.plain())  # bounded by its buckets

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer.of(*shared.value)
        words_known: dict[str, float] = {}
        known: dict[str, float] = {}
        for block in text_blocks(batches):
            sizes, said, scores = [], [], []
            for text in texts_of(block):
                words = text.split()
                counts = Counter(words)
                if len(words_known) > 300_000:
                    words_known.clear()
                facts = facts_of(text, words, counts)
                sizes.append(len(words))
                said.append(votes(facts))
                scores.append(model.score(words, counts, words_known, facts))
            for pattern in set(said).difference(known):
                known[pattern] = model.votes.posterior(pattern)
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(sizes, pa.int64()),
                 pa.array(said, pa.string()), pa.array([known[p] for p in said], pa.float64()),
                 pa.array(scores, pa.float64()), pa.array([s >= least for s in scores])],
                names=[key, "n_words", "votes", "posterior", "score", "keep"])

    schema = ", ".join([field(key, rows.schema["key"].dataType),
                        "n_words long, votes string, posterior double, score double, keep boolean"])
    return rows.mapInArrow(score, schema)
