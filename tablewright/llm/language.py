"""Language identification by a linear-chain conditional random field over words.

Every word has one label, a language.  Features of a word are hashed into one table of
weights per language: all its letter 2- and 3-grams with word ends marked, its affixes of up
to three letters (the n-grams that hold a word end, and those of four characters) and the word
itself (the lexicon).  Transitions between the labels of neighbouring words are learned with
them.  Training sequences chain pieces of different documents, so that a language may change
within a text; texts are labelled by forward-backward, and a document's language is the one
with the largest mean marginal probability of its words.

The model is fitted on a bounded sample of labelled rows (``per_language``); prediction covers
whole texts.  Blocks of a text are joined by products of their transfer matrices, which is
exact, so a very long text costs no more per word than a short one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import field, narrowed, rows_kept, text_blocks, texts_of

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_CODE = re.compile(r"[\d_@/]")  # in numbers, keys and addresses
UNDETERMINED = "und"
_STEP = 64  # words whose transfer matrix is multiplied up at a time
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    transitions: np.ndarray  # from x to
    start: np.ndarray
    letters: tuple | None = None  # the fields of Letters


def _plain(model: Model | None) -> tuple | None:
    return model and (
        model.labels, model.weights, model.transitions, model.start, model.letters)


def features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one after the other, and where each word's begin."""
    marked = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    last = np.repeat(ends, lengths)
    at = np.arange(len(c))
    found, owner = [], []
    padded = np.concatenate([c, np.zeros(3, np.uint64)])
    for n in (2, 3, 4):
        value = np.full(len(c), n, np.uint64)
        for j in range(n):
            value = (value ^ padded[j:j + len(c)]) * _PRIMES[j] + np.uint64(n)
            value ^= value >> np.uint64(29)
        inside = at + n <= last
        if n == 4:
            inside &= (c == 2) | (at + n == last)
        found.append(value[inside])
        owner.append(word[inside])
    begins = ends - lengths
    mixed = (c + np.uint64(7)) * (((at - begins[word]).astype(np.uint64) + np.uint64(1))
                                  * _PRIMES[1] | np.uint64(1))
    mixed ^= mixed >> np.uint64(31)
    whole = np.add.reduceat(mixed * _PRIMES[2], begins) if len(words) else mixed
    found.append(whole ^ (whole >> np.uint64(30)))
    owner.append(np.arange(len(words)))
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    values = np.concatenate(found)[order]
    values = ((values * _PRIMES[0]) >> np.uint64(17)) % np.uint64(buckets)
    counts = np.bincount(owners, minlength=len(words))
    return values.astype(np.int64), np.cumsum(counts) - counts


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    """words x labels, the mean weight of a word's features scaled by their root."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    ids, begins = features(words, len(weights))
    counts = np.diff(np.append(begins, len(ids)))
    return np.add.reduceat(weights[ids], begins, axis=0) / np.sqrt(counts)[:, None]


# --- forward-backward -------------------------------------------------------------------

def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Marginal probabilities of the words of several texts (none empty), which follow each
    other in ``scores`` (words x labels)."""
    n_labels = scores.shape[1]
    move = np.exp(model.transitions - model.transitions.max())
    potential = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    steps = -(-lengths // _STEP)
    first = np.cumsum(steps) - steps
    begins = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(scores)) - begins[text]
    row, col = first[text] + inside // _STEP, inside % _STEP
    blocks = int(steps.sum())
    padded = np.ones((blocks, _STEP, n_labels))
    padded[row, col] = potential
    real = np.zeros((blocks, _STEP), bool)
    real[row, col] = True

    transfer = np.broadcast_to(np.eye(n_labels), (blocks, n_labels, n_labels)).copy()
    for t in range(_STEP):
        moved = (transfer.reshape(-1, n_labels) @ move).reshape(transfer.shape)
        moved *= padded[:, t, None, :]
        moved /= moved.sum(axis=(1, 2), keepdims=True)
        transfer = np.where(real[:, t, None, None], moved, transfer)

    # The state before the first word is such that one move gives the start weights.
    before = np.empty((blocks, n_labels))
    after = np.ones((blocks, n_labels))
    start = np.exp(model.start - model.start.max())
    entering = np.repeat(_normal(start)[None], len(lengths), axis=0)
    for i in range(int(steps.max(initial=0))):
        live = np.flatnonzero(steps > i)
        before[first[live] + i] = entering[live]
        entering[live] = _normal(
            np.einsum("bi,bij->bj", entering[live], transfer[first[live] + i]) + 1e-300)
    leaving = np.ones((len(lengths), n_labels))
    for i in range(int(steps.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(steps > i)
        after[first[live] + i] = leaving[live]
        leaving[live] = _normal(
            np.einsum("bij,bj->bi", transfer[first[live] + i], leaving[live]) + 1e-300)

    forward = np.empty((blocks, _STEP, n_labels))
    state = before
    for t in range(_STEP):
        moved = _normal((state @ move) * padded[:, t] + 1e-300)
        state = np.where(real[:, t, None], moved, state)
        forward[:, t] = state
    state = after
    for t in range(_STEP - 1, -1, -1):
        forward[:, t] *= state
        moved = _normal((state * padded[:, t]) @ move.T + 1e-300)
        state = np.where(real[:, t, None], moved, state)
    return _normal(forward[row, col] + 1e-300)


# --- training ---------------------------------------------------------------------------

def fit(
    texts: list[str], labels: list[str], buckets: int = 1 << 16, epochs: int = 4,
    batch: int = 256, length: int = 48, rate: float = 0.3, seed: int = 7,
) -> Model | None:
    """A model of the labelled texts; None if no text has a letter."""
    words: dict[str, int] = {}
    pieces, gold = [], []
    names = sorted(set(labels))
    for text, label in zip(texts, labels, strict=True):
        found = [words.setdefault(w, len(words)) for w in WORD.findall(text.lower())]
        for begin in range(0, len(found), length // 3):
            pieces.append(found[begin:begin + length // 3])
            gold.append(names.index(label))
    if not pieces:
        return None
    rng = np.random.default_rng(seed)
    n_labels = len(names)
    ids, begins = features(list(words), buckets)
    counts = np.diff(np.append(begins, len(ids)))
    model = Model(names, np.zeros((buckets, n_labels)), np.zeros((n_labels, n_labels)),
                  np.zeros(n_labels))
    speed = [np.full_like(x, 1e-2) for x in (model.weights, model.transitions, model.start)]
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        chains = [order[i:i + 3] for i in range(0, len(order), 3)]
        for i in range(0, len(chains), batch):
            part = chains[i:i + batch]
            x = np.zeros((len(part), length), np.int64)
            y = np.zeros((len(part), length), np.int64)
            real = np.zeros((len(part), length), bool)
            for r, chain in enumerate(part):
                row = [w for p in chain for w in pieces[p]]
                x[r, :len(row)], real[r, :len(row)] = row, True
                y[r, :len(row)] = np.repeat([gold[p] for p in chain],
                                            [len(pieces[p]) for p in chain])
            _learn(model, speed, rate, x, y, real, ids, begins, counts)
    return model


def _learn(model, speed, rate, x, y, real, ids, begins, counts) -> None:
    """One step of AdaGrad on the mean log likelihood of a batch of sequences."""
    used, where = np.unique(x, return_inverse=True)
    where = where.reshape(x.shape)
    total = counts[used]
    at = np.repeat(begins[used] - np.cumsum(total) + total, total) + np.arange(total.sum())
    taken = ids[at]
    word = np.repeat(np.arange(len(used)), total)
    root = np.sqrt(total)[:, None]
    scores = np.add.reduceat(model.weights[taken], np.cumsum(total) - total, axis=0) / root
    n, length = x.shape
    labels = scores.shape[1]
    emit = scores[where]
    emit = np.exp(emit - emit.max(axis=2, keepdims=True))
    move = np.exp(model.transitions)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    alpha[:, 0] = _normal(np.exp(model.start) * emit[:, 0])
    for t in range(1, length):
        alpha[:, t] = np.where(real[:, t, None], _normal((alpha[:, t - 1] @ move) * emit[:, t]),
                               alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        beta[:, t] = np.where(real[:, t + 1, None],
                              _normal((emit[:, t + 1] * beta[:, t + 1]) @ move.T),
                              beta[:, t + 1])
    node = _normal(alpha * beta)
    gold = np.eye(labels)[y]
    wrong = (gold - node) * real[..., None]
    pair = np.zeros((labels, labels))
    for t in range(1, length):
        joint = alpha[:, t - 1, :, None] * move * (emit[:, t] * beta[:, t])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        told = gold[:, t - 1, :, None] * gold[:, t, None, :]
        pair += ((told - joint) * real[:, t, None, None]).sum(axis=0)
    by_word = np.zeros((len(used), labels))
    for label in range(labels):
        by_word[:, label] = np.bincount(
            where.ravel(), wrong[..., label].ravel(), minlength=len(used))
    by_word /= root
    buckets, place = np.unique(taken, return_inverse=True)
    slope = np.stack([np.bincount(place, by_word[word, label], minlength=len(buckets))
                      for label in range(labels)], axis=1)
    for value, held, change, rows in (
        (model.weights, speed[0], slope / n, buckets),
        (model.transitions, speed[1], pair / n - 1e-3 * model.transitions, slice(None)),
        (model.start, speed[2], wrong[:, 0].sum(axis=0) / n, slice(None)),
    ):
        held[rows] += change * change
        value[rows] += rate * change / np.sqrt(held[rows])


def training_sample(
    df: DataFrame, usable: Column, per_language: int, key: str, text: str, lang: str
) -> list[tuple[str, str]]:
    """At most ``per_language`` usable rows of every language, those of the smallest hashes
    of their keys.  The hashes are compared first, on narrow rows; texts are read for the
    chosen rows only."""
    chance = F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit(11))
    narrow = df.filter(usable).select(F.col(f"`{lang}`").alias("lang"), chance.alias("chance"))
    by_lang = Window.partitionBy("lang").orderBy("chance")
    limits = (
        narrow.withColumn("place", F.row_number().over(by_lang))
        .filter(F.col("place") <= per_language)
        .groupBy("lang").agg(F.max("chance").alias("limit")).collect()  # a row a language
    )
    if not limits:
        return []
    limit = F.create_map(*[F.lit(x) for r in limits for x in (r["lang"], r["limit"])])
    rows = (
        df.filter(usable)
        .select(F.col(f"`{lang}`").alias("lang"), chance.alias("chance"),
                F.col(f"`{text}`").alias("text"))
        .filter(F.col("chance") <= F.try_element_at(limit, F.col("lang")))
        .withColumn("place", F.row_number().over(by_lang.orderBy("chance", F.xxhash64("text"))))
        .filter(F.col("place") <= per_language).select("text", "lang")
    )
    return sorted((r["text"], r["lang"]) for r in rows.collect())


def held_out(key: str) -> Column:
    """Rows kept from training: the remainder of the key's checksum by 3 is 1."""
    return F.coalesce(
        F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(3)) == 1,
        F.lit(False))


def train(
    df: DataFrame, per_language: int = 400, key: str = "doc_id", text: str = "text",
    lang: str = "lang", usable: Column | None = None,
) -> Model | None:
    """A model from the rows that are not held out and have a text and a language.

    ``per_language`` bounds the sample.  None if there is no such row with a letter."""
    if usable is None:
        usable = ~held_out(key)
    usable = usable & F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull()
    sample = training_sample(df, usable, per_language, key, text, lang)
    texts, labels = [t for t, _ in sample], [l for _, l in sample]
    model = fit(texts, labels) if sample else None
    letters = fit_letters(texts, labels) if model else None
    if letters:
        model.letters = letters.plain()
    return model


# --- words of no learned language -------------------------------------------------------

@dataclass
class Letters:
    """How likely the letters of words are in each language, by their two letters before.

    The labels' marginals sum to 1 and so cannot tell that a text is of none of them; the
    likelihood of its letters can.  ``cut`` and the rest are calibrated on sample rows that
    were not counted, see ``fit_letters``."""

    triples: np.ndarray  # buckets x labels, logarithms of counts
    pairs: np.ndarray
    cut: float  # the least mean of a text's words
    mean: float  # of the words of the learned languages
    deviation: float

    def plain(self) -> tuple:
        return self.triples, self.pairs, self.cut, self.mean, self.deviation

    def likely(self, words: list[str]) -> np.ndarray:
        """words x labels: mean logarithm of the probability of a word's letters."""
        if not words:
            return np.zeros((0, self.triples.shape[1]))
        triple, pair, begins = _letter_ids(words, len(self.triples))
        sums = np.add.reduceat(self.triples[triple] - self.pairs[pair], begins, axis=0)
        return sums / np.diff(np.append(begins, len(triple)))[:, None]

    def known(self, mean: float, words: int) -> bool:
        """Whether so many words of this mean may be of a learned language.  A few words
        must lie further off than chance explains."""
        return mean >= min(self.cut, self.mean - 8 * self.deviation / words ** 0.5)


#: What is added to the counts of triples and of pairs: a pair that was not met makes every
#: letter after it unlikely.
_ADDED = (0.05, 60.0)


def _separate(text: str) -> list[str]:
    """Words that are no part of a number, key or address, unless there are no others."""
    plain = " ".join(t for t in text.split() if not _CODE.search(t))
    return WORD.findall(plain) or WORD.findall(text)


def _letter_ids(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the letter triples of all words, word ends marked, and of their first two
    letters; where each word's begin."""
    marked = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))  # triples of a word
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) + 2 * np.repeat(np.arange(len(words)), lengths)
    pair = (c[at] * _PRIMES[0] ^ (c[at] >> np.uint64(7))) + c[at + 1] * _PRIMES[1]
    triple = (pair ^ (pair >> np.uint64(29))) * _PRIMES[2] + c[at + 2] * _PRIMES[3]
    ids = [(((x ^ (x >> np.uint64(31))) * _PRIMES[0]) >> np.uint64(17)) % np.uint64(buckets)
           for x in (triple, pair)]
    return ids[0].astype(np.int64), ids[1].astype(np.int64), ends - lengths


def fit_letters(
    texts: list[str], labels: list[str], buckets: int = 1 << 16, seed: int = 3,
) -> Letters | None:
    """Letter statistics of four of five texts, with limits calibrated on the fifth.

    The cut lies halfway between the texts of the learned languages (the language whose
    lowest hundredth is lowest) and two kinds of texts that are of none: those of each language
    when that language is left out, and those with their letters shuffled (the language and
    kind whose median is highest; a sample also holds mixed and repetitive texts).  Where the
    two sides overlap, the cut keeps the learned languages."""
    names = sorted(set(labels))
    found = [_separate(t.lower()) for t in texts]
    counts = [np.full((buckets, len(names)), x) for x in _ADDED]
    rng = np.random.default_rng(seed)
    aside = rng.random(len(texts)) < 0.2
    for words, label, held in zip(found, labels, aside, strict=True):
        if words and not held:
            for table, ids in zip(counts, _letter_ids(words, buckets)[:2], strict=True):
                table[:, names.index(label)] += np.bincount(ids, minlength=buckets)
    model = Letters(*(np.log(t).astype(np.float32) for t in counts), -np.inf, 0.0, np.inf)
    own: dict[int, list[float]] = {}
    others: dict[tuple[int, str], list[float]] = {}
    single = []
    for words, label, held in zip(found, labels, aside, strict=True):
        if not held or len(words) < 20:
            continue
        sizes = np.fromiter(map(len, words), float, len(words))
        at, likely = names.index(label), model.likely(words)
        best = likely.max(axis=1)
        single.append(best)
        own.setdefault(at, []).append(float(np.average(best, weights=sizes)))
        rest = np.delete(likely, at, axis=1)
        if rest.size:
            others.setdefault((at, "left out"), []).append(
                float(np.average(rest.max(axis=1), weights=sizes)))
        letters = "".join(rng.permutation(list("".join(words))))
        ends = np.cumsum(sizes).astype(int)
        mixed = [letters[e - len(w):e] for w, e in zip(words, ends, strict=True)]
        others.setdefault((at, "shuffled"), []).append(
            float(np.average(model.likely(mixed).max(axis=1), weights=sizes)))
    if not single:
        return None
    low = min(float(np.quantile(v, 0.01)) for v in own.values())
    model.cut = min(low, (low + max(float(np.median(v)) for v in others.values())) / 2)
    every = np.concatenate(single)
    model.mean, model.deviation = float(every.mean()), float(every.std())
    return model


# --- prediction -------------------------------------------------------------------------

class Labeller:
    """Word labels of texts; remembers the emissions of words, which changes no result."""

    def __init__(self, model: Model, remembered: int = 300_000):
        self.model, self.remembered = model, remembered
        self.letters = Letters(*model.letters) if model.letters else None
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.labels)))
        self.likely = self.sizes = np.zeros(0)

    def words(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """Number of words of every text and the rows of all words."""
        found = [WORD.findall(t.lower()) for t in texts]
        if len(self.rows) > self.remembered:
            self.rows, self.scores = {}, self.scores[:0]
            self.likely = self.sizes = np.zeros(0)
        new = list(dict.fromkeys(w for ws in found for w in ws if w not in self.rows))
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, emissions(new, self.model.weights)])
        lengths = [len(ws) for ws in found]
        return lengths, np.fromiter(
            (self.rows[w] for ws in found for w in ws), np.int64, sum(lengths))

    def marginals(self, lengths: list[int], codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros((0, len(self.model.labels)))
        some = np.array([n for n in lengths if n], np.int64)
        return marginals(self.scores[codes], some, self.model)

    def label(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """Number of words of every text and the marginals of all words."""
        lengths, codes = self.words(texts)
        return lengths, self.marginals(lengths, codes)

    def known(self, texts: list[str], lengths: list[int], codes: np.ndarray) -> list[bool]:
        """Whether the letters of each text's words are those of learned languages, each word
        in the language that suits it best; ``lengths`` and ``codes`` are those of ``words``."""
        if self.letters is None:
            return [n > 0 for n in lengths]
        new = list(islice(self.rows, len(self.likely), None))
        if new:
            self.likely = np.concatenate([self.likely, self.letters.likely(new).max(axis=1)])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), float, len(new))])
        at, out = 0, []
        for value, n in zip(texts, lengths, strict=True):
            own, sizes = self.likely[codes[at:at + n]], self.sizes[codes[at:at + n]]
            at += n
            if n and _CODE.search(value):
                words = _separate(value.lower())
                own = self.letters.likely(words).max(axis=1)
                sizes = np.fromiter(map(len, words), float, len(words))
            out.append(n > 0 and self.letters.known(
                float(own @ sizes / sizes.sum()), len(own)))
        return out


def identify(
    df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(key, lang_pred, score, n_words, spans)`` of every row.

    ``spans`` lists the runs of words of one language: ``(lang, first, words)``, so
    code-switched texts show where they change.  ``score`` is the mean marginal of
    ``lang_pred``.  A null text or one without a letter - or any text without a model - is
    ``und`` with score 0 and no spans.  Repeated rows and null keys stay rows of their own;
    an empty table gives an empty table.
    """
    rows = narrowed(df, key=key, text=text)
    shared = df.sparkSession.sparkContext.broadcast(_plain(model))  # buckets x labels at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Model(*shared.value)) if shared.value else None
        for block in text_blocks(batches, 4 << 20):
            texts = texts_of(block)
            lengths, probable = labeller.label(texts) if labeller else ([0] * len(texts), None)
            at, langs, scores, spans = 0, [], [], []
            for n in lengths:
                if not n:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    spans.append([])
                    continue
                own = probable[at:at + n]
                at += n
                mean = own.mean(axis=0)
                best = int(mean.argmax())
                langs.append(labeller.model.labels[best])
                scores.append(float(min(1.0, mean[best])))
                label = own.argmax(axis=1)
                begins = np.concatenate([[0], np.flatnonzero(np.diff(label)) + 1])
                sizes = np.diff(np.append(begins, n))
                spans.append([
                    {"lang": labeller.model.labels[label[b]], "first": int(b), "words": int(s)}
                    for b, s in zip(begins, sizes, strict=True)])
            kind = pa.list_(pa.struct(
                [("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(lengths, pa.int64()),
                 pa.array(spans, kind)],
                names=[key, "lang_pred", "score", "n_words", "spans"])

    schema = ", ".join([
        field(key, rows.schema["key"].dataType),
        "lang_pred string, score double, n_words long",
        "spans array<struct<lang: string, first: int, words: int>>"])
    return rows.mapInArrow(predict, schema)


def kept(df: DataFrame, model: Model | None, least: float, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a language with a mean marginal of at least
    ``least`` and letters likely in the learned languages; all columns stay.  Without a model
    only rows without a letter go."""
    shared = df.sparkSession.sparkContext.broadcast(_plain(model))

    def judge() -> Callable[[list[str]], list[bool]]:
        if not shared.value:
            return lambda texts: [bool(WORD.search(t)) for t in texts]
        labeller = Labeller(Model(*shared.value), remembered=100_000)

        def decide(texts: list[str]) -> list[bool]:
            lengths, codes = labeller.words(texts)
            probable, at, good = labeller.marginals(lengths, codes), 0, []
            for n, known in zip(lengths, labeller.known(texts, lengths, codes), strict=True):
                good.append(bool(known and probable[at:at + n].mean(axis=0).max() >= least))
                at += n
            return good

        return decide

    return rows_kept(df, judge, text)
