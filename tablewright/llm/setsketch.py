"""Near-duplicate classes by SetSketch registers.

A text is the set of its distinct shingles.  Texts with equal sets form a class; from there on
only classes are compared.

1. SetSketch: exponentially spaced, truncated minima - mergeable by maxima, and equal in two
   sketches with a probability just above the Jaccard similarity.
2. Classes that agree in a whole band of registers share a bucket.  Every bucket compares its
   members with its leader (the smallest class in it): first by the joint likelihood of both
   sketches, then on the full sets.  That settles most members, because members of one
   component need not be compared with each other.
3. The rest - pairs of different components - follows without listing a group's pairs.  The
   hub of a class is the smallest leader that resembles it.  Classes of one hub are compared
   in blocks of bounded size, and only links leave a task.  So are the classes of a crowd of
   hubs, all those that share buckets, also by way of others; in a very large crowd only the
   pairs that share a bucket are compared.
4. Components by the smallest label, with pointer jumping.

All links between buckets' members are found exactly; a pair at the threshold shares no bucket
with a probability of (1 - similarity ** rows) ** bands, 1e-7 as given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import field, narrowed, text_blocks, texts_of
from tablewright.shared import written

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Similar:
    """Shingles of ``words`` words, linked at ``percent`` of Jaccard similarity."""

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    #: Classes of one hub that a task compares with as many others.
    block: int = 256
    #: Pairs whose estimate is this many standard deviations below the threshold are dropped.
    deviations: float = 6.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        j = self.percent / 100
        return j - self.deviations * (j * (1 - j) / self.registers) ** 0.5

    def linked(self, common: Column, a: Column, b: Column) -> Column:
        return 100 * common >= self.percent * (a + b - common)


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes; remembers hashes of words."""

    def __init__(self, words: int, remembered: int = 400_000):
        self.words, self.remembered = words, remembered
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # ASCII letters and white space only
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        count = len(words) - size + 1
        value = np.full(count, size, np.uint64)
        for i in range(size):
            value = (value ^ codes[i:i + count]) * _MIX
            value ^= value >> np.uint64(32)
        value = value * _MIX2
        value ^= value >> np.uint64(29)
        return np.unique(value)


class Sketch:
    """Registers K = max(0, min(q + 1, floor(1 - log_b x))) of the smallest x, for every
    register an exponential variable of rate a of every element."""

    def __init__(self, registers: int, base: float = 1.001, rate: float = 20.0):
        self.base, self.rate, self.top = base, rate, (1 << 16) - 1
        rng = np.random.default_rng(20210101)
        self.factors = rng.integers(0, 1 << 63, registers, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, elements: np.ndarray) -> np.ndarray:
        if not len(elements):
            return np.zeros(len(self.factors), np.uint16)
        largest = np.empty(len(self.factors), np.uint64)
        step = max(1, (1 << 18) // len(elements))
        for i in range(0, len(self.factors), step):  # the largest number has the smallest x
            largest[i:i + step] = (elements[None, :] * self.factors[i:i + step, None]).max(axis=1)
        rest = ((~largest).astype(np.float64) + 0.5) / 2.0**64
        x = -np.log1p(-rest) / self.rate
        k = np.floor(1 - np.log(x) / np.log(self.base))
        return np.clip(k, 0, self.top).astype(np.uint16)

    def likely(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
               steps: int = 200) -> np.ndarray:
        """Jaccard similarity of the largest joint likelihood for rows of registers of sets of
        known sizes, on a grid."""
        more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
        same = a.shape[1] - more - less
        u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
        most = np.minimum(u / v, v / u)
        j = most[:, None] * np.linspace(0, 1, steps + 1)[None, :]

        def larger(x: np.ndarray) -> np.ndarray:
            spread = (self.base - 1) / self.base
            return -np.log1p(-np.clip(x, 0, 1) * spread) / np.log(self.base)

        up = larger(u[:, None] - v[:, None] * j)  # chance that a register of a is larger
        down = larger(v[:, None] - u[:, None] * j)
        tiny = 1e-12
        logs = (more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny)
                + same[:, None] * np.log(np.maximum(1 - up - down, 0) + tiny))
        return np.take_along_axis(j, logs.argmax(axis=1)[:, None], axis=1)[:, 0]


# --- sketches ---------------------------------------------------------------------------

def sketches(df: DataFrame, rule: Similar, key: str, text: str) -> DataFrame:
    """``(key, class, size, text_hash, registers)`` of every row, durable.  ``class`` is a
    128-bit digest of the set; null for a text without words."""
    rows = narrowed(df, key=key, text=text).withColumn("text_hash", F.xxhash64("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, registers = Shingler(rule.words), Sketch(rule.registers)
        for block in text_blocks(batches):
            sets = [shingles(t) for t in texts_of(block)]
            yield pa.RecordBatch.from_arrays([
                block.column("key"),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                         pa.binary()),
                pa.array(list(map(len, sets)), pa.int64()), block.column("text_hash"),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["key", "class", "size", "text_hash", "registers"])

    kind = field("key", rows.schema["key"].dataType)
    return written(rows.mapInArrow(
        sketch, f"{kind}, class binary, size long, text_hash long, registers binary"), "sketches")


def _banded(classes: DataFrame, rule: Similar) -> DataFrame:
    """``(band, class)``: one row per band of registers."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * rule.rows
        for batch in batches:
            names, bands = [], []
            for name, registers in zip(batch.column("class").to_pylist(),
                                       batch.column("registers").to_pylist(), strict=True):
                names += [name] * rule.bands
                bands += [
                    xxhash.xxh3_64_intdigest(registers[i * width:(i + 1) * width], seed=i)
                    for i in range(rule.bands)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(bands, np.uint64).view(np.int64)),
                 pa.array(names, pa.binary())], names=["band", "class"])

    return classes.select("class", "registers").mapInArrow(deal, "band long, class binary")


def _sets(df: DataFrame, wanted: DataFrame, rule: Similar, key: str, text: str) -> DataFrame:
    """``(class, size, registers, elements)`` of the wanted classes, durable.  The set comes
    from one text of the class, ``(rep_key, rep_hash)``."""
    rows = narrowed(df, key=key, text=text).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(
        wanted.select("rep_key", "rep_hash"),
        (F.col("text_hash") == F.col("rep_hash")) & F.col("key").eqNullSafe(F.col("rep_key")),
        "left_semi").select("text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, registers = Shingler(rule.words), Sketch(rule.registers)
        for block in text_blocks(batches):
            sets = [s for s in map(shingles, texts_of(block)) if len(s)]
            yield pa.RecordBatch.from_arrays([
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names=["class", "size", "registers", "elements"])

    found = rows.mapInArrow(
        build, "class binary, size long, registers binary, elements binary")
    return written(found.dropDuplicates(["class"]), "sets")


def _compared(pairs: DataFrame, sets: DataFrame, rule: Similar, label: str) -> DataFrame:
    """``(a, b, size_a, size_b, common)`` of the pairs whose likely similarity comes near the
    threshold, durable."""
    a = sets.select(F.col("class").alias("a"), F.col("size").alias("size_a"),
                    F.col("registers").alias("reg_a"), F.col("elements").alias("set_a"))
    b = sets.select(F.col("class").alias("b"), F.col("size").alias("size_b"),
                    F.col("registers").alias("reg_b"), F.col("elements").alias("set_b"))
    # sizes alone rule out a similarity that deserves a comparison
    near = F.least("size_a", "size_b") >= rule.least_estimate * F.greatest("size_a", "size_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Sketch(rule.registers)
        for batch in batches:
            n = batch.num_rows
            sizes = [np.asarray(batch.column(c)).astype(float) for c in ("size_a", "size_b")]
            registers = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(n, -1)
                for c in ("reg_a", "reg_b")]
            likely = np.concatenate([np.zeros(0), *(
                model.likely(registers[0][i:i + 512], registers[1][i:i + 512],
                             sizes[0][i:i + 512], sizes[1][i:i + 512])
                for i in range(0, n, 512))])
            kept = np.flatnonzero(likely >= rule.least_estimate)
            common = []
            for i in kept.tolist():
                x = np.frombuffer(batch.column("set_a")[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("set_b")[i].as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                inside = x[np.minimum(at, len(x) - 1)] == y
                common.append(int(inside.sum()))
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in ("a", "b", "size_a", "size_b")),
                 pa.array(common, pa.int64())],
                names=["a", "b", "size_a", "size_b", "common"])

    joined = pairs.join(a, "a").join(b, "b").filter(near)
    return written(joined.select(
        "a", "b", "size_a", "size_b", "reg_a", "reg_b", "set_a", "set_b").mapInArrow(
            compare, "a binary, b binary, size_a long, size_b long, common long"), label)


# --- components -------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node reachable over the links ``(a, b)``, for nodes with
    links.  Labels move to neighbours and then to the label's own label, so a chain of n nodes
    takes about log n rounds; every round is a written table."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).union(
        links.select(F.col("b"), F.col("a"))).distinct()
    both = written(both, "links")
    labels = written(both.groupBy("node").agg(
        F.least("node", F.min("next")).alias("label")), "labels")
    while True:
        seen = both.join(
            labels.select(F.col("node").alias("next"), F.col("label").alias("near")), "next")
        near = seen.groupBy("node").agg(F.min("near").alias("near"))
        moved = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        after = written(moved.join(jump, "to").select(
            "node", "was", F.least("to", "further").alias("label")), "labels")
        changed = after.filter(F.col("was") != F.col("label")).limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels


# --- operator ---------------------------------------------------------------------------

def links_of(df: DataFrame, held: DataFrame, rule: Similar, key: str, text: str) -> DataFrame:
    """``(a, b)``: linked classes; enough links for every component."""
    classes = held.filter("class IS NOT NULL").groupBy("class").agg(
        F.first("registers").alias("registers"),
        F.min(F.struct("key", "text_hash")).alias("rep"))
    bands = _banded(classes, rule)
    buckets = bands.groupBy("band").agg(
        F.min("class").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = written(bands.join(buckets.select("band", "leader"), "band"), "members")
    wanted = members.select("class").distinct().join(classes.select("class", "rep"), "class")
    sets = _sets(df, wanted.select(F.col("rep.key").alias("rep_key"),
                                   F.col("rep.text_hash").alias("rep_hash")), rule, key, text)

    # every member with its bucket's leader
    stars = members.filter("class != leader").select(
        F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    stars = _compared(stars, sets, rule, "stars")
    settled = rule.linked(F.col("common"), F.col("size_a"), F.col("size_b"))
    first = components(stars.filter(settled).select("a", "b"))

    # the hub of a class: the smallest leader that resembles it; a leader may be its own
    hubs = stars.groupBy(F.col("b").alias("class")).agg(F.min("a").alias("h"))
    about = written(
        members.select("class").distinct()
        .join(first.withColumnRenamed("node", "class"), "class", "left")
        .join(hubs, "class", "left")
        .select("class", F.coalesce("label", "class").alias("component"),
                F.coalesce("h", "class").alias("hub")), "about")

    # one hub, different components: blocks of the hub's classes meet in tasks of their own
    inner = _links_in_groups(
        about.select(F.col("hub").alias("grp"), "class", "component", F.col("class").alias("hub")),
        sets, rule, "inner")

    # different hubs in one bucket
    spread = members.select("band", "class").join(about, "class")
    several = spread.groupBy("band").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"),
        F.min("hub").alias("h0"), F.max("hub").alias("h1")
    ).filter("c0 != c1 AND h0 != h1").select("band", "h0")
    mixed = written(spread.join(several, "band"), "mixed")
    # hubs that share buckets, also by way of others: their classes meet in blocks as well
    crowds = components(mixed.filter("hub != h0").select(
        F.col("hub").alias("a"), F.col("h0").alias("b")).distinct())
    crowds = written(
        mixed.select("class", "component", "hub").distinct()
        .join(crowds.withColumnRenamed("node", "hub"), "hub", "left")
        .select("class", "component", "hub", F.coalesce("label", "hub").alias("grp")), "crowds")
    sizes = crowds.groupBy("grp").agg(F.count("*").alias("n"))
    large = written(sizes.filter(F.col("n") > CROWD_BLOCKS * rule.block).select("grp"), "large")
    between = _links_in_groups(crowds.join(large, "grp", "left_anti"), sets, rule, "between")

    # buckets of very large crowds: pairs that share one
    mixed = mixed.join(crowds.join(large, "grp").select("class"), "class", "left_semi")

    def side(s: str) -> DataFrame:
        return mixed.select("band", *[
            F.col(c).alias(f"{c}_{s}") for c in ("class", "component", "hub")])

    apart = ((F.col("component_x") != F.col("component_y")) & (F.col("hub_x") != F.col("hub_y"))
             & (F.col("class_x") < F.col("class_y")))
    rest = side("x").join(side("y"), "band").filter(apart).select(
        F.col("class_x").alias("a"), F.col("class_y").alias("b")).distinct()
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _compared(rest.join(known, ["a", "b"], "left_anti"), sets, rule, "rest")
    return (stars.filter(settled).select("a", "b").union(inner).union(between)
            .union(rest.filter(settled).select("a", "b")))


#: Blocks of classes up to which all classes of a crowd of hubs are compared with each other;
#: in larger crowds only classes that share a bucket are.
CROWD_BLOCKS = 64


def _links_in_groups(
    groups: DataFrame, sets: DataFrame, rule: Similar, label: str
) -> DataFrame:
    """``(a, b)``: links between classes of ``groups(grp, class, component, hub)`` that are in
    one group, but in different components and of different hubs.

    The classes of a group are dealt to blocks of about ``rule.block`` classes, and every two
    blocks meet in one task: equal registers first, then the joint likelihood, then the sets.
    Only links leave the task, so no group is expanded into its pairs."""
    torn = groups.groupBy("grp").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"),
        F.ceil(F.count("*") / F.lit(rule.block)).cast("int").alias("blocks")
    ).filter("c0 != c1").select("grp", "blocks")
    held = ["class", "component", "hub", "size", "registers", "elements"]
    dealt = written(
        groups.join(torn, "grp").join(sets, "class").select(
            "grp", "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"),
            *held), "dealt")
    left = dealt.select("grp", F.col("block").alias("i"), F.explode(
        F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), *held)
    right = dealt.select("grp", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"),
                         F.col("block").alias("j"), *held)
    # new names on one side: both come from the same table
    right = right.select(*[F.col(c).alias(c) for c in right.columns])

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        model, a, b = Sketch(rule.registers), [], []
        if x.num_rows and y.num_rows:
            sides = []
            for t in (x, y):
                registers = b"".join(t.column("registers").to_pylist())
                sides.append((
                    t.column("class").to_pylist(), t.column("component").to_pylist(),
                    t.column("hub").to_pylist(),
                    np.asarray(t.column("size")).astype(float),
                    np.frombuffer(registers, np.uint16).reshape(t.num_rows, -1),
                    [np.frombuffer(e, np.uint64) for e in t.column("elements").to_pylist()]))
            ((names, parts, hubs, sizes, regs, elements),
             (names2, parts2, hubs2, sizes2, regs2, elements2)) = sides
            kinds = {c: i for i, c in enumerate({*parts, *parts2, *hubs, *hubs2})}
            own2, hub2 = (np.array([kinds[c] for c in side]) for side in (parts2, hubs2))
            for i, name in enumerate(names):
                ratio = np.minimum(sizes[i], sizes2) / np.maximum(sizes[i], sizes2)
                at = np.flatnonzero(
                    (own2 != kinds[parts[i]]) & (hub2 != kinds[hubs[i]]) & (100 * ratio >= rule.percent - 1e-9)
                    & ((regs2 == regs[i]).mean(axis=1) >= rule.least_estimate))
                if not len(at):
                    continue
                likely = model.likely(
                    np.broadcast_to(regs[i], (len(at), regs.shape[1])), regs2[at],
                    np.full(len(at), sizes[i]), sizes2[at], steps=100)
                for j in at[likely >= rule.least_estimate].tolist():
                    place = np.searchsorted(elements[i], elements2[j])
                    common = int((elements[i][np.minimum(place, len(elements[i]) - 1)]
                                  == elements2[j]).sum())
                    if 100 * common >= rule.percent * (sizes[i] + sizes2[j] - common):
                        a.append(name)
                        b.append(names2[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return written(
        left.groupBy("grp", "i", "j").cogroup(right.groupBy("grp", "i", "j")).applyInArrow(
            compare, "a binary, b binary"), label)


def _labelled(
    df: DataFrame, rule: Similar, key: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and ``(class, label)``: the component of every class."""
    held = sketches(df, rule, key, text)
    labels = components(links_of(df, held, rule, key, text))
    classes = held.filter("class IS NOT NULL").select("class").distinct()
    return held, classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "class", F.coalesce("label", "class").alias("label"))


def near_duplicates(
    df: DataFrame, rule: Similar = Similar(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_shingles long, class binary, component_id, kept boolean)`` of every row.

    Words are what ASCII white space separates, with A-Z lowered; a text of fewer words than a
    shingle has is one shingle.  ``component_id`` is the smallest key reachable over links and
    equal sets, the row's own included; ``kept`` says that it is the row's own.  A null text or
    one without words has no shingles and is linked with nothing.  Repeated rows share a class;
    null keys count as reachable but are never the smallest unless nothing else is.  An empty
    table gives an empty table.
    """
    held, labels = _labelled(df, rule, key, text)
    least = held.filter("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("least"))
    smallest = least.join(labels, "class").groupBy("label").agg(
        F.min("least").alias("component_id"))
    of_class = labels.join(smallest, "label").select("class", "component_id")
    own = F.col("key").eqNullSafe(F.col("component_id"))
    return held.join(of_class, "class", "left").withColumn(
        "component_id", F.when(F.col("class").isNull(), F.col("key")).otherwise(
            F.col("component_id"))
    ).select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "class",
             "component_id", own.alias("kept"))


def first_of_each(
    df: DataFrame, rule: Similar = Similar(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``df`` with one row of every group of near duplicates: of those with the smallest key
    (null keys last) one.  Rows without words stay.  All columns stay; their names cannot
    clash with the operator's."""
    held, labels = _labelled(df, rule, key, text)
    chosen = held.join(labels, "class").groupBy("label").agg(F.min(F.struct(
        F.col("key").isNull().alias("missing"), "key", "text_hash")).alias("first"))
    chosen = chosen.select(F.col("first.key").alias("first_key"),
                           F.col("first.text_hash").alias("first_hash"))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"),
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"))
    same = (F.col("text_hash") == F.col("first_hash")) & F.col("key").eqNullSafe(
        F.col("first_key"))
    # equal rows of the same key: one of them
    one = rows.filter("worded").join(chosen, same, "left_semi").groupBy(
        "key", "text_hash").agg(F.first("all").alias("all"))
    return rows.filter("NOT worded").select("all").union(one.select("all")).select("all.*")
