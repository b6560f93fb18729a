"""Brown class-based bigram model: P(word | previous) = P(class | class of previous) * P(word | class).

Classes are learned from units: each of the ``HEAD`` most frequent words is a unit of its own; all other words with the same
ending (their last two bytes) are one unit, for the ``ENDINGS`` most frequent endings, and all that is left is one more. The
exchange algorithm moves one unit at a time to the class that raises the likelihood of all class bigrams of the
training texts most, until nothing moves or ``ROUNDS`` are over. The end of a text is a word with a class of its own; it is
also what a text starts after.

Then every other training word, however rare, gets the class that makes its own neighbours most likely: Spark counts the classes
before and after each word, and each word is decided from its counts alone. The class of a word is a column
of a table as long as the vocabulary; only a word never seen takes the class of its ending. Class bigrams are counted
again with the classes of the words. Transitions are interpolated with class frequencies;
emissions are discounted, and each class gives what is discounted to words never seen. All counts cover all training texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultrail.llm.tables import pick, temporary
from vaultrail.llm.textbytes import Fingerprints, lower, slices, words
from vaultrail.session import materialise

HEAD, ENDINGS, CLASSES, ROUNDS = 1500, 500, 64, 6
#: Most frequent words whose counts and classes every task holds; the others are looked up by a join.
HELD = 1 << 16


def _tokens(data: np.ndarray, bounds: np.ndarray):
    """Rows, fingerprints and endings of the words of a slice."""
    small = lower(data)
    starts, ends, row = words(small, bounds)
    tail = small[ends - 1].astype(np.int32) * 256 + np.where(ends - starts > 1, small[np.maximum(ends - 2, 0)], 0)
    return row, Fingerprints(small).of(starts, ends).view(np.int64), tail


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, bounds in slices(batch.column("text"), 1 << 22):
            _, hashed, tail = _tokens(data, bounds)
            distinct, first, n = np.unique(hashed, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(tail[first]), pa.array(n)], names=["h", "tail", "n"])


@dataclass
class Units:
    """The unit of any word: ``head`` fingerprints in order, then ``tails`` in order, then others, then the end."""

    head: np.ndarray
    tails: np.ndarray
    head_order: np.ndarray = field(init=False)
    tail_of: np.ndarray = field(init=False)

    def __post_init__(self):
        self.head_order = np.argsort(self.head)
        self.tail_of = np.full(1 << 16, len(self.head) + len(self.tails), np.int32)
        self.tail_of[self.tails] = len(self.head) + np.arange(len(self.tails))

    @property
    def end(self) -> int:
        return len(self.head) + len(self.tails) + 1

    def of(self, hashed: np.ndarray, tail: np.ndarray) -> np.ndarray:
        unit = self.tail_of[tail]
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, hashed, sorter=self.head_order), len(self.head) - 1)
            nearest = self.head_order[at]
            unit = np.where(self.head[nearest] == hashed, nearest, unit)
        return unit.astype(np.int64)


def _with_ends(row: np.ndarray, ids: np.ndarray, texts: int, end: int) -> np.ndarray:
    """The ids of all texts in one sequence, an end in front and after each text."""
    at = np.arange(len(ids)) + row + 1
    out = np.full(len(ids) + texts + 1, end, np.int64)
    out[at] = ids
    return out


def _bigrams(units: Units):
    total = units.end + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text"), 1 << 22):
                row, hashed, tail = _tokens(data, bounds)
                ids = _with_ends(row, units.of(hashed, tail), last - first, units.end)
                pairs, n = np.unique(ids[:-1] * total + ids[1:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and counts as bytes, so that the driver reads them a partition at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def close() -> pa.RecordBatch:
        pair, n = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return pa.RecordBatch.from_pylist([{"pair": pair.tobytes(), "n": n.tobytes()}], schema=pa.schema([("pair", pa.binary()), ("n", pa.binary())]))

    for batch in batches:
        held.append((batch.column("pair").to_numpy(), batch.column("n").to_numpy()))
        if sum(len(x[0]) for x in held) >= 1 << 18:
            yield close()
    if held:
        yield close()


def _by_word(h: np.ndarray, side: np.ndarray, width: int):
    """Distinct words, and for each its sides with their counts, packed as 32-bit numbers (side, count up to 65535)."""
    distinct, inverse = np.unique(h, return_inverse=True)
    keys, n = np.unique(inverse * width + side, return_counts=True)
    again = (n + 65534) // 65535
    keys, part = np.repeat(keys, again), np.full(int(again.sum()), 65535)
    part[np.cumsum(again) - 1] = n - 65535 * (again - 1)
    data = ((keys % width) << 16 | part).astype(np.uint32)
    offsets = (np.searchsorted(keys // width, np.arange(len(distinct) + 1)) * 4).astype(np.int32)
    return pa.array(distinct), pa.Array.from_buffers(pa.binary(), len(distinct), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _sides(packed: pa.Array):
    """For each number of the packed rows: its row, side and count."""
    texts = packed.to_pylist()
    data = np.frombuffer(b"".join(texts), np.uint32).astype(np.int64)
    return np.repeat(np.arange(len(texts)), [len(x) // 4 for x in texts]), data >> 16, data & 65535


def _neighbours(units: Units, own: np.ndarray):
    """(h, seen) of the words that are no units of their own: how often each class is before (side = class) or after them."""
    k = int(own.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text"), 1 << 22):
                row, hashed, tail = _tokens(data, bounds)
                unit = units.of(hashed, tail)
                cls = own[_with_ends(row, unit, last - first, units.end)]
                at = np.flatnonzero(unit >= len(units.head))
                place = at + row[at] + 1
                found = _by_word(np.concatenate((hashed[at], hashed[at])), np.concatenate((cls[place - 1], k + cls[place + 1])), 2 * k)
                yield pa.RecordBatch.from_arrays([*found], names=["h", "seen"])

    return run


def _best_class(step: np.ndarray, mass: np.ndarray):
    """(h, n, cls) of words with their neighbours: the class with the highest likelihood of both sides and of the word in it."""
    k = len(step)
    fit = np.concatenate((step, step.T)) * math.log(10)
    weight = np.where(mass > 0, np.log(np.maximum(mass, 1)), np.inf)
    weight[-1] = np.inf  # the end is no class of words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column("seen")
            word = np.repeat(np.arange(len(seen)), np.diff(seen.offsets.to_numpy()))
            row, side, n = _sides(seen.flatten())
            counts = np.bincount(word[row] * 2 * k + side, n, len(seen) * 2 * k).reshape(len(seen), 2 * k)
            total = counts[:, :k].sum(1)
            cls = np.argmax(counts @ fit - total[:, None] * weight, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(total.astype(np.int64)), pa.array(cls.astype(np.int16))], names=["h", "n", "cls"])

    return run


def exchange(counts: np.ndarray, classes: int, rounds: int) -> np.ndarray:
    """Class of each unit; the last unit, the end, keeps the last class. ``counts[a, b]`` counts b after a."""
    size = len(counts)
    used = min(classes - 1, max(1, size - 1))
    frequency = counts.sum(0)
    order = np.argsort(-frequency[: size - 1], kind="stable")
    own = np.zeros(size, np.int64)
    own[order] = np.minimum(np.arange(size - 1), used - 1) if size - 1 <= used else np.arange(size - 1) % used
    own[-1] = used
    k = used + 1
    member = np.zeros((size, k))
    member[np.arange(size), own] = 1
    after, before = counts @ member, counts.T @ member  # to class, from class
    between = member.T @ after

    def xlogx(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    for _ in range(rounds):
        moved = 0
        for w in order:
            if not frequency[w]:
                continue
            old = own[w]
            to, come, self_count = after[w].copy(), before[w].copy(), counts[w, w]
            to[old] -= self_count
            come[old] -= self_count
            # Without w: its row and column leave the old class.
            between[old] -= to
            between[:, old] -= come
            between[old, old] -= self_count
            sums = between.sum(0)
            # Gain of joining each class: changes of the rows, of the columns, and of the marginals.
            gain = (xlogx(between + to) - xlogx(between)).sum(1) + (xlogx(between + come[:, None]) - xlogx(between)).sum(0)
            diagonal = np.diagonal(between)
            gain += xlogx(diagonal + to + come + self_count) - xlogx(diagonal + to) - xlogx(diagonal + come) + xlogx(diagonal)
            gain -= 2 * (xlogx(sums + frequency[w]) - xlogx(sums))
            new = int(np.argmax(gain[:used]))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            between[new] += to
            between[:, new] += come
            between[new, new] += self_count
            if new != old:
                moved += 1
                own[w] = new
                for table, column in ((after, counts[:, w]), (before, counts[w])):
                    table[:, old] -= column
                    table[:, new] += column
        if not moved:
            break
    return own


@dataclass
class Model:
    """``step[a, b]``: log10 probability of class b after a. ``words`` has (h, n, cls) of all training words.

    ``own`` has the classes of the units: of the words of the head, and of words never seen by their endings.
    """

    units: Units
    own: np.ndarray
    step: np.ndarray
    mass: np.ndarray  # tokens by class
    unseen: np.ndarray  # log10 probability of a word never seen, by class
    discount: float
    tokens: int
    vocabulary: int
    ends: int
    held: np.ndarray
    held_counts: np.ndarray
    held_classes: np.ndarray
    words: DataFrame

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.vocabulary + 1))

    def emission(self, count: np.ndarray, cls: np.ndarray) -> np.ndarray:
        seen = np.log10(np.maximum(count - self.discount, 1e-9) / np.maximum(self.mass[cls], 1))
        return np.where(count > 0, seen, self.unseen[cls])


def fit(training: DataFrame, head: int = HEAD, endings: int = ENDINGS, classes: int = CLASSES, rounds: int = ROUNDS, held: int = HELD) -> Model:
    """Learn from all texts of ``training``; a null text is an empty one, with its end as only token."""
    texts = training.select(F.coalesce("text", F.lit("")).alias("text"))
    ends = texts.count()
    counted = texts.mapInArrow(_word_counts, "h long, tail int, n long").groupBy("h").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))
    counted = materialise(counted, "lm-words")
    sums = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    heads = counted.orderBy(F.desc("n"), "h").limit(head).select("h", "n").toPandas()
    tails = counted.groupBy("tail").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tail").limit(endings).toPandas()
    units = Units(heads["h"].to_numpy(np.int64), tails["tail"].to_numpy(np.int64))
    pairs, remove = temporary(texts.mapInArrow(_bigrams(units), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "lm-units")
    size = units.end + 1
    counts = np.zeros((size, size))
    for r in pairs.mapInArrow(_packed, "pair binary, n binary").toLocalIterator():
        counts.reshape(-1)[np.frombuffer(r["pair"], np.int64)] = np.frombuffer(r["n"], np.int64)
    remove()
    # Texts of a slice share the ends between them; the end in front of its first text stands for the one after the last.
    own = exchange(counts, classes, rounds)
    k = int(own.max()) + 1
    member = np.zeros((size, k))
    member[np.arange(size), own] = 1
    between = member.T @ counts @ member
    del counts

    spark = training.sparkSession
    near = texts.mapInArrow(_neighbours(units, own), "h long, seen binary").groupBy("h").agg(F.collect_list("seen").alias("seen"))
    words = near.mapInArrow(_best_class(_steps(between), between.sum(0)), "h long, n long, cls short")
    learned = list(zip(heads["h"].tolist(), heads["n"].tolist(), own.tolist(), strict=False))
    words = materialise(words.unionByName(spark.createDataFrame(learned, "h long, n long, cls short")), "lm-classes")
    top = words.orderBy(F.desc("n"), "h").limit(held).toPandas().sort_values("h")
    lists = {"held": top["h"].to_numpy(np.int64), "held_classes": top["cls"].to_numpy(np.int64)}
    pairs, remove = temporary(texts.mapInArrow(_class_bigrams(units, own, **lists), "h long, h2 long, seen binary, ca short, cb short, n long"), "lm-pairs")
    first, second = (words.select(F.col("h").alias(h), F.col("cls").alias(c)) for h, c in (("h", "ca"), ("h2", "cb")))
    found = pairs.where("seen is not null").select("h", "seen").join(first, "h").select("ca", "seen").mapInArrow(_class_sides(k), "ca short, cb short, n long")
    found = found.unionByName(pairs.where("h2 is not null").select("h", "h2").join(second, "h2").join(first, "h").select("ca", "cb", F.lit(1).cast("long").alias("n")))
    found = found.unionByName(pairs.where("h is null").select("ca", "cb", "n"))
    between = np.zeros((k, k))
    for r in found.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        between[r.ca, r.cb] = r.n
    remove()

    once, twice = int(sums[2]), int(sums[3])
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    types, mass = np.zeros(k), np.zeros(k)
    for r in words.groupBy("cls").agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect():
        types[r.cls], mass[r.cls] = r.types, r.n
    # A class without words has all its mass for words never seen.
    unseen = np.log10(np.where(mass > 0, np.maximum(discount * types, 1e-9) / np.maximum(mass, 1), 1.0))
    return Model(units, own, _steps(between), mass, unseen, discount, int(sums[1]) + ends, int(sums[0]) + (ends > 0), ends, lists["held"], top["n"].to_numpy(np.int64), lists["held_classes"], words)


def _steps(between: np.ndarray) -> np.ndarray:
    frequency = (between.sum(0) + 0.1) / (between.sum() + 0.1 * len(between))
    return np.log10((between + 5.0 * frequency) / (between.sum(1, keepdims=True) + 5.0))


def _path(units: Units, own: np.ndarray, held: np.ndarray, held_classes: np.ndarray, row: np.ndarray, hashed: np.ndarray, tail: np.ndarray, texts: int):
    """Along the words and ends of a slice: classes, fingerprints, and places in the held list (-1 without)."""
    at = np.minimum(np.searchsorted(held, hashed), max(len(held) - 1, 0))
    place = np.where(held[at] == hashed, at, -1) if len(held) else np.full(len(hashed), -1)
    cls = own[units.of(hashed, tail)]
    cls[place >= 0] = held_classes[place[place >= 0]]
    return _with_ends(row, cls, texts, int(own[units.end])), _with_ends(row, hashed, texts, 0), _with_ends(row, place, texts, 0)


def _class_bigrams(units: Units, own: np.ndarray, held: np.ndarray, held_classes: np.ndarray):
    """Three kinds of rows: (ca, cb, n), class pairs of held words; (h, seen), the classes of held words on the sides of a word that
    is not held; (h, h2), two words in a row that both are not held."""
    k = int(own.max()) + 1
    schema = pa.schema([("h", pa.int64()), ("h2", pa.int64()), ("seen", pa.binary()), ("ca", pa.int16()), ("cb", pa.int16()), ("n", pa.int64())])

    def made(size: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text"), 1 << 22):
                cls, hashed, place = _path(units, own, held, held_classes, *_tokens(data, bounds), last - first)
                known = place >= 0
                before, after = np.flatnonzero(known[:-1] & ~known[1:]), np.flatnonzero(~known[:-1] & known[1:])
                total += np.bincount((cls[:-1] * k + cls[1:])[known[:-1] & known[1:]], minlength=k * k)
                h, seen = _by_word(np.concatenate((hashed[before + 1], hashed[after])), np.concatenate((cls[before], k + cls[after + 1])), 2 * k)
                yield made(len(h), h=h, seen=seen)
                both = np.flatnonzero(~known[:-1] & ~known[1:])
                yield made(len(both), h=pa.array(hashed[both]), h2=pa.array(hashed[both + 1]))
        some = np.flatnonzero(total)
        yield made(len(some), ca=pa.array((some // k).astype(np.int16)), cb=pa.array((some % k).astype(np.int16)), n=pa.array(total[some]))

    return run


def _class_sides(k: int):
    """Class pairs of words of class ca with the classes on their sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * k * k)
        for batch in batches:
            row, side, n = _sides(batch.column("seen"))
            total += np.bincount(batch.column("ca").to_numpy()[row] * (2 * k) + side, n, 2 * k * k)
        total = total.reshape(k, 2 * k)
        ca, cb = np.nonzero(pairs := total[:, :k].T + total[:, k:])
        yield pa.RecordBatch.from_arrays([pa.array(ca.astype(np.int16)), pa.array(cb.astype(np.int16)), pa.array(pairs[ca, cb].astype(np.int64))], names=["ca", "cb", "n"])

    return run


#: A word that is not held: the class before it, the class after it (-1 if that word is not held: it has the step) and its own; ``h2`` is the word
#: before if that is not held either. Until a word is looked up, it has the class of its ending.
FAR = "key long, h long, h2 long, ca short, cb short, after short"


def _far_words(state: dict, both: bool):
    """Rows ``FAR`` of the words that are not held, with or without the word before held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, last, data, bounds in slices(batch.column("text")):
                row, hashed, tail = _tokens(data, bounds)
                cls, hashes, place = _path(*(state[x] for x in ("units", "own", "held", "held_classes")), row, hashed, tail, last - first)
                word = np.arange(len(row)) + row + 1
                some = (place[word] < 0) & ((place[word - 1] < 0) == both)
                at = word[some]
                after = np.where(place[at + 1] < 0, -1, cls[at + 1])
                h2 = pa.array(hashes[at - 1]) if both else pa.nulls(len(at), pa.int64())
                columns = [pa.array(keys[first + row[some]]), pa.array(hashes[at]), h2, *(pa.array(x.astype(np.int16)) for x in (cls[at - 1], cls[at], after))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "h", "h2", "ca", "cb", "after"])

    return run


def _near(state: dict):
    """Per text: its number of tokens, and what the held lists tell of it."""
    step, held_counts = state["step"], state["held_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, last, data, bounds in slices(batch.column("text")):
                texts = last - first
                row, hashed, tail = _tokens(data, bounds)
                cls, _, place = _path(*(state[x] for x in ("units", "own", "held", "held_classes")), row, hashed, tail, texts)
                # Token i of the slice is the target of step i; the ends come after their texts.
                size = np.bincount(row, minlength=texts)
                steps = np.where((place[:-1] >= 0) & (place[1:] >= 0), step[cls[:-1], cls[1:]], 0.0)
                score = np.bincount(np.repeat(np.arange(texts), size + 1), steps, minlength=texts)
                at = np.arange(len(row)) + row + 1
                local = place[at] >= 0
                at = at[local]
                count = held_counts[place[at]]
                score += np.bincount(row[local], state["emission"](count, cls[at]), minlength=texts)
                base = np.bincount(row[local], state["base"](count), minlength=texts) + float(state["base"](np.array(state["ends"])))
                known = np.bincount(row[local], minlength=texts) + (state["ends"] > 0)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[first:last], size + 1, known, base, score)], names=["key", "n_tokens", "known", "base", "score"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, key, n_tokens, n_known, base_score, score; log10 probabilities of the texts.

    Tokens are the words and one end; ``base_score`` is add-one smoothed by word. A null or empty text has the end alone. Every row
    counts, rows without doc_id and repeated ones too. Other columns are ignored. Fitted on no text at all, every
    word is unknown and scores are still finite.
    """
    rows = pick(documents, "doc_id", "text").select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    narrow = replace(model, words=None)
    state = {k: getattr(narrow, k) for k in ("units", "own", "step", "held", "held_counts", "held_classes", "ends", "emission", "base")}
    texts = rows.select("key", "text")
    single, both = (texts.mapInArrow(_far_words(state, x), FAR) for x in (False, True))
    both = both.join(model.words.select(F.col("h").alias("h2"), F.col("cls").alias("c2")), "h2", "left")
    far = single.select("key", "h", "ca", "cb", "after").unionByName(both.select("key", "h", F.coalesce("c2", "ca").alias("ca"), "cb", "after"))
    found = far.join(model.words.select("h", F.col("n").alias("c"), F.col("cls").alias("c1")), "h", "left")
    found = found.select("key", "ca", F.coalesce("c1", "cb").alias("cb"), "after", F.coalesce("c", F.lit(0)).alias("c"))
    lines = [(a, model.step[:, a].tolist(), model.step[a].tolist()) for a in range(len(model.step))]
    found = found.join(F.broadcast(rows.sparkSession.createDataFrame(lines, "cb short, come array<double>, go array<double>")), "cb")
    steps = F.col("come")[F.col("ca")] + F.when(F.col("after") >= 0, F.col("go")[F.col("after")]).otherwise(0.0)
    mass = F.array(*[F.lit(float(x)) for x in np.maximum(model.mass, 1)])
    unseen = F.array(*[F.lit(float(x)) for x in model.unseen])
    emission = F.when(F.col("c") > 0, F.log10((F.col("c") - F.lit(model.discount)) / mass[F.col("cb")])).otherwise(unseen[F.col("cb")])
    base = F.log10((F.col("c") + 1) / F.lit(float(model.tokens + model.vocabulary + 1)))
    far = found.select("key", F.lit(None).cast("long").alias("n_tokens"), (F.col("c") > 0).cast("long").alias("known"), base.alias("base"), (steps + emission).alias("score"))
    near = texts.mapInArrow(_near(state), "key long, n_tokens long, known long, base double, score double")
    # Rows with the same doc_id and text have one key; each makes its own sums, so all are divided by their number.
    sums = near.unionByName(far).groupBy("key").agg(F.count("n_tokens").alias("m"), *[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score")])
    shown = sums.select("key", (F.col("n_tokens") / F.col("m")).cast("long").alias("n_tokens"), (F.col("known") / F.col("m")).cast("long").alias("n_known"), (F.col("base") / F.col("m")).alias("base_score"), (F.col("score") / F.col("m")).alias("score"))
    return rows.select("doc_id", "key").join(shown, "key").select("doc_id", "key", "n_tokens", "n_known", "base_score", "score")


def perplexity(log10_probability: float, tokens: int) -> float:
    return math.pow(10, -log10_probability / tokens)
