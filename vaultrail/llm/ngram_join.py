"""Exact similarity join of documents on their sets of word n-grams, by prefix trees.

1. Every text becomes a set of fingerprints of its n-grams. Equal sets form a class, which one member stands for.
2. A necessary condition in a fixed order (by fingerprint): the first k common members of two sets with Jaccard similarity of at
   least t are among the first ``n - ceil(t n) + k`` of each. With k about ``(1 - t) n``, a class that shares fewer of
   these with other classes than k is for its smallest partner has no partner.
3. For the classes that are left, the global order is by document frequency, rare first. Members that occur in one class
   only come first and match nothing; a class with as many of them as its prefix is long has no partner.
4. Classes with a common prefix member meet in a group. A group whose classes are those of another group, or
   all have the last prefix member of another one, is left out. In a task, the sets of a group form a path-compressed trie in the order of fingerprints, which is the same everywhere; each
   set walks it once, sharing the overlap counted so far among all sets below a node, and leaves a subtree as soon as the lengths that
   remain cannot reach the overlap needed.
5. A group yields a spanning forest of its links. Components follow from the forests of all groups.

A group larger than ``2 * PART`` is divided into parts, and each two parts meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.llm.tables import components, join_narrow, pick, temporary
from vaultrail.llm.textbytes import Fingerprints, lower, mix, slices, words
from vaultrail.session import materialise

#: Members of a group that one task compares with as many others at a time.
PART = 1000


def needed(total: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Smallest intersection of two sets whose sizes sum to ``total``: 100 i >= percent (total - i)."""
    return -(-percent * total // (100 + percent))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n + percent * n // -100 + 1


def early(n: np.ndarray, percent: int) -> np.ndarray:
    """Common members that the first condition asks of two sets of size ``n``."""
    return np.maximum(1, (100 - percent) * n // 100)


def ngram_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and fingerprints of the distinct n-grams of each text, sorted by both.

    A text of fewer words than ``size`` has its whole sequence as its only n-gram; without words it has none.
    """
    small = lower(data)
    starts, ends, row = words(small, bounds)
    if not len(starts):
        return row, np.empty(0, np.int64)
    hashed = Fingerprints(small).of(starts, ends)
    count = np.bincount(row, minlength=len(bounds) - 1)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    grams = np.maximum(count - size + 1, np.minimum(count, 1))
    rows = np.repeat(np.arange(len(count)), grams)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(grams) - grams, grams) + first[rows]
    length = np.minimum(count[rows], size)
    value = np.zeros(len(rows), np.uint64)
    for k in range(size):
        there = length > k
        value[there] = mix(value[there] * np.uint64(0xD6E8FEB86659FD93) + hashed[at[there] + k] + np.uint64(k + 1))
    value = value.view(np.int64)
    order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    fresh = np.concatenate(([True], (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])))
    return rows[fresh], value[fresh]


def _digests(value: np.ndarray, ends: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each set, the ranges of ``value`` of ``n`` numbers that stop at ``ends``."""
    sums = []
    for salt in (0x1234567, 0x89ABCDEF01):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value.view(np.uint64) + np.uint64(salt)))))
        sums.append((total[ends] - total[ends - n]).view(np.int64))
    return sums


def _signatures(size: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("prefix", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text")):
                rows, value = ngram_sets(data, bounds, size)
                n = np.bincount(rows, minlength=last - first)
                ends = np.cumsum(n)
                take = np.where(n > 0, np.minimum(n, prefix_length(n, percent) - 1 + early(n, percent)), 0)
                raw = [value[e - m : e - m + p].tobytes() for e, m, p in zip(ends.tolist(), n.tolist(), take.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first).cast(pa.int64()), pa.array(n), *map(pa.array, _digests(value, ends, n)), pa.array(raw, pa.binary())], schema=schema)

    return run


def _exploded(field: str):
    """One row (token, rep) for each 64-bit number in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, reps = batch.column(field).to_pylist(), batch.column("rep").to_numpy()
            for i in range(0, len(raw), 2000):
                part = raw[i : i + 2000]
                tokens = np.frombuffer(b"".join(part), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.repeat(reps[i : i + 2000], [len(x) // 8 for x in part]))], names=["token", "rep"])

    return run


def _tokens(size: int):
    """One row (token, rep) for each distinct n-gram of a text, if the text has the set of the class it came for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, wanted = batch.column("rep").to_numpy(), [batch.column(c).to_numpy() for c in ("n", "d1", "d2")]
            for first, last, data, bounds in slices(batch.column("text")):
                rows, value = ngram_sets(data, bounds, size)
                n = np.bincount(rows, minlength=last - first)
                right = np.all([w[first:last] == x for w, x in zip(wanted, (n, *_digests(value, np.cumsum(n), n)), strict=True)], axis=0)
                rows, value = rows[right[rows]], value[right[rows]]
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(reps[first + rows])], names=["token", "rep"])

    return run


def _ordered_sets(percent: int):
    """Per class: its members shared with other classes, and those of them that lie in the rare-first prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rep, n, members in zip(batch.column("rep").to_pylist(), batch.column("n").to_pylist(), batch.column("members"), strict=True):
                df, token = (members.values.field(k).to_numpy() for k in ("df", "token"))
                order = np.lexsort((token, df))
                reach = int(prefix_length(n, percent)) - (n - len(order))
                if reach > 0:
                    out.append((rep, n, np.sort(token).tobytes(), token[order[:reach]].tobytes(), int(token[order[:reach][-1]])))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["rep", "n", "shared", "prefix", "last"]), schema=pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("shared", pa.binary()), ("prefix", pa.binary()), ("last", pa.int64())]), preserve_index=False)

    return run


class _Node:
    __slots__ = ("children", "last", "leaves", "least", "longest", "most", "segment", "top")

    def __init__(self, segment, leaves, children, sizes, longest, top):
        self.segment, self.leaves, self.children = segment, leaves, children
        self.least, self.most = sizes
        self.longest, self.top = longest, top
        self.last = int(segment[-1]) if len(segment) else -1


def build_trie(sets: list[np.ndarray], sizes: np.ndarray, members: list[int], depth: int = 0) -> _Node:
    """Path-compressed trie of the ``members``, which are sorted and agree in their first ``depth`` numbers."""
    root: list[_Node] = []
    todo = [(members, depth, root)]
    while todo:
        group, at, siblings = todo.pop()
        low, high = sets[group[0]], sets[group[-1]]
        m = min(len(low), len(high))
        differ = np.flatnonzero(low[at:m] != high[at:m])
        end = at + int(differ[0]) if len(differ) else m
        own = sizes[group]
        node = _Node(low[at:end], [g for g in group if len(sets[g]) == end], [], (int(own.min()), int(own.max())), max(len(sets[g]) for g in group) - end, max(group))
        siblings.append(node)
        rest = [g for g in group if len(sets[g]) > end]
        begin = 0
        for i in range(1, len(rest) + 1):
            if i == len(rest) or sets[rest[i]][end] != sets[rest[begin]][end]:
                todo.append((rest[begin:i], end, node.children))
                begin = i
    return root[0]


def links(sets: list[np.ndarray], sizes: np.ndarray, percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets whose numbers ascend in the global order.

    ``sizes`` counts all members of a set, those left out of it as unmatched too. With ``sides``, only sets of
    different sides are compared.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
    trie = build_trie(sets, sizes, order)
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    inside = np.zeros(max((int(s[-1]) for s in sets if len(s)), default=-1) + 1, bool)
    found: list[tuple[int, int]] = []
    for x in range(len(sets)):
        if len(found) == len(sets) - 1:
            break
        own, size = sets[x], int(sizes[x])
        inside[own] = True
        todo = [(trie, 0)]
        while todo:
            node, overlap = todo.pop()
            if node.top <= x or 100 * node.most < percent * size or 100 * size < percent * node.least:
                continue
            overlap += int(np.count_nonzero(inside[node.segment]))
            left = len(own) - int(np.searchsorted(own, node.last, "right")) if node.last >= 0 else len(own)
            if overlap + min(left, node.longest) < needed(size + node.least, percent):
                continue
            for y in node.leaves:
                if y > x and (sides is None or sides[x] != sides[y]) and overlap >= needed(size + int(sizes[y]), percent):
                    a, b = find(x), find(y)
                    if a != b:
                        parent[a] = b
                        found.append((x, y))
            todo.extend((child, overlap) for child in node.children)
        inside[own] = False
    return found


def _group_links(percent: int):
    """Links of each group; rows come sorted by group and may continue in the next batch."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        local = np.unique(np.frombuffer(b"".join([r["shared"] for r in rows]), np.int64), return_inverse=True)[1]
        sets = np.split(local, np.cumsum([len(r["shared"]) // 8 for r in rows])[:-1])
        sides = np.array([r["side"] for r in rows])
        reps = [r["rep"] for r in rows]
        return [(reps[x], reps[y]) for x, y in links(sets, np.array([r["n"] for r in rows]), percent, sides if sides.min() != sides.max() else None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple[int, int]] = []

        def flush():
            nonlocal out
            table = pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["u", "v"])
            out = []
            return table

        for batch in batches:
            for row in batch.to_pylist():
                if held and any(held[0][k] != row[k] for k in ("token", "i", "j")):
                    out += solve(held)
                    held = []
                held.append(row)
            yield flush()
        if held:
            out += solve(held)
        yield flush()

    return run


def classes_of(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, Callable[[], None]]:
    """(doc_id, n, d1, d2) of every row, one row for each distinct non-empty set, and the doc_ids of several rows.

    A class has its smallest doc_id (low) and a number of its own (rep): the same, unless that doc_id has several rows.
    The early members of the classes (rep, low, prefix) are a table of their own, with a function that removes it.
    """
    rows = pick(documents, "doc_id", "text")
    signatures, remove_signatures = temporary(rows.mapInArrow(_signatures(size, percent), "doc_id long, n long, d1 long, d2 long, prefix binary"), "ngram-signatures")
    signed = materialise(signatures.drop("prefix"), "ngram-rows")
    sets = signatures.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("low"), F.first("prefix").alias("prefix"))
    several = signed.groupBy(F.col("doc_id").alias("low")).count().where("low is not null and count > 1").select("low", F.lit(True).alias("several"))
    several = materialise(several, "ngram-several")
    sets = sets.join(several, "low", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    greatest = signed.agg(F.max("doc_id")).first()[0] or 0
    fresh = F.lit(greatest) + 1 + F.monotonically_increasing_id()
    full, remove_full = temporary(sets.withColumn("rep", F.when(F.col("several"), fresh).otherwise(F.col("low"))), "ngram-early")
    remove_signatures()
    sets = materialise(full.drop("prefix"), "ngram-classes")
    return signed, sets, several.select(F.col("low").alias("doc_id")), full.select("rep", "low", "prefix"), remove_full


def class_links(documents: DataFrame, sets: DataFrame, prefixes: DataFrame, remove_prefixes: Callable[[], None], size: int, percent: int) -> DataFrame:
    """Links (u, v) between classes, enough to connect all that are connected. Removes ``prefixes`` when it has read them."""
    named = sets.where("low is not null")
    first = prefixes.where("low is not null").select("rep", "prefix").mapInArrow(_exploded("prefix"), "token long, rep long")
    met = first.withColumns({"low": F.min("rep").over(Window.partitionBy("token")), "high": F.max("rep").over(Window.partitionBy("token"))})
    shared = met.where("low < high").groupBy("rep").agg(F.count("*").alias("shared"))
    smallest = F.ceil(F.col("n") * percent / F.lit(100))
    enough = F.col("shared") >= F.greatest(F.lit(1), F.floor(smallest * (100 - percent) / F.lit(100)))
    left = shared.join(named.select("rep", "low", "n", "d1", "d2", "several"), "rep").where(enough).drop("shared")
    left = materialise(left, "ngram-left")
    remove_prefixes()
    texts = join_narrow(pick(documents, "doc_id", "text").withColumnRenamed("doc_id", "low"), left, "low")
    # Several rows of one doc_id may have the set of the class; they give its n-grams once.
    tokens = texts.where("not several").mapInArrow(_tokens(size), "token long, rep long")
    tokens = tokens.unionByName(texts.where("several").mapInArrow(_tokens(size), "token long, rep long").distinct())
    common = tokens.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    members = common.groupBy("rep").agg(F.collect_list(F.struct("df", "token")).alias("members"))
    members = members.join(named.select("rep", "n"), "rep").select("rep", "n", "members")
    ordered = materialise(members.mapInArrow(_ordered_sets(percent), "rep long, n long, shared binary, prefix binary, last long"), "ngram-ordered")
    entries = ordered.select("rep", "prefix").mapInArrow(_exploded("prefix"), "token long, rep long").join(ordered.select("rep", "last"), "rep")
    prints = [F.bit_xor(F.xxhash64(F.lit(k), "rep")).alias(f"x{k}") for k in (0, 1)]
    groups = entries.groupBy("token").agg(F.count("*").alias("m"), F.min("last").alias("low"), F.max("last").alias("high"), *prints)
    # If the last prefix member of all its classes is the same other token, that token's group holds this one.
    groups = groups.where("m > 1 and (low <> high or low = token)")
    # Of groups of the same classes, one is enough.
    groups = groups.groupBy("m", "x0", "x1").agg(F.min("token").alias("token")).select("token", "m")
    parts = F.ceil(F.col("m") / F.lit(PART)).cast("int")
    spread = entries.join(groups, "token").select("token", "rep", F.when(F.col("m") > 2 * PART, parts).otherwise(F.lit(1)).alias("parts"))
    spread = spread.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    pairs = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("token", "rep", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    full = pairs.join(ordered.select("rep", "n", "shared"), "rep").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "rep")
    return full.mapInArrow(_group_links(percent), "u long, v long")


def similarity_components(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Components of the documents linked by n-gram similarity: doc_id, n_ngrams, component_id.

    Words are runs of characters other than space and 0x09 to 0x0D, with A to Z lower-cased; ``size`` words make an n-gram
    and a shorter text is one n-gram. Two rows are linked if 100 times the intersection of their sets is at least
    ``percent`` times the union. ``component_id`` is the smallest doc_id that links reach.

    A null or empty text has an empty set and its own doc_id as component. Rows with equal sets are linked; so are
    rows that share a doc_id with different texts. A row without doc_id takes the component of rows with an equal
    set, or null. Other columns are ignored. An empty table gives an empty result.
    """
    signed, sets, several, prefixes, remove_prefixes = classes_of(documents, size, percent)
    edges = class_links(documents, sets, prefixes, remove_prefixes, size, percent)
    # Classes that share a doc_id, by texts of its own, are linked.
    again = signed.join(several, "doc_id", "left_semi")
    again = again.join(sets, ["n", "d1", "d2"]).select("doc_id", "rep")
    least = again.groupBy("doc_id").agg(F.min("rep").alias("v"))
    edges = edges.unionByName(again.join(least, "doc_id").select(F.col("rep").alias("u"), "v").where("u <> v"))
    joined = components(edges).withColumnRenamed("node", "rep")
    named = sets.select("n", "d1", "d2", "rep", "low").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = materialise(named, "ngram-named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    result = signed.join(named.join(lowest, "component").select("n", "d1", "d2", "component_id"), ["n", "d1", "d2"], "left")
    return result.select("doc_id", F.col("n").alias("n_ngrams"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row, that of smallest doc_id, of each group that n-gram similarity connects.

    Groups are those of :func:`similarity_components`, but a row is known by its doc_id and text: rows that share a doc_id or have
    none are linked by their texts alone, so of unrelated texts under one doc_id each stays, and of equal rows one. Among texts of one
    doc_id the smallest SHA-256 stays; a row without doc_id stays only where its group has no other. Rows without words (null
    and empty texts) are in no group and all stay. All columns come back, whatever their names.
    """
    base = documents.select(F.struct("*").alias("row"), documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    several = base.groupBy(F.col("doc_id").alias("again")).count().where("again is null or count > 1").select("again")
    several = materialise(several, "repeated-ids")
    if not several.limit(1).count():
        groups = similarity_components(base, size, percent).where("n_ngrams > 0")
        leaving = materialise(groups.where("component_id <> doc_id").select("doc_id"), "near-duplicates")
        return join_narrow(base, leaving, "doc_id", "left_anti").select("row.*")
    shared = F.col("doc_id").eqNullSafe(F.col("again"))
    single = join_narrow(base, several, shared, "left_anti")
    repeated = join_narrow(base, several, shared, "left_semi").withColumn("content", F.sha2(F.coalesce("text", F.lit("")), 256))
    # Each text under a repeated or missing doc_id gets a number of its own, beyond all doc_ids.
    greatest = base.agg(F.max("doc_id")).first()[0] or 0
    numbers = repeated.select(F.col("doc_id").alias("own"), F.col("content").alias("digest")).distinct()
    numbers = materialise(numbers.withColumn("key", F.lit(greatest) + 1 + F.monotonically_increasing_id()), "repeated-rows")
    repeated = join_narrow(repeated, numbers, F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("content") == F.col("digest")))
    keyed = single.select("doc_id", "text").unionByName(repeated.select(F.col("key").alias("doc_id"), "text"))
    groups = similarity_components(keyed, size, percent).where("n_ngrams > 0").select(F.col("doc_id").alias("key"), "component_id").distinct()
    groups = groups.join(numbers.withColumn("numbered", F.lit(True)), "key", "left")
    named = F.when(F.col("numbered"), F.col("own")).otherwise(F.col("key"))
    groups = materialise(groups.select("key", "component_id", named.isNull().alias("nameless"), named.alias("named"), F.coalesce("digest", F.lit("")).alias("digest")), "near-groups")
    first = groups.groupBy("component_id").agg(F.min_by("key", F.struct("nameless", "named", "digest")).alias("kept"))
    known = materialise(groups.join(first, "component_id").select("key", (F.col("key") == F.col("kept")).alias("stays")), "near-known")
    rest = join_narrow(single, known.where("not stays").select(F.col("key").alias("doc_id")), "doc_id", "left_anti").select("row")
    judged = join_narrow(repeated, known, "key", "left")
    wordless = judged.where("stays is null").select("row")
    # Equal rows may be many; one of them is kept by a partial aggregate, without bringing them together.
    one = judged.where("stays").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return rest.unionByName(wordless).unionByName(one).select("row.*")
