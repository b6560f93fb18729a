"""Removal of long byte strings that occur more than once, by blockwise suffix sorting with a difference cover.

1. Buckets. The suffixes that start with at least ``SIZE`` bytes of their text fall into buckets by the smallest ``KEY``-byte fingerprint
   within their first ``SIZE`` bytes (the first of equal ones). Suffixes that agree in ``SIZE`` bytes are in one bucket, at
   the same distance from the place of that key, their anchor. Suffixes of one text that share an anchor are neighbours
   and form a segment. A bucket with one segment has nothing that repeats.
2. Equal segments are one segment that occurs several times: all of its suffixes repeat.
3. Buckets with different segments are sorted, one after the other, in blocks of bounded size. The segments of a block are
   laid out with their anchors at multiples of ``PERIOD``. The places in the difference cover are ranked first, by doubling
   along multiples of the period. Suffixes are then ordered by the few bytes in front of their next place in the cover and,
   as long ties go, by that place's rank, so no suffix is compared byte by byte. Neighbours in that order that agree in ``SIZE`` bytes
   repeat each other.
4. The bytes of all suffixes that repeat are removed from their texts.

A bucket with more than ``HOT`` different segments would not fit into a block. It is split into its suffixes: a fingerprint of each
tells which may repeat, and those are grouped by all their bytes, so a part of a split bucket holds equal suffixes only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultrail.llm.tables import join_narrow
from vaultrail.llm.textbytes import Fingerprints, mix, slices
from vaultrail.session import materialise

SIZE, KEY = 200, 48
#: Any two numbers have a common distance below PERIOD at which both are in the cover modulo PERIOD.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Bytes of segments that are sorted at a time; different segments of a bucket in a block.
BLOCK, HOT = 2_000_000, 20_000


def anchors(data: np.ndarray, size: int = SIZE, key: int = KEY) -> np.ndarray:
    """For each start of ``size`` bytes: the place of the smallest key among those inside, the first of equal ones."""
    hashed = Fingerprints(data).all_of(key)
    window = size - key + 1
    n = len(hashed) - window + 1
    bits = np.uint64(window.bit_length())
    blocks = -(-len(hashed) // window)
    keys = np.full(blocks * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    keys[: len(hashed)] = (hashed >> bits) << bits
    keys = (keys | np.tile(np.arange(window, dtype=np.uint64), blocks)).reshape(blocks, window)
    front = np.minimum.accumulate(keys, axis=1).reshape(-1)
    back = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    left, right = back[:n], front[window - 1 : window - 1 + n]
    first = (left >> bits) <= (right >> bits)
    at = np.arange(n)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    begin = np.where(first, at // window, (at + window - 1) // window) * window
    return begin + (np.where(first, left, right) & mask).astype(np.int64)


def segments(data: np.ndarray, bounds: np.ndarray, size: int = SIZE, key: int = KEY):
    """Runs of starts with one anchor: text, first start in it, number of starts, anchor's distance, bucket, digest."""
    if len(data) < size:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    place = anchors(data, size, key)
    at = np.arange(len(place))
    row = np.searchsorted(bounds, at, "right") - 1
    inside = np.flatnonzero(at + size <= bounds[row + 1])
    place, row = place[inside], row[inside]
    begin = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])))) if len(inside) else np.empty(0, np.int64)
    count = np.diff(np.append(begin, len(inside)))
    low, row, place = inside[begin], row[begin], place[begin]
    prints = Fingerprints(data)
    bucket = prints.of(place, place + key)
    digest = mix(prints.of(low, low + count - 1 + size) * np.uint64(0xD6E8FEB86659FD93) + (place - low).astype(np.uint64))
    return row, low - bounds[row], count, place - low, bucket.view(np.int64), digest.view(np.int64)


def _segments(size: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, _, data, bounds in slices(batch.column("text")):
                row, low, count, reach, bucket, digest = segments(data, bounds, size, key)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(digest), pa.array(keys[first + row]), pa.array(low.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(reach.astype(np.int32))], names=["bucket", "digest", "key", "low", "n", "reach"])

    return run


def _cut(size: int):
    """The bytes of the segments asked for, by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column("text").cast(pa.binary()), batch.column("wanted"), strict=True):
                raw, rows = text.as_py(), wanted.as_py()
                part = [raw[w["low"] : w["low"] + w["n"] - 1 + size] for w in rows]
                columns = [[w[c] for w in rows] for c in ("bucket", "digest", "n", "reach", "hot")]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*columns, part], types, strict=True)], names=["bucket", "digest", "n", "reach", "hot", "bytes"])

    return run


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Rank of each row of the columns in lexicographic order, equal rows sharing a rank."""
    order = np.lexsort(columns[::-1])
    fresh = np.zeros(len(order), bool)
    for c in columns:
        own = c[order]
        fresh[1:] |= own[1:] != own[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh)
    return rank


def repeated(parts: list[bytes], buckets: np.ndarray, counts: np.ndarray, reach: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Whether each suffix of a block repeats in another segment of its bucket, for all suffixes in order of segments."""
    longest = size + 2 * PERIOD * 4
    lengths = np.array([len(p) for p in parts])
    # Anchors at multiples of the period.
    begin = np.empty(len(parts), np.int64)
    at = 0
    for i, (n, r) in enumerate(zip(lengths.tolist(), reach.tolist(), strict=True)):
        at += -(at + r) % PERIOD
        begin[i] = at
        at += n
    text = np.zeros(at + longest + 8, np.uint8)
    for p, b in zip(parts, begin.tolist(), strict=True):
        text[b : b + len(p)] = np.frombuffer(p, np.uint8)
    word = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        word |= text[k : k + len(word)].astype(np.uint64) << np.uint64(8 * (7 - k))
    # Ranks of the places in the cover: by PERIOD bytes, then by twice as many, until they reach SIZE bytes.
    limit = at + PERIOD
    offsets = np.array(COVER)
    sample = (np.arange(-(-limit // PERIOD))[:, None] * PERIOD + offsets).reshape(-1)
    width, rank = PERIOD, _dense(word[sample], word[sample + 8], word[sample + 16], word[sample + PERIOD - 8])
    while width < size:
        step = len(COVER) * (width // PERIOD)
        after = np.concatenate((rank[step:], np.full(min(step, len(rank)), -1)))
        rank, width = _dense(rank, after), 2 * width
    # Suffixes, by bucket and distance to the anchor; the distance fixes the way to the next place in the cover.
    segment = np.repeat(np.arange(len(parts)), counts)
    nth = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    start, distance = begin[segment] + nth, reach[segment] - nth
    ways = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
    way = ways[start % PERIOD]
    nearest = start + way
    index = np.empty(PERIOD, np.int64)
    index[offsets] = np.arange(len(COVER))
    tie = rank[nearest // PERIOD * len(COVER) + index[nearest % PERIOD]]
    heads = []
    for k in range(0, int(ways.max()), 8):
        left = np.clip(way - k, 0, 8).astype(np.uint64)
        heads.append(np.where(left > 0, word[start + k] >> (np.uint64(64) - np.maximum(left, np.uint64(1)) * np.uint64(8)), np.uint64(0)))
    place = buckets[segment] * np.int64(1024) + distance
    order = np.lexsort((tie, *heads[::-1], place))
    same = place[order][1:] == place[order][:-1]
    near = np.flatnonzero(same)
    a, b = start[order[near]], start[order[near + 1]]
    alike = np.ones(len(near), bool)
    live = np.arange(len(near))
    for k in [*range(0, size - 8, 8), size - 8]:
        equal = word[a[live] + k] == word[b[live] + k]
        alike[live[~equal]] = False
        live = live[equal]
    out = np.zeros(len(segment), bool)
    out[order[near[alike]]] = True
    out[order[near[alike] + 1]] = True
    return out


def _sorted_blocks(size: int):
    """Runs of repeated suffixes of each segment; rows come sorted by bucket and may go on in the next batch."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        buckets = np.array([r["bucket"] for r in rows], np.int64)
        ordinal = np.cumsum(np.concatenate(([0], buckets[1:] != buckets[:-1])))
        counts, reach = np.array([r["n"] for r in rows]), np.array([r["reach"] for r in rows])
        found = repeated([r["bytes"] for r in rows], ordinal, counts, reach, size)
        out = []
        for r, end in zip(rows, np.cumsum(counts).tolist(), strict=True):
            own = np.concatenate(([False], found[end - r["n"] : end], [False]))
            edges = np.flatnonzero(own[1:] != own[:-1])
            out.append([{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array([r["digest"] for r in rows], pa.int64()), pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], names=["bucket", "digest", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        total = 0
        for batch in batches:
            for row in batch.to_pylist():
                if total >= BLOCK and row["bucket"] != held[-1]["bucket"]:
                    yield solve(held)
                    held, total = [], 0
                held.append(row)
                total += len(row["bytes"])
        if held:
            yield solve(held)

    return run


def _windows(size: int, print_of=Fingerprints):
    """One row for each suffix of a segment: its fingerprint, and where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["bytes"], np.uint8)
                values = print_of(data).all_of(size).view(np.int64)
                n = len(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["bucket"])), pa.array(np.full(n, row["digest"])), pa.array(np.arange(n, dtype=np.int32)), pa.array(values)], names=["bucket", "digest", "nth", "value"])

    return run


def _suffixes(size: int):
    """The bytes of the suffixes asked for, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, n = row["places"], len(row["places"])
                yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]] * n, pa.int64()), pa.array([row["digest"]] * n, pa.int64()), pa.array(at, pa.int32()), pa.array([row["bytes"][i : i + size] for i in at], pa.binary())], names=["bucket", "digest", "nth", "suffix"])

    return run


def _split(parts: DataFrame, size: int, print_of=Fingerprints) -> DataFrame:
    """(bucket, digest, runs) of the segments of buckets too large for a block, decided by the bytes of their suffixes.

    Fingerprints only leave out suffixes that cannot repeat. The others are counted by all their bytes, with partial sums, and
    meet the counts by an equi-join, which the planner may split where one suffix stands in very many segments.
    """
    each = parts.mapInArrow(_windows(size, print_of), "bucket long, digest long, nth int, value long")
    each = materialise(each, "suffix-values")
    twice = each.groupBy("value").agg(F.count("*").alias("m")).where("m > 1").select("value")
    asked = each.join(twice, "value", "left_semi").groupBy("bucket", "digest").agg(F.collect_list("nth").alias("places"))
    cut = parts.select("bucket", "digest", "bytes").join(asked, ["bucket", "digest"]).select("bucket", "digest", "bytes", "places")
    cut = materialise(cut.mapInArrow(_suffixes(size), "bucket long, digest long, nth int, suffix binary"), "suffix-candidates")
    equal = cut.groupBy("suffix").agg(F.count("*").alias("m")).where("m > 1").select("suffix")
    runs = F.transform(F.collect_list("nth"), lambda x: F.struct(x.alias("a"), (x + 1).alias("b"))).alias("runs")
    return cut.join(equal, "suffix", "left_semi").groupBy("bucket", "digest").agg(runs)


def repeated_spans(texts: DataFrame, size: int = SIZE, key: int = KEY, hot: int = HOT, print_of=Fingerprints) -> DataFrame:
    """(key, spans): the byte ranges to remove of each of ``texts`` (key, text), unmerged, for texts that have any."""
    cut = texts.mapInArrow(_segments(size, key), "bucket long, digest long, key long, low int, n int, reach int")
    cut = materialise(cut, "suffix-all")
    # Counts by partial sums and equi-joins: a bucket of any size is counted in parts and its rows may be split.
    shared = cut.groupBy("bucket").agg(F.count("*").alias("times")).where("times > 1").select("bucket")
    met = materialise(cut.join(shared, "bucket", "left_semi"), "suffix-segments")
    different = met.groupBy("bucket", "digest").agg(F.count("*").alias("times"), F.min(F.struct("key", "low", "n", "reach")).alias("one"))
    different = materialise(different.select("bucket", "digest", "times", "one.*"), "suffix-different")
    mixed = different.groupBy("bucket").agg(F.count("*").alias("others")).where("others > 1").select("bucket", (F.col("others") > hot).alias("hot"))
    asked = different.join(mixed, "bucket").groupBy("key").agg(F.collect_list(F.struct("bucket", "digest", "low", "n", "reach", "hot")).alias("wanted"))
    needed = materialise(asked, "suffix-asked")
    found = join_narrow(texts, needed.select("key"), "key", "left_semi").dropDuplicates(["key"]).join(needed, "key").select("text", "wanted")
    parts = materialise(found.mapInArrow(_cut(size), "bucket long, digest long, n int, reach int, hot boolean, bytes binary"), "suffix-parts")
    cold = parts.where("not hot").drop("hot").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sorted_blocks(size), "bucket long, digest long, runs array<struct<a:int,b:int>>")
    runs = cold.unionByName(_split(parts.where("hot"), size, print_of)).where(F.size("runs") > 0)
    # A segment that occurs several times repeats as a whole.
    whole = different.where("times > 1").select("bucket", "digest", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("runs"))
    runs = runs.join(whole.select("bucket", "digest"), ["bucket", "digest"], "left_anti").unionByName(whole)
    hits = met.join(runs, ["bucket", "digest"]).select("key", F.explode("runs").alias("r"), "low")
    spans = hits.select("key", F.struct((F.col("low") + F.col("r.a")).alias("a"), (F.col("low") + F.col("r.b") - 1 + size).alias("b")).alias("span"))
    return spans.groupBy("key").agg(F.collect_set("span").alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in runs)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(raw)], strict=True))


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without characters that they hold in part only."""
    out = []
    for a, b in runs:
        while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def keyed(documents: DataFrame) -> DataFrame:
    """The caller's row as one column, its doc_id and text, and ``dedup_key``: one number for each doc_id and text; a null text is an empty one."""
    key = F.xxhash64(documents["doc_id"], F.coalesce(documents["text"], F.lit("")))
    return documents.select(F.struct("*").alias("row"), documents["doc_id"].alias("doc_id"), documents["text"].alias("text"), key.alias("dedup_key"))


def with_spans(rows: DataFrame, size: int = SIZE, key: int = KEY, hot: int = HOT) -> DataFrame:
    """Keyed rows with their ``dedup_spans`` (null if nothing is removed)."""
    texts = rows.select(F.col("dedup_key").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    spans = materialise(repeated_spans(texts, size, key, hot), "suffix-spans").withColumnsRenamed({"key": "dedup_key", "spans": "dedup_spans"})
    named = spans.select("dedup_key")
    touched = join_narrow(rows, named, "dedup_key", "left_semi").join(spans, "dedup_key")
    free = join_narrow(rows, named, "dedup_key", "left_anti").withColumn("dedup_spans", F.lit(None).cast("array<struct<a:int,b:int>>"))
    return touched.select(*rows.columns, "dedup_spans").unionByName(free.select(*rows.columns, "dedup_spans"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, spans in zip(batch.column("text"), batch.column("dedup_spans"), strict=True):
            raw = (text.as_py() or "").encode()
            runs = merged(spans.as_py() or [])
            out.append((len(raw), sum(b - a for a, b in runs), [{"start": a, "end": b} for a, b in runs], hashlib.sha256(without(raw, runs)).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "n_bytes", "n_removed", "removed", "kept_sha256"])


def removed_spans(documents: DataFrame, size: int = SIZE, key: int = KEY, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, removed (maximal byte ranges), kept_sha256 (of the bytes left, hexadecimal).

    Texts are UTF-8 bytes. A byte is removed if a string of ``size`` bytes that covers it also starts anywhere else, in the
    same text or another, overlaps included; strings never cross texts and are judged on the input.
    Repeated rows are texts of their own, so they repeat each other. A null text is empty; texts shorter than ``size`` stay as they are.
    Rows without doc_id are kept. Other columns are ignored; an empty table gives an empty result.
    """
    rows = keyed(documents).select("doc_id", "text", "dedup_key")
    full = with_spans(rows, size, key, hot).select("doc_id", "text", "dedup_spans")
    return full.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept_sha256 string")


def deduplicated(documents: DataFrame, size: int = SIZE, key: int = KEY, hot: int = HOT) -> DataFrame:
    """``documents`` with repeated strings taken out of the texts, as far as whole characters go, and n_chars set anew.

    Every row stays, repeated ones and those without doc_id too; a null text stays null. All columns come back, whatever their names.
    """
    rows = with_spans(keyed(documents).select("row", "text", "dedup_key"), size, key, hot)

    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, spans, strict=True):
            if text is None or own is None:
                out.append(text)
            else:
                raw = text.encode()
                out.append(without(raw, whole_characters(raw, merged(list(own)))).decode())
        return pd.Series(out)

    texts = F.when(F.col("dedup_spans").isNull(), F.col("text")).otherwise(F.pandas_udf(cut, "string")("text", "dedup_spans"))
    kept = rows.select("row", texts.alias("text"))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in documents.columns:
        row = row.withField("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(documents.schema["n_chars"].dataType))
    return kept.select(row.alias("row")).select("row.*")
