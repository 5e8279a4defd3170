"""Suffix-array deduplication: removes bytes covered by repeated strings of ``length``
bytes, and counts words covered by repeated strings of ``words`` words.

A full suffix array sorts a suffix per byte (or word). Here only suffixes that can repeat are
sorted. Every window of ``length`` units is assigned to its anchor, the leftmost
position with the least hash of a gram of units inside it, which depends on the window's
units alone; equal windows have anchors at equal offsets. Consecutive windows with one
anchor form a run, and runs whose anchor's gram occurs once are done.

1. Runs: (gram hash, context hash, document, place). Runs with equal grams and
   contexts (all units of the run's windows) are one class, counted before they are
   shuffled; a class of two or more is repeated in whole.
2. The contexts of classes that share a gram with a different class go to buckets:
   sampled splitters range-partition them by the leading units of the anchor's
   suffix. A gram with many classes is cut by offset into slices of windows, at the
   limit one window each, which splitters can divide anywhere; equal windows always
   share a bucket, so the boundary between neighbours in different buckets needs
   no window to be looked at twice.
3. Each bucket sorts its window suffixes by multikey quicksort: by (gram, slice), then by
   one token of several units after another, parting groups as they differ and
   dropping groups of one. Neighbours that are left agree in all tokens' hashes and are then
   compared unit by unit.
4. Repeated windows of classes become spans of all their documents, which are merged and cut.

Grams and classes that many runs have are joined by ``join_hot``, so none meets in one task.

Text is UTF-8; strings never cross documents. Words are runs of other bytes than ASCII white
space, by their 64-bit hashes. Nulls: a null text is empty; null ids
are an id below all others. Repeated rows repeat each other's strings. Texts
shorter than ``length`` units have no windows; a very long text is hashed in pieces that overlap. No order
among documents counts, so there are no ties. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shingles import mix
from tessera.shared import join_hot, join_slim, map_arrow, materialize, parts_for, process_cache

NO_ID = -(1 << 63)
#: Units hashed at once; a longer text is cut into pieces of so many window starts.
PIECE = 4 << 20
_RNG = np.random.default_rng(400)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


@dataclass(frozen=True)
class Unit:
    """What strings are made of: the units of a gram and of a sort token, and bytes a unit."""

    name: str
    gram: int
    token: int
    size: int

    def values(self, raw: bytes) -> np.ndarray:
        """One 64-bit number per unit, from bytes that ``body`` gave."""
        return _BYTE[np.frombuffer(raw, np.uint8)] if self.size == 1 else np.frombuffer(raw, np.uint64)

    def body(self, texts: list[bytes]) -> list[bytes]:
        """The units of each text: its bytes, or its words' hashes."""
        return texts if self.size == 1 else word_hashes(texts)


BYTES, WORDS = Unit("bytes", 32, 50, 1), Unit("words", 8, 10, 8)


def word_hashes(texts: list[bytes], most: int = 1 << 20) -> list[bytes]:
    """The 64-bit hashes of each text's words, in order."""
    out, held, size = [], [], 0

    def flush() -> None:
        data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        sums, inverse = _sums(_BYTE[data])
        edge = np.diff(np.concatenate(([1], _SPACE[data].astype(np.int8))))
        starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        words = mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
        cuts = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in held]]))
        out.extend(words[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True))

    for text in texts:
        if held and size + len(text) > most:
            flush()
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        flush()
    return out


_RUNS = "gram long, ctx long, id long, text_hash long, at long, windows int, back int"


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the units' polynomial and the inverse powers that place a piece of it at zero."""
    n = len(values) + 1
    powers = process_cache("windows").setdefault("powers", [])
    if not powers or len(powers[0]) < n:
        both, size = [], max(n, 1 << 16)
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out, have = np.ones(size, np.uint64), 1
            while have < size:
                take = min(have, size - have)
                out[have : have + take] = out[:take] * np.uint64(pow(base, have, 1 << 64))
                have += take
            both.append(out)
        powers[:] = both
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * powers[0][: n - 1], out=sums[1:])
    return sums, powers[1]


def anchor_runs(values: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """values: the units of texts end to end, up to ends. Arrays (first window, windows, anchor, gram
    hash, context hash) of the runs of windows inside the texts."""
    starts = np.concatenate(([0], ends[:-1]))
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if len(values) < length:
        return none
    sums, inverse = _sums(values)
    grams = len(values) - gram + 1
    hashes = mix((sums[gram:] - sums[:-gram]) * inverse[:grams])
    width = length - gram + 1
    key = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(grams, dtype=np.uint64)
    padded = np.full(-(-grams // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:grams] = key
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(values) - length + 1
    anchor = (np.minimum(right[:windows], left[width - 1 : width - 1 + windows]) & np.uint64(0xFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), ends - starts)[:windows]
    valid = np.arange(windows) + length <= ends[doc]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1])) & valid
    first = np.flatnonzero(new)
    if not len(first):
        return none
    # A text's windows are together, then come places without one.
    last_of_doc = ends[doc[first]] - length
    count = np.minimum(np.append(first[1:], windows) - 1, last_of_doc) - first + 1
    stop = first + count - 1 + length
    context = mix((sums[stop] - sums[first]) * inverse[first] + count.astype(np.uint64))
    return first, count, anchor[first], hashes[anchor[first]], context


def _bodies(batches: Iterator[pa.RecordBatch], unit: Unit, rows: int = 256) -> Iterator[tuple]:
    """(other columns..., units) of every row; the text is the last column."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            cut = batch.slice(at, rows)
            texts = unit.body([(t or "").encode("utf-8", "surrogatepass") for t in cut.column(cut.num_columns - 1).to_pylist()])
            yield from zip(*(cut.column(i).to_pylist() for i in range(cut.num_columns - 1)), texts, strict=True)


def _pieces(batches: Iterator[pa.RecordBatch], length: int, unit: Unit) -> Iterator[list[tuple]]:
    """Lists of (id, text hash, offset, units), each of about PIECE units."""
    held, size, piece_units = [], 0, PIECE // unit.size
    for doc, h, body in _bodies(batches, unit):
        units = len(body) // unit.size
        for at in range(0, max(1, units - length + 1), piece_units):
            piece = body[at * unit.size : (at + piece_units + length - 1) * unit.size]
            if len(piece) >= length * unit.size:
                held.append((doc, h, at, piece))
                size += len(piece) // unit.size
            if size >= piece_units:
                yield held
                held, size = [], 0
    if held:
        yield held


def _runs(length: int, unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _pieces(batches, length, unit):
            values = unit.values(b"".join(p for *_, p in held))
            ends = np.cumsum([len(p) // unit.size for *_, p in held])
            first, count, anchor, gram, ctx = anchor_runs(values, ends, length, unit.gram)
            doc = np.searchsorted(ends, first, side="right")
            ids, hashes, offsets = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[:3])
            begin = np.concatenate(([0], ends[:-1]))[doc]
            yield pa.record_batch([pa.array(gram.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(ids[doc]), pa.array(hashes[doc]), pa.array(first - begin + offsets[doc]), pa.array(count.astype(np.int32)), pa.array((anchor - first).astype(np.int32))], names=[x.split()[0] for x in _RUNS.split(", ")])

    return run


_CONTEXTS = "lead binary, slice int, tail binary, gram long, ctx long, many boolean, skip int, windows int, bytes binary"


def _contexts(length: int, unit: Unit):
    kinds = (pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary())

    def record(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _CONTEXTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for spans, units in _bodies(batches, unit):
            part_of = lambda x, y, units=units: units[x * unit.size : y * unit.size]
            for s in spans:
                at, windows = s["at"], s["windows"]
                lead = part_of(at + s["back"], at + s["back"] + unit.gram)
                step = -(-(length - unit.gram + 1) // s["slices"])
                # Windows are cut by their distance from the anchor, which equal windows share.
                for part in range((s["back"] - windows + 1) // step, s["back"] // step + 1):
                    low, high = max(0, s["back"] - (part + 1) * step + 1), min(windows, s["back"] - part * step + 1)
                    if low < high:
                        body = part_of(at + low, at + high - 1 + length)
                        out.append((lead, part, body if step == 1 else b"", s["gram"], s["ctx"], s["many"], low, high - low, body))
                        size += len(body)
                        if size > 4 << 20:
                            yield record(out)
                            out, size = [], 0
        if out:
            yield record(out)

    return run


def _neighbours_agree(units: np.ndarray, place: np.ndarray, length: int, rows: int = 1 << 14) -> np.ndarray:
    """Whether each string of length units but the first equals the one before it in the given places."""
    strings, out = np.lib.stride_tricks.sliding_window_view(units, length), np.zeros(max(0, len(place) - 1), bool)
    for at in range(0, len(out), rows):
        some = strings[place[at : at + rows + 1]]
        out[at : at + rows] = (some[1:] == some[:-1]).all(axis=1)
    return out


def repeated_windows(group: np.ndarray, first: np.ndarray, count: np.ndarray, raw: bytes, length: int, unit: Unit = BYTES) -> np.ndarray:
    """Multikey quicksort of the windows of contexts (group, first unit, windows): true for each window, in order, that has an equal in its group."""
    sums, inverse = _sums(unit.values(raw))
    total = int(count.sum())
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + first[owner]
    part, alive = group[owner], np.arange(total)
    for level in range(0, length, unit.token):
        size = min(unit.token, length - level)
        at = place[alive] + level
        token = (sums[at + size] - sums[at]) * inverse[at]
        order = np.lexsort((token, part))
        alive, part, token = alive[order], part[order], token[order]
        new = np.concatenate(([True], (part[1:] != part[:-1]) | (token[1:] != token[:-1])))
        alone = new & np.concatenate((new[1:], [True]))
        part, alive = np.cumsum(new)[~alone], alive[~alone]
        if not len(alive):
            break
    if len(alive):
        same = (part[1:] == part[:-1]) & _neighbours_agree(np.frombuffer(raw, np.uint8 if unit.size == 1 else np.uint64), place[alive], length)
        alive = alive[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    out = np.zeros(total, bool)
    out[alive] = True
    return out


def _sorted(length: int, unit: Unit, most: int = 2 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def done(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            group = np.cumsum([i == 0 or held[i][:3] != held[i - 1][:3] for i in range(len(held))])
            sizes = np.array([len(r[8]) // unit.size for r in held])
            count = np.array([r[7] for r in held])
            hit = repeated_windows(group, np.cumsum(sizes) - sizes, count, b"".join(r[8] for r in held), length, unit)
            begin = np.cumsum(count) - count
            owner = np.repeat(np.arange(len(held)), count)
            new = hit & np.concatenate(([True], ~hit[:-1] | (owner[1:] != owner[:-1])))
            end = hit & np.concatenate((~hit[1:] | (owner[1:] != owner[:-1]), [True]))
            low, high = np.flatnonzero(new), np.flatnonzero(end)
            who = owner[low]
            skip = np.array([r[6] for r in held]) - begin
            single = ~np.array([r[5] for r in held])[who]
            low, high, who = low[single], high[single], who[single]
            if len(low):
                gram, ctx = (np.array([r[j] for r in held], np.int64)[who] for j in (3, 4))
                yield pa.record_batch([pa.array(gram), pa.array(ctx), pa.array((low + skip[who]).astype(np.int32)), pa.array((high + skip[who]).astype(np.int32))], names=["gram", "ctx", "low", "high"])

        held, size = [], 0
        for _, same in groupby(rows(), key=lambda r: r[:3]):
            group = list(same)
            if len(group) > 1:
                held += group
                size += sum(len(r[8]) // unit.size for r in group)
                if size > most // unit.size:
                    yield from done(held)
                    held, size = [], 0
        if held:
            yield from done(held)

    return run


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, repeated_words long, spans array<struct<low:long,high:long>>"


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans joined where they overlap or touch."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), kind)
    for batch in batches:
        out = []
        for doc, text, spans, words in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            gone, left, at = merged([(s["low"], s["high"]) for s in spans or ()]), hashlib.sha256(), 0
            for low, high in gone:
                left.update(raw[at:low])
                at = high
            left.update(raw[at:])
            repeated = sum(b - a for a, b in merged([(s["low"], s["high"]) for s in words or ()]))
            out.append((doc, len(raw), sum(b - a for a, b in gone), len(gone), left.hexdigest(), repeated, [{"low": a, "high": b} for a, b in gone]))
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _KEPT.split(", ")[:6]] + ["spans"])


def _repeats(slim: DataFrame, length: int, unit: Unit, parts: int, slice_classes: int) -> DataFrame:
    """id, text_hash, low, high: half-open spans of units that repeated strings of length units cover."""
    if length < unit.gram:
        raise ValueError(f"strings of {unit.name} must have {unit.gram} at least")
    runs = materialize(slim.transform(map_arrow, _runs(length, unit), _RUNS), "runs")
    grams = materialize(runs.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    runs = materialize(join_hot(runs, grams, ["gram"], "n"), "repeated")
    place = F.struct("id", "text_hash", "at", "windows", "back")
    classes = materialize(runs.groupBy("gram", "ctx").agg(F.count("*").alias("n"), F.min(place).alias("p")), "classes")
    mixed = classes.groupBy("gram").agg(F.count("*").alias("classes"), F.min("n").alias("least")).filter("classes > 1 and least = 1")
    slices = F.least(F.lit(length - unit.gram + 1), F.ceil(F.col("classes") / slice_classes)).cast("int")
    wanted = join_hot(classes, materialize(mixed.select("gram", slices.alias("slices"), "classes"), "mixed"), ["gram"], "classes")
    wanted = wanted.groupBy("p.id", "p.text_hash").agg(F.collect_list(F.struct(F.col("p.at").alias("at"), F.col("p.windows").alias("windows"), F.col("p.back").alias("back"), "gram", "ctx", (F.col("n") > 1).alias("many"), "slices")).alias("spans"))
    wanted = materialize(wanted, "wanted")
    some = join_slim(slim, wanted.select("id", "text_hash"), ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    contexts = some.join(wanted, ["id", "text_hash"]).select("spans", "text").transform(map_arrow, _contexts(length, unit), _CONTEXTS)
    key = ["lead", "slice", "tail"]
    found = contexts.repartitionByRange(parts, *key).sortWithinPartitions(*key).transform(map_arrow, _sorted(length, unit), "gram long, ctx long, low int, high int")
    whole = classes.filter("n > 1").select("gram", "ctx", F.lit(0).alias("low"), (F.col("p.windows") - 1).alias("high"), "n")
    hits = materialize(whole.unionByName(found.withColumn("n", F.lit(1).cast("long"))), "hits")
    return join_hot(runs, hits, ["gram", "ctx"], "n").select("id", "text_hash", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high") + length).alias("high")).distinct()


def repeated_spans(docs: DataFrame, length: int = 400, words: int = 50, slice_classes: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeated_words (words covered by a string of
    ``words`` words that also starts elsewhere) and the removed spans of bytes."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(docs, 16 << 20))
    by_unit = [_repeats(slim, most, unit, n, slice_classes).withColumn("unit", F.lit(unit.name)) for most, unit in ((length, BYTES), (words, WORDS))]
    of = lambda unit: F.collect_list(F.when(F.col("unit") == unit.name, F.struct("low", "high"))).alias(unit.name)
    spans = by_unit[0].unionByName(by_unit[1]).groupBy("id", "text_hash").agg(of(BYTES), of(WORDS))
    out = slim.join(spans, ["id", "text_hash"], "left")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "text", "bytes", "words").transform(map_arrow, _cut, _KEPT)
