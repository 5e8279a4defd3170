"""N-gram Jaccard join with multiple global orders, exact.

Documents link when the Jaccard similarity of their sets of word shingles is at
least ``threshold`` percent. Result: one row per document with its component.

1. Counting. Map tasks send the shingles of a chunk of documents, sorted, delta
   coded and compressed, to the range partitions of shingle hashes; those tell each
   chunk how many shingles of each document occur in a second set. A set of n
   shingles needs ceil(threshold n) such shingles to have a partner at all; all
   other documents are done. A shingle frequent in a chunk is sent once.
2. Families. Under the first global order (rarest first, then by hash) two similar
   sets share a prefix shingle; documents joined by shared prefix shingles, in one
   star a shingle, form families. Similar sets are always in one family.
3. Verification. Families meet in one task each. Candidates of a document must share prefix
   shingles under each of ``ORDERS`` orders (rarest first, then random permutations that know nothing of frequencies);
   the filters are intersected, and what is left is verified by exact intersection
   unless both documents are connected already. Only links that connect are
   written, so a group of n copies gives n - 1 links.
4. Families over a bound are cut into blocks. First each block meets with itself and a few pivots of
   the family, which joins near copies of one text across blocks. Then only documents outside the
   family's largest component still need the other blocks, and meet all of them in chunks: of two
   documents in different components at least one is outside the largest.

Copies of a set are one node throughout. Nothing is capped: blocks, pivots and
prefixes lose no pair.

Nulls: null and blank texts have empty sets and link with nothing. Null ids are an
id of their own below all others. Repeated rows are rows of one component; a very long text is one set. Links have no ties; a component is named by its least id. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.graph import components
from tessera.llm.shingles import mix, shingle_sets
from tessera.shared import join_slim, map_arrow, materialize, parts_for

ORDERS = 3
#: Documents of a family of several blocks that every block meets at once.
PIVOTS = 8
NO_ID = -(1 << 63)
MULTI = 65535
_MIXED = "kind int, bucket int, chunk long, idx int, id long, n long, cls binary, shared long, blob binary, th long"
_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64())


def _needed(n, percent: int):
    """Least number of shingles that a set of n must share with a similar one."""
    return -(-percent * n // 100)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=[x.split()[0] for x in _MIXED.split(", ")])


def _by_size(rows: Iterator[tuple], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 60 + len(row[8] or b"")
        if size > most:
            yield _record(held)
            held, size = [], 0
    if held:
        yield _record(held)


def _coded(tokens: np.ndarray, docs: np.ndarray) -> bytes:
    """Sorted 48-bit tokens and the 16-bit indexes of their documents."""
    import zstandard

    steps = np.diff(tokens, prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + docs.astype("<u2").tobytes())


def _decoded(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // 8
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :6] = np.frombuffer(raw, np.uint8, 6 * n).reshape(6, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.frombuffer(raw, "<u2", n, 6 * n)


def _digest(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _chunks(bits: int, chunk_tokens: int):
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def flush(chunk: int, tokens: np.ndarray, docs: list) -> Iterator[tuple]:
        """tokens: 48 bits of a shingle and 16 of its document; sorted in place, and read bucket by bucket."""
        shared = np.zeros(len(docs), np.int64)
        tokens.sort()
        cuts = np.append(np.searchsorted(tokens, edges), len(tokens))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            both = tokens[cuts[b] : cuts[b + 1]]
            owner, both = (both & np.uint64(MULTI)).astype(np.uint16), both >> np.uint64(16)
            first = np.concatenate(([True], both[1:] != both[:-1]))
            many = ~first | np.concatenate((~first[1:], [False]))
            shared += np.bincount(owner[many], minlength=len(docs))
            yield 1, b, chunk, None, None, None, None, None, _coded(both[first], np.where(many, np.uint16(MULTI), owner)[first]), None
        for i, (doc, th, n, cls) in enumerate(docs):
            yield 0, (chunk + i) % (1 << bits), chunk, i, doc, n, cls, int(shared[i]), None, th

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            chunk, docs, seen, size = TaskContext.get().partitionId() << 24, [], set(), 0
            held = np.empty(chunk_tokens, np.uint64)
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    cut = batch.slice(at, 256)
                    for doc, th, tokens in zip(cut.column(0).to_pylist(), cut.column(1).to_pylist(), shingle_sets(cut.column(2).to_pylist()), strict=True):
                        cls, i = _digest(tokens), len(docs)
                        docs.append((doc, th, len(tokens), cls))
                        if cls is not None and cls not in seen:
                            seen.add(cls)
                            if size + len(tokens) > len(held):
                                held = np.concatenate([held[:size], np.empty(len(tokens), np.uint64)])
                            held[size : size + len(tokens)] = tokens & ~np.uint64(MULTI) | np.uint64(i)
                            size += len(tokens)
                        if size >= chunk_tokens or len(docs) >= MULTI - 1:
                            yield from flush(chunk, held[:size], docs)
                            chunk, docs, seen, size = chunk + 1, [], set(), 0
            if docs:
                yield from flush(chunk, held[:size], docs)

        yield from _by_size(rows())

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket: tells every chunk how often each of its documents has a shingle that occurs again."""

    def rows() -> Iterator[tuple]:
        for bucket, group in groupby(_rows(batches), key=lambda r: r[1]):
            chunks, tokens, docs = [], [], []
            for row in group:
                if row[0] == 0:
                    yield row
                    continue
                t, d = _decoded(row[8])
                chunks.append(row[2])
                tokens.append(t)
                docs.append(d)
            if len(tokens) < 2:
                continue
            where = np.repeat(np.arange(len(chunks)), [len(t) for t in tokens])
            t, d = np.concatenate(tokens), np.concatenate(docs)
            order = np.argsort(t, kind="stable")
            t, d, where = t[order], d[order], where[order]
            same = np.concatenate(([False], t[1:] == t[:-1]))
            many = (same | np.concatenate((same[1:], [False]))) & (d != MULTI)
            keys, counts = np.unique(where[many] * 65536 + d[many], return_counts=True)
            cuts = np.searchsorted(keys, np.arange(len(chunks) + 1) * 65536)
            for i, chunk in enumerate(chunks):
                k, c = keys[cuts[i] : cuts[i + 1]] % 65536, counts[cuts[i] : cuts[i + 1]]
                if len(k):
                    yield 1, bucket, chunk, None, None, None, None, None, k.astype("<u4").tobytes() + c.astype("<u4").tobytes(), None

    yield from _by_size(rows())


def _active(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, group in groupby(_rows(batches), key=lambda r: r[2]):
                docs, shared = [], np.zeros(65536, np.int64)
                for row in group:
                    if row[0] == 0:
                        docs.append(row)
                    else:
                        both = np.frombuffer(row[8], "<u4")
                        shared[both[: len(both) // 2]] += both[len(both) // 2 :]
                for row in docs:
                    n = row[5]
                    # kind is 1 for a document that may have a partner.
                    yield int(n > 0 and row[7] + shared[row[3]] >= _needed(n, percent)), None, None, None, row[4], n, row[6], None, None, row[9]

        yield from _by_size(rows())

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nid = TaskContext.get().partitionId() << 40
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            cut = batch.slice(at, 256)
            kept = [(c, s) for c, s in zip(cut.column(1).to_pylist(), shingle_sets(cut.column(0).to_pylist()), strict=True) if _digest(s) == c]
            if kept:
                flat = pa.array(np.concatenate([s for _, s in kept]).view(np.int64))
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(s) for _, s in kept]))), pa.int32())
                yield pa.record_batch([pa.array(range(nid, nid + len(kept)), pa.int64()), pa.array([c for c, _ in kept], pa.binary()), pa.array([len(s) for _, s in kept], pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["nid", "cls", "n", "tokens"])
                nid += len(kept)


class _Index:
    """Postings of the documents of a group by local shingle number."""

    def __init__(self, docs: np.ndarray, tokens: np.ndarray, width: int):
        order = np.argsort(tokens, kind="stable")
        self.docs, self.cuts = docs[order], np.searchsorted(tokens[order], np.arange(width + 1))

    def of(self, tokens: np.ndarray) -> np.ndarray:
        parts = [self.docs[self.cuts[t] : self.cuts[t + 1]] for t in tokens.tolist()]
        return np.concatenate(parts) if parts else self.docs[:0]


def link_group(sets: list[np.ndarray], side: np.ndarray, percent: int, orders: int = ORDERS, labels: np.ndarray | None = None, counts: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the similar sets of a group: a spanning forest. Where side
    has two values only sets of different sides are compared. Sets with equal labels are connected already.
    counts, if given, is increased by the candidates left after each order."""
    m, n = len(sets), np.array([len(s) for s in sets])
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), n)
    freq = np.bincount(flat)
    keep = freq[flat] > 1
    unique = n - np.bincount(owner[keep], minlength=m)
    flat, owner = flat[keep], owner[keep]
    width = len(vocabulary)
    own = [flat[a:b] for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(owner, np.arange(m + 1))), strict=True)]
    take = np.maximum(0, n - _needed(n, percent) + 1 - unique)
    filters = []
    for k in range(orders):
        tie = mix(vocabulary + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = np.empty(width, np.int64)
        rank[np.lexsort((tie, freq)) if k == 0 else np.argsort(tie, kind="stable")] = np.arange(width)
        prefix = [o[np.argpartition(rank[o], t - 1)[:t]] if 0 < t < len(o) else o[: t or 0] for o, t in zip(own, take.tolist(), strict=True)]
        docs = np.repeat(np.arange(m), [len(p) for p in prefix])
        filters.append((prefix, _Index(docs, np.concatenate(prefix), width)))
    full, two = _Index(owner, flat, width), side.min() != side.max()
    label, links = np.arange(m) if labels is None else np.unique(labels, return_inverse=True)[1], []
    for x in range(m):
        if not len(filters[0][0][x]):
            continue
        found = (label != label[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
        found[: x + 1] = False
        if two:
            found &= side != side[x]
        for k, (prefix, index) in enumerate(filters):
            hit = np.zeros(m, bool)
            hit[index.of(prefix[x])] = True
            found &= hit
            if counts is not None:
                counts[k] += found.sum()
            if not found.any():
                break
        left = np.flatnonzero(found)
        if len(left) > 24:
            inter = np.bincount(full.of(own[x]), minlength=m)[left]
        else:
            inter = np.array([len(np.intersect1d(own[x], own[y], assume_unique=True)) for y in left.tolist()], np.int64)
        good = left[100 * inter >= percent * (n[x] + n[left] - inter)]
        for y in good.tolist():
            if label[y] != label[x]:
                links.append((x, y))
                label[label == label[y]] = label[x]
    return links


def _linked(percent: int, across: bool):
    """Rows family, i, j, nid, side, label, tokens, sorted by the first three; across: only sides 0 and 1 are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                tokens = batch.column(6)
                for i, head in enumerate(zip(*(batch.column(j).to_pylist() for j in range(6)), strict=True)):
                    yield (*head, tokens[i].values.to_numpy().view(np.uint64))

        a, b = [], []
        for _, group in groupby(rows(), key=lambda r: r[:3]):
            ids, sides, labels, sets = zip(*((r[3], r[4], r[5], r[6]) for r in group), strict=True)
            sides = np.array(sides)
            if len(ids) > 1 and not (across and sides.min() == sides.max()):
                for x, y in link_group(list(sets), sides, percent, labels=np.array(labels)):
                    a.append(ids[x])
                    b.append(ids[y])
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def jaccard_components(docs: DataFrame, percent: int = 80, chunk_tokens: int = 1_500_000, block_docs: int = 512, block_tokens: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    # Buckets of about a million shingles; a blob of a chunk and bucket keeps at least some fifty of them.
    bits = min(16, max(4, parts_for(docs, 4 << 20).bit_length()))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(docs, 16 << 20))
    mixed = slim.transform(map_arrow, _chunks(bits, chunk_tokens), _MIXED).repartition(n, "bucket").sortWithinPartitions("bucket").transform(map_arrow, _common, _MIXED)
    base = mixed.repartition(n, "chunk").sortWithinPartitions("chunk").transform(map_arrow, _active(percent), _MIXED)
    base = materialize(base.select("id", "th", "n", "cls", (F.col("kind") == 1).alias("active")), "base")

    reps = materialize(base.filter("active").groupBy("cls").agg(F.min(F.struct("id", "th")).alias("r")).select("r.id", "r.th", "cls"), "reps")
    texts = join_slim(slim, reps, ["id", "th"], "inner").select("id", "th", "text", "cls")
    repeated = join_slim(base.select("id", "th"), reps, ["id", "th"], "inner").groupBy("id", "th").count().filter("count > 1")
    texts = (texts if repeated.isEmpty() else texts.dropDuplicates(["id", "th"])).select("text", "cls")
    sets = materialize(texts.transform(map_arrow, _sets, "nid long, cls binary, n long, tokens array<long>"), "sets")

    postings = sets.select("nid", "n", F.explode("tokens").alias("token"))
    often = postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    common = postings.join(often, "token")
    by_doc = Window.partitionBy("nid")
    needed = F.ceil(F.lit(percent) * F.col("n") / 100)
    prefix = common.withColumn("rank", F.row_number().over(by_doc.orderBy("df", "token"))).withColumn("common", F.count("*").over(by_doc))
    prefix = materialize(prefix.filter(F.col("rank") <= F.col("common") - needed + 1).select("nid", "token"), "prefix")
    stars = prefix.groupBy("token").agg(F.min("nid").alias("b"))
    edges = prefix.join(stars, "token").filter("nid <> b").select(F.col("nid").alias("a"), "b").distinct()
    family = components(materialize(edges, "stars")).select(F.col("node").alias("nid"), F.col("label").alias("family"))

    members = materialize(sets.select("nid", "n").join(family, "nid"), "families")
    number = lambda: F.ceil(F.greatest(F.count("*") / block_docs, F.sum("n") / block_tokens)).cast("int")
    pivots = F.array_distinct(F.array(*[F.min(F.struct(F.xxhash64(F.lit(j), "nid").alias("h"), F.col("nid").alias("nid"))).getField("nid") for j in range(PIVOTS)]))
    sizes = materialize(members.groupBy("family").agg(number().alias("blocks"), pivots.alias("pivots")), "sizes")
    large = sizes.filter("blocks > 1")
    members = members.join(sizes.select("family", "blocks"), "family").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    members = materialize(members, "members")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    guests = large.select("family", every.alias("i"), "pivots").select("family", "i", F.explode("pivots").alias("nid"))
    first = members.select("family", F.col("block").alias("i"), "nid").unionByName(guests).distinct()
    first = first.select("family", "i", F.lit(0).alias("j"), "nid", F.lit(0).alias("side"), F.col("nid").alias("label"))

    def linked(tasks: DataFrame, across: bool) -> DataFrame:
        placed = tasks.join(sets.select("nid", "tokens"), "nid").repartition(n, "family", "i", "j").sortWithinPartitions("family", "i", "j")
        rows = placed.select("family", "i", "j", "nid", "side", "label", "tokens").transform(map_arrow, _linked(percent, across), "a long, b long")
        return materialize(rows, "links")

    links = linked(first, False)
    if not large.isEmpty():
        near = components(links).withColumnRenamed("node", "nid")
        big = members.filter("blocks > 1").join(near, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
        big = materialize(big, "large")
        most = big.groupBy("family", "label").agg(F.count("*").alias("k")).groupBy("family").agg(F.max_by("label", "k").alias("giant"))
        loose = materialize(big.join(most, "family").filter("label <> giant").drop("giant"), "loose")
        chunks = loose.groupBy("family").agg(number().alias("chunks"))
        own = big.join(chunks, "family").select("family", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), "nid", F.lit(0).alias("side"), "label")
        asked = loose.join(chunks, "family").withColumn("i", every).filter("i <> block")
        asked = asked.select("family", "i", F.pmod(F.xxhash64(F.lit(1), "nid"), F.col("chunks")).cast("int").alias("j"), "nid", F.lit(1).alias("side"), "label")
        links = links.unionByName(linked(own.unionByName(asked), True))

    labels = components(links)
    groups = base.filter("n > 0").groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    nodes = sets.select("nid", "cls").join(labels.select(F.col("node").alias("nid"), "label"), "nid").select("cls", "label").dropDuplicates(["cls"])
    named = groups.join(nodes, "cls", "left").filter("copies > 1 or label is not null")
    named = materialize(named.select("cls", "least", "label"), "named")
    lowest = named.filter("label is not null").groupBy("label").agg(F.min("least").alias("lowest"))
    named = named.join(lowest, "label", "left").select("cls", F.coalesce("lowest", "least").alias("component"))
    out = base.join(named, "cls", "left").withColumn("component", F.coalesce("component", "id"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"))
