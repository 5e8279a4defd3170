"""Exact deduplication with Patricia-trie owners.

Texts are compared after deleting the six ASCII white-space characters. Map tasks
insert the full byte strings into a compressed radix trie and send one row per
distinct text on to the partition of its (length, content hash); there a second
trie joins the rows of all tasks. A terminal node stores the text's owner (most
code points in the original text, then smallest doc_id, then first row), the
number of rows and nothing else, so that a group of any size costs one node. When
a trie holds more bytes than its bound, its largest subtree (or longest leaf) moves to an anonymous
scratch file of the task and is finished after the others; a retried task begins it anew. Map tasks
empty their trie instead.

A second, slim row per document (no text) goes by (length, row number) to any partition, whatever
group it is in. Groups of several rows are joined to it last: where they are few they are
broadcast, else those groups with a two-thousandth of all rows or more, and only the rest shuffles.

Nulls: a null text is empty; all empty texts are equal. Null doc_ids are kept as
they are and rank last. Ties (equal code points and doc_id) go to one of the rows, which one is
not defined. Repeated rows count as copies; exactly one of them stays. A text of any length is one key.
Other columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import join_hot, map_arrow, materialize, parts_for

WHITE = b" \t\n\v\f\r"
LAST_ID = (1 << 63) - 1


class Patricia:
    """Compressed radix trie over byte strings. Values are tuples, joined by
    ``merge``. Past ``limit`` bytes of labels the largest subtree below the first
    branching moves to a scratch file, and so does what is inserted there later."""

    class _Node:
        __slots__ = ("kids", "label", "spill", "value")

        def __init__(self, label: bytes, value: tuple | None = None):
            self.label, self.value, self.kids, self.spill = label, value, {}, None

    def __init__(self, merge, limit: int = 64 << 20):
        self.merge, self.limit = merge, limit
        self.root, self.held = self._Node(b""), 0

    def insert(self, key: bytes, value: tuple) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key[at:], value), node.spill)
                return
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = self._Node(key[at:], value)
                self.held += len(key) - at + 200
                break
            if key.startswith(kid.label, at):
                node, at = kid, at + len(kid.label)
                continue
            same = self._common(kid.label, key, at)
            upper = self._Node(kid.label[:same])
            node.kids[key[at]], kid.label = upper, kid.label[same:]
            upper.kids[kid.label[0]] = kid
            self.held += 200
            node, at = upper, at + same
        if self.held > self.limit:
            self._spill()

    @staticmethod
    def _common(label: bytes, key: bytes, at: int) -> int:
        low, high = 0, min(len(label), len(key) - at)
        while low < high:
            mid = (low + high + 1) // 2
            if label[low:mid] == key[at + low : at + mid]:
                low = mid
            else:
                high = mid - 1
        return low

    @staticmethod
    def _nodes(node, prefix: bytes) -> Iterator[tuple]:
        """Nodes at and below one, with the strings from its end to theirs after prefix."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            yield node, prefix
            stack += [(kid, prefix + kid.label) for kid in node.kids.values()]

    def _spill(self) -> None:
        top = self.root
        while len(top.kids) == 1 and top.value is None:
            top = next(iter(top.kids.values()))
        sizes = {k: sum(len(n.label) + 200 for n, _ in self._nodes(kid, b"")) for k, kid in top.kids.items() if kid.kids or kid.spill is None and len(kid.label) > 1}
        if not sizes:
            return  # every branch is one byte long and in a file already: 256 nodes at most
        kid = top.kids[max(sizes, key=sizes.get)]
        # The branch keeps the first byte of its label; the rest and all below it go to the file.
        file, rest_of = tempfile.TemporaryFile(), kid.label[1:]
        for node, rest in self._nodes(kid, rest_of):
            if node.value is not None:
                pickle.dump((rest, node.value), file)
            if node.spill is not None:
                for key, value in self._entries(node.spill):
                    pickle.dump((rest + key, value), file)
        kid.label, kid.value, kid.kids, kid.spill = kid.label[:1], None, {}, file
        self.held -= max(sizes.values()) - 201

    @staticmethod
    def _entries(file) -> Iterator[tuple[bytes, tuple]]:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                file.close()
                return

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """Every key with its value, those of spilled subtrees after the rest, one subtree at a time."""
        spilled = []
        for node, key in self._nodes(self.root, b""):
            if node.value is not None:
                yield key, node.value
            if node.spill is not None:
                spilled.append((key, node.spill))
        self.root, self.held = self._Node(b""), 0
        for prefix, file in spilled:
            part = Patricia(self.merge, self.limit)
            for key, value in self._entries(file):
                part.insert(key, value)
            yield from ((prefix + key, value) for key, value in part.items())


def _merge(a: tuple, b: tuple) -> tuple:
    """Values: (-code points, doc_id, uid, rows)."""
    return (*min(a[:3], b[:3]), a[3] + b[3])


_SCHEMA = "kind int, route long, n_bytes long, sha binary, body binary, doc_id long, uid long, chars long, copies long"
_ARROW = pa.schema([("kind", pa.int32()), ("route", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.binary()), ("body", pa.binary()), ("doc_id", pa.int64()), ("uid", pa.int64()), ("chars", pa.int64()), ("copies", pa.int64())])


def _batches(rows: Iterator[tuple], most_rows: int = 20_000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4] or b"")
        if len(held) >= most_rows or size >= most_bytes:
            yield _record(held)
            held, size = [], 0
    if held:
        yield _record(held)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def _texts(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, trie = TaskContext.get().partitionId() << 40, Patricia(_merge, 1 << 60)

        def flush() -> Iterator[tuple]:
            for body, (chars, doc_id, owner, copies) in trie.items():
                sha = hashlib.sha256(body).digest()
                yield 1, int.from_bytes(sha[:8], "big", signed=True), len(body), sha, body, None if doc_id == LAST_ID else doc_id, owner, -chars, copies

        def rows() -> Iterator[tuple]:
            nonlocal uid, trie
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = text.as_py() or ""
                    body = raw.encode("utf-8", "surrogatepass").translate(None, WHITE)
                    sha = hashlib.sha256(body).digest()
                    yield 0, uid, len(body), sha, None, doc_id, uid, None, None
                    trie.insert(body, (-len(raw), LAST_ID if doc_id is None else doc_id, uid, 1))
                    uid += 1
                    if trie.held > held:
                        yield from flush()
                        trie = Patricia(_merge, 1 << 60)
            yield from flush()

        yield from _batches(rows())

    return run


def _owners(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia(_merge, limit)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for kind, _, n_bytes, sha, body, doc_id, uid, chars, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if kind == 0:
                        yield 0, None, n_bytes, sha, None, doc_id, uid, None, None
                    else:
                        trie.insert(body, (-chars, LAST_ID if doc_id is None else doc_id, uid, copies))
            for body, (chars, doc_id, uid, copies) in trie.items():
                if copies > 1:
                    yield 1, None, len(body), hashlib.sha256(body).digest(), None, None if doc_id == LAST_ID else doc_id, uid, -chars, copies

        yield from _batches(rows())

    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", map_bytes: int = 48 << 20, trie_bytes: int = 128 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_for(docs, 16 << 20))
    mixed = slim.transform(map_arrow, _texts(map_bytes), _SCHEMA).repartition(n, "n_bytes", "route").transform(map_arrow, _owners(trie_bytes), _SCHEMA)
    table = materialize(mixed.drop("route", "body"), "exact", ["kind"])
    rows = table.filter("kind = 0").select("doc_id", "uid", "n_bytes", "sha")
    groups = table.filter("kind = 1").select("n_bytes", "sha", F.col("doc_id").alias("owner"), F.col("uid").alias("owner_uid"), "copies")
    joined = join_hot(rows, groups.withColumn("rows", F.col("copies")), ["n_bytes", "sha"], "rows", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("owner")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("uid") == F.col("owner_uid"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
