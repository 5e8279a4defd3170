"""Packing by concatenating and cutting.

Documents become token ids once, in map tasks, and are written to the shared
folder with their task and the number of ids before them in it. The totals per
task are summed to give each task a base (prefix sums over partition totals), so
every document knows its global offset, and the stream is cut into windows of
fixed length where the multiples of the window fall; pieces at a boundary carry
their sequence and offset like all others. No ids are shuffled. Only the last
sequence can be short.

Fast path: a text whose characters are all below U+0250 and that names none of the file's
special tokens goes to a BPE engine loaded with the vocabulary of the same tokenizer file; all
others to the file's own library, called as it is, so that a special token's string in
a text is that token. Both give the same ids; tests compare them over every such character and over whole tables.

Nulls: a null text is empty and has one id, the end mark; null ids stay null. Repeated rows are packed
as often as they occur. Documents are laid out in the order of the input, so no ties arise. A text of any
length is encoded whole and cut into as many pieces as it needs. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import map_arrow, materialize, process_cache

_TOKENS = "doc_id long, part long, before long, n long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
PLAIN = re.compile("[^\x00-ɏ]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None):
    """A function from a list of texts to a list of id lists; loaded once per process, from where this machine has the file."""
    path = path or default_tokenizer()
    loaded = process_cache("encoders")
    if path not in loaded:
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        # Byte-level vocabularies write bytes as printable characters: those that print stand for themselves, the rest from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"] for t in file.get("added_tokens", ())}
        hard = re.compile("|".join([PLAIN.pattern, *map(re.escape, sorted(special))]))
        ranks = {bytes(byte_of[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
        del file
        quick = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        kept: list = []

        def exact(text: str) -> list[int]:
            if not kept:  # loaded only where a text needs it: it takes as much memory again
                kept.append(Tokenizer.from_file(path))
            return kept[0].encode(text, add_special_tokens=False).ids

        def run(texts: list[str]) -> list[list[int]]:
            return [exact(t) if hard.search(t) else quick.encode_ordinary(t) for t in texts]

        loaded[path] = run
    return loaded[path]


def _tokens(path: str | None, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                cut = batch.slice(at, 512)
                rows = []
                for doc_id, ids in zip(cut.column(0).to_pylist(), encode([t or "" for t in cut.column(1).to_pylist()]), strict=True):
                    ids.append(end)
                    rows.append((doc_id, part, before, len(ids), np.array(ids, "<u4").tobytes()))
                    before += len(ids)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "part", "before", "n", "ids"])

    return run


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                out = []
                for doc_id, first, n, ids, total in zip(*(c.to_pylist() for c in batch.slice(start, 512).columns), strict=True):
                    at = 0
                    while at < n:
                        sequence, offset = divmod(first + at, window)
                        length = min(window - offset, n - at)
                        filled = min(window, total - sequence * window)
                        padded = filled if filled & (filled - 1) == 0 else window
                        out.append((doc_id, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n, sequence, offset, padded))
                        at += length
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return run


def pack(docs: DataFrame, window: int = 1024, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    padded (the sequence's length after padding: the window, or its own if a power of two)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = materialize(slim.transform(map_arrow, _tokens(tokenizer, end_id), _TOKENS), "tokens")
    # One total per map task: as many rows as partitions.
    totals = sorted(tokens.groupBy("part").agg(F.sum("n").alias("n")).collect())
    bases, total = [], 0
    for part, n in totals:
        bases.append((part, total))
        total += n
    base = spark.createDataFrame(bases, "part long, base long")
    placed = tokens.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "n", "ids", F.lit(total).cast("long").alias("total"))
    return placed.transform(map_arrow, _pieces(window), _PIECES)
