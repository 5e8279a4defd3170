import collections
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.dedup_exact import Patricia, _merge, exact_duplicates
from tessera.llm.graph import components, least_labels
from tessera.llm.ngram_join import jaccard_components, link_group
from tessera.llm.suffix_dedup import merged, repeated_spans
from tessera.shared import materialize


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40), st.sampled_from([1, 300, 1 << 20]))
def test_trie_keeps_least_values_with_any_spill(keys, limit):
    trie, want = Patricia(_merge, limit), {}
    for i, k in enumerate(keys):
        value = (0, i, i, 1)
        trie.insert(k, value)
        want[k] = _merge(want[k], value) if k in want else value
    assert dict(trie.items()) == want


def _exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append(r)
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id))
        out += [(r.doc_id, best.doc_id, len(members), hashlib.sha256(body.encode()).hexdigest()) for r in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("fixture", ["awkward", "small", "no_docs"])
def test_exact(fixture, request):
    docs = request.getfixturevalue(fixture)
    want, groups = _exact(docs.collect())
    got = exact_duplicates(docs, map_bytes=4000, trie_bytes=3000).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    assert sum(r.kept for r in got) == groups


def _components(rows, percent=80):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    key = lambda i: (rows[i].doc_id is not None, rows[i].doc_id or 0)
    least = {c: min((i for i in range(len(rows)) if label[i] == c), key=key) for c in set(label)}
    return sorted([(rows[i].doc_id, len(sets[i]), rows[least[label[i]]].doc_id) for i in range(len(rows))], key=str)


@pytest.mark.parametrize("fixture", ["awkward", "small", "no_docs"])
@pytest.mark.parametrize("block", [4, 1024])
def test_near(fixture, block, request):
    docs = request.getfixturevalue(fixture)
    got = jaccard_components(docs, chunk_tokens=500, block_docs=block).collect()
    assert sorted([tuple(r) for r in got], key=str) == _components(docs.collect())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), min_size=2, max_size=25))
def test_orders_lose_no_link(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    links = link_group(arrays, np.zeros(len(sets), int), 80)
    root = list(range(len(sets)))
    for a, b in links:
        x, y = root[a], root[b]
        root = [x if r == y else r for r in root]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                assert root[i] == root[j]


def _covered(rows, length):
    counts = collections.Counter()
    bodies = [(r.text or "").encode() for r in rows]
    for b in bodies:
        counts.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, bodies, strict=True):
        gone = merged([(i, i + length) for i in range(len(b) - length + 1) if counts[b[i : i + length]] > 1])
        cover = [any(x <= i < y for x, y in gone) for i in range(len(b))]
        out.append((r.doc_id, len(b), sum(cover), len(gone), hashlib.sha256(bytes(c for c, g in zip(b, cover, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def _covered_words(rows, length):
    bodies = [re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in rows]
    counts = collections.Counter(tuple(b[i : i + length]) for b in bodies for i in range(len(b) - length + 1))
    covered = lambda b: {j for i in range(len(b) - length + 1) if counts[tuple(b[i : i + length])] > 1 for j in range(i, i + length)}
    return sorted([(r.doc_id, len(covered(b))) for r, b in zip(rows, bodies, strict=True)], key=str)


@pytest.mark.parametrize("fixture", ["awkward", "small", "no_docs"])
@pytest.mark.parametrize("slices", [1, 2000])
def test_spans(fixture, slices, request):
    docs = request.getfixturevalue(fixture).filter("doc_id is null or doc_id <> 20")
    length = 120
    got = repeated_spans(docs, length=length, words=12, slice_classes=slices).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == _covered(docs.collect(), length)
    assert sorted([(r.doc_id, r.repeated_words) for r in got], key=str) == _covered_words(docs.collect(), 12)


def test_spans_over_pieces(spark, monkeypatch):
    """The production length of 400 bytes, texts longer than a piece, and a hot gram."""
    import random

    from tessera import shared
    from tessera.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 5)
    rng = random.Random(7)
    some = lambda n: "".join(rng.choice("abcdefg ") for _ in range(n))
    shared_part, hot = some(1500), some(399)
    texts = [some(2500) + shared_part + some(700), shared_part[300:] + some(100), some(900)] + [some(rng.randrange(300)) + hot + some(rng.randrange(300)) for _ in range(30)] + [hot + "q" + some(50)] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeated_spans(docs, slice_classes=7).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == _covered(docs.collect(), 400)
    assert sorted([(r.doc_id, r.repeated_words) for r in got], key=str) == _covered_words(docs.collect(), 50)


def test_a_hash_collision_is_no_repeat():
    from tessera.llm.suffix_dedup import _neighbours_agree

    units = np.frombuffer(b"abcabcabdabc", np.uint8)
    assert _neighbours_agree(units, np.array([0, 3, 6, 9]), 3, rows=2).tolist() == [True, False, False]


@pytest.mark.parametrize("block", [3, 8, 1000])
def test_large_families(spark, block):
    """Chains, whose ends are far apart, and stars of near copies, over several blocks."""
    import random

    rng = random.Random(block)
    words = [f"v{i}" for i in range(900)]
    docs = [" ".join(words[i * 6 : i * 6 + 100]) for i in range(40)]
    base = [f"s{i}" for i in range(120)]
    for _ in range(40):
        copy = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3])):
            copy[at] = f"e{rng.random()}"
        docs.append(" ".join(copy))
    rng.shuffle(docs)
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = jaccard_components(table, chunk_tokens=3000, block_docs=block).collect()
    assert sorted([tuple(r) for r in got], key=str) == _components(table.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 30), st.integers(-9, 30)), max_size=40))
def test_least_labels(edges):
    nodes, labels = least_labels(*(np.array([e[i] for e in edges], np.int64) for i in (0, 1)))
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((root[a], root[b]))
        root = {k: x if r == y else r for k, r in root.items()}
    assert dict(zip(nodes.tolist(), labels.tolist(), strict=True)) == root


def test_components_of_few_edges_need_few_jobs(spark):
    """A path has the most rounds. Both ways give the same labels, and few edges are joined without a round of jobs."""
    path = materialize(spark.range(300).selectExpr("id a", "id + 1 b"), "path")
    got = {}
    for most in (1000, 10):
        spark.sparkContext.setJobGroup(f"components {most}", "")
        got[most] = sorted(map(tuple, components(path, most).collect()))
        spark.sparkContext.setJobGroup("", "")
    assert got[1000] == got[10] == [(i, 0) for i in range(301)]
    jobs = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components {most}")) for most in (1000, 10)]
    assert jobs[0] <= 6 < jobs[1]


def test_chunks_hold_their_shingles_once(monkeypatch):
    """A full chunk is sorted in place: less than twice its shingles are held at once."""
    import tracemalloc

    import pyarrow as pa

    from tessera.llm import ngram_join

    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, (1 << 64) - 1, 1000, dtype=np.uint64)) for _ in range(1000)]
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda texts: (sets[int(t)].copy() for t in texts))
    monkeypatch.setattr(ngram_join, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 0)}))
    rows = pa.record_batch([pa.array(range(1000)), pa.array(range(1000)), pa.array(list(map(str, range(1000))))], names=["id", "th", "text"])
    tracemalloc.start()
    seen = sum(batch.num_rows for batch in ngram_join._chunks(8, 1_000_000)(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 1000 + 256 and peak < 2.5 * 8_000_000
