"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

import collections
import re

import corpus_pipeline as CP
import numpy as np
import pytest

from tests.llm.test_dedup import _components


@pytest.fixture
def corpus(spark, tmp_path):
    rng = np.random.default_rng(4)
    words = np.array([f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)])
    texts = [" ".join(rng.choice(words, rng.choice([4, 30, 120]))) for _ in range(240)]
    for i in range(0, 240, 6):
        texts[i] += " nasty vile trash"
    for i in range(1, 40, 3):
        texts.append(texts[i].replace(" ", "  "))
        near = texts[i + 40].split()
        near[0] = "other"
        texts.append(" ".join(near))
    texts += ["", None, " "]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, corpus):
    docs, kept = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for k, (_, stage) in enumerate(CP.STAGES):
        columns = docs.columns
        out = stage(spark, docs, corpus)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{corpus}/stage{k}")
        docs = spark.read.parquet(f"{corpus}/stage{k}")
        kept.append(docs.collect())
    start = spark.read.parquet(f"{corpus}/documents.parquet").collect()
    toxic = {r.doc_id for r in start if "nasty" in (r.text or "")}
    assert {r.doc_id for r in kept[0]} == {r.doc_id for r in start} - toxic
    groups = collections.defaultdict(list)
    for r in kept[0]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in kept[1]) == sorted(min(g)[1] for g in groups.values())
    assert sorted(r.doc_id for r in kept[2]) == sorted(d for d, _, c in _components(kept[1]) if d == c)
    copies = collections.Counter(r.doc_id for r in kept[3])
    assert set(copies) <= {r.doc_id for r in kept[2]} and max(copies.values()) <= 2
    size = {r.doc_id: len((r.text or "").split()) for r in kept[2]}
    total = sum(size.values())
    assert abs(sum(copies[d] * n for d, n in size.items()) - 1.5 * total) < 0.1 * total
    texts = {r.doc_id: r.text for r in start}
    assert all(r.text == texts[r.doc_id] for r in kept[3])
    tokens = collections.Counter()
    for r in kept[4]:
        tokens[r.doc_id] += r.length
    per_doc = {r.doc_id: r.doc_tokens for r in kept[4]}
    assert tokens == {d: n * per_doc[d] for d, n in copies.items()}
    place = collections.defaultdict(int)
    for r in kept[4]:
        place[r.sequence_id] += r.length
    assert all(n == 1024 for s, n in place.items() if s != max(place))


def test_run_is_the_stages(spark, corpus):
    assert CP.run(spark, corpus).select("doc_id", "length").count() > 0


def test_repeated_and_missing_ids(spark, corpus):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text here"), (None, "no id"), (None, "a b c d e f "), (2, None)]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in CP.STAGES[1:4]:
        docs = stage(spark, docs, corpus)
    assert {r.doc_id for r in docs.collect()} <= {1, 2, None}
    empty = docs.filter("false")
    for _, stage in CP.STAGES:
        assert stage(spark, empty, corpus).collect() == []
