import collections
import gzip
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from tessera.llm import fingerprints as FP
from tessera.llm import language_id as LI
from tessera.llm import licenses, mixing, packing, toxicity, warc
from tessera.shared import new_path


def _terms(text):
    return collections.Counter(re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\x0c\r")))


def test_fingerprints_estimate_generalised_jaccard(small):
    rows = {r.doc_id: r.text for r in small.collect()}
    got = FP.edited_likeness(small, rows_each=7).collect()
    assert len(got) == len(rows)
    ids = sorted(rows, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    near = lambda a, b: sum((_terms(a) & _terms(b)).values()) / sum((_terms(a) | _terms(b)).values())
    errors = []
    for r in got:
        text = rows[r.doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[after[r.doc_id]][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [r.near_edited - near(text, edited), r.near_next - near(text, rows[after[r.doc_id]])]
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.09
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[rows[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_of_awkward_rows(awkward, no_docs):
    got = FP.edited_likeness(awkward).collect()
    assert len(got) == awkward.count() and all(0 <= r.near_next <= 1 for r in got)
    assert FP.edited_likeness(no_docs).collect() == []
    assert FP.fingerprints(awkward).count() == awkward.select("doc_id", "text").fillna("", ["text"]).distinct().count()


def test_warc_round_trip(spark):
    html = "<p>" + "long page " * 30
    rows = [(1, "http://a", html), (2, "http://b", html), (0, None, html), (3, "u", "short"), (4, "u", "short"), (5, None, None), (None, "x\ny", "z" * 200), (2, "http://b", html), (6, "big", "q" * (17 << 20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as owner", "2 as digest", "'x' as kind", "'y' as archive", "'z' as data")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "") for p, _, h in rows if p == r.page_id)
        want = ("revisit", 0) if r.page_id in (1, 2) else ("response", None)
        assert (r.payload_bytes, r.payload_digest, (r.record_type, r.refers_to)) == (len(body), hashlib.sha256(body.encode()).hexdigest(), want)
    assert warc.round_trip(pages.filter("false")).collect() == []


def test_members_and_index_agree(spark):
    raw, out = new_path(spark, "raw"), new_path(spark, "out")
    pages = spark.createDataFrame([(i, f"http://p/{i}", "text " * i) for i in range(40)], "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, raw, archive_bytes=4000)
    warc.normalise(spark, raw, out)
    files = {r.path.split("/archive=")[1].split("/")[0]: bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out).filter("path like '%kind=warc%'").collect()}
    index = warc.read_index(spark, out).collect()
    assert len(index) == 40
    for r in index:
        record = zlib.decompressobj(31).decompress(files[r.archive][r.offset : r.offset + r.length])
        assert warc.parse(record)[1] == r.record_id
    assert sum(gzip.decompress(f).count(b"WARC/1.1\r\n") for f in files.values()) == 40


def test_records_are_cut_in_steps_and_errors():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % n + b"x" * n for n in (0, 5, 3000)]
    whole = b"".join(r + warc.END for r in records)
    for step in (1, 7, 64, 1 << 20):
        cutter = warc.Cutter()
        assert [r for i in range(0, len(whole), step) for r in cutter.feed(whole[i : i + step])] == records
        cutter.end()
    cutter = warc.Cutter()
    assert list(cutter.feed(whole[:-12])) == records[:2]
    for bad in (b"WARC/1.1\r\nX: 1\r\n\r\nabc", b"WARC/1.1\r\nContent-Length: 1\r\n\r\nabcdef"):
        with pytest.raises(ValueError):
            list(warc.Cutter().feed(bad))
    with pytest.raises(ValueError):
        cutter.end()


def test_foreign_archives(spark, tmp_path):
    """Files of other crawlers: one stream or several, any bytes, more members than one archive may hold; a truncated stream raises."""
    rng = np.random.default_rng(1)
    bodies = [b"", b"\xff\x00\n\r\nabc", bytes(rng.integers(0, 256, 200_000, np.uint8)), b"\n" * 5000, "日本".encode() * 700]
    records = [b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(b)) + b for i, b in enumerate(bodies)]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(gzip.compress(b"".join(r + warc.END for r in records)))
    (folder / "b.warc.gz").write_bytes(b"".join(gzip.compress(r + warc.END) for r in records))
    out = str(tmp_path / "out")
    warc.normalise(spark, str(folder), out, most_bytes=100_000)
    files = {r.path.split("/archive=")[1].split("/")[0]: bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out).filter("path like '%kind=warc%'").collect()}
    for name in "ab":
        assert b"".join(gzip.decompress(files[f]) for f in sorted(files, key=lambda f: ("-" in f, f)) if f[0] == name) == b"".join(r + warc.END for r in records)
    assert sorted(files) == ["a-00001.warc.gz", "a.warc.gz", "b-00001.warc.gz", "b.warc.gz"]
    for r in warc.read_index(spark, out).collect():
        assert zlib.decompressobj(31).decompress(files[r.archive][r.offset : r.offset + r.length]).split(b"WARC-Record-ID: ")[1].startswith(r.record_id.encode())
    assert warc.read_archives(spark, out).count() == 10
    (folder / "c.warc.gz").write_bytes((folder / "a.warc.gz").read_bytes()[:-5000])
    with pytest.raises(Exception):  # noqa: B017
        warc.normalise(spark, str(folder), str(tmp_path / "bad"))


def test_language_spans_and_held_out(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog of this house", "en"), ("der hund und die katze in dem haus", "de"), ("кошка и собака в доме", "ru")] * 30)]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "text", None)], "doc_id long, text string, lang string")
    model = LI.train(docs)
    assert model["langs"] == ["de", "en", "ru"]
    got = LI.spans("the cat and the dog, der hund und die katze, собака", model)
    assert [s[2] for s in got] == ["en", "de", "ru"]
    ask = spark.createDataFrame([(1, "the house and the dog"), (2, None), (3, "12 34 !"), (4, "die katze und der hund"), (5, ""), (5, "")], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in LI.identify(ask, model).collect()}
    assert found == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("de", 1.0), 5: ("und", 0.0)}
    nothing = LI.train(docs.filter("false"))
    assert {r.lang_pred for r in LI.identify(ask, nothing).collect()} == {"und"}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        scores = rng.normal(size=(n, 3))
        best = max(itertools.product(range(3), repeat=n), key=lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:], strict=False)))
        assert LI.viterbi(scores, np.array([n]), 0.7).tolist() == list(best)
    lengths = np.array([2, 0, 4, 1])
    scores = rng.normal(size=(7, 3))
    parts = [LI.viterbi(scores[a:b], np.array([b - a]), 0.7).tolist() for a, b in ((0, 2), (2, 6), (6, 7))]
    assert LI.viterbi(scores, lengths, 0.7).tolist() == sum(parts, [])


def test_licenses(spark):
    mit = licenses.LICENSES["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 Someone\n" + mit.upper().replace(" OR ", " OR\n")), (3, mit + " And more."), (4, None), (5, ""), (6, licenses.LICENSES["ISC"].replace("license", "licence")), (7, "Copyright only"), (1, mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as license_id", "'y' as body")
    got = sorted((r.doc_id, r.license_id) for r in licenses.scan(docs).collect())
    assert got == [(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, "ISC"), (7, None)]
    assert licenses.scan(docs.filter("false")).collect() == []
    own = spark.createDataFrame([("b", "My Programme"), ("a", "my program!"), (None, "x"), ("c", None)], "license_id string, text string")
    assert licenses.scan(spark.createDataFrame([(1, "MY, program")], "doc_id long, text string"), own).first().license_id == "a"


def test_whole_licenses_and_titles(spark):
    texts = {p.stem: p.read_text(encoding="utf-8") for p in licenses.TEXTS.glob("*.txt")}
    assert len(texts) == 14
    rows = [(name, text) for name, text in texts.items()]
    rows += [("Apache-2.0", texts["Apache-2.0"].split("APPENDIX")[0]), ("GPL-3.0", texts["GPL-3.0"].replace("https:", "http:")), ("GPL-2.0", " ".join(texts["GPL-2.0"].split("END OF TERMS")[0].replace("Copyright (C) 1989, 1991 Free Software Foundation, Inc.,", "").split()))]
    rows += [("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + licenses.LICENSES["MIT"]), ("MIT", "The MIT License (MIT)\n" + licenses.LICENSES["MIT"]), ("BSD-3-Clause", "BSD 3-Clause License\n" + licenses.LICENSES["BSD-3-Clause"]), ("Unlicense", "The Unlicense\n" + texts["Unlicense"])]
    rows += [(None, "MIT License"), (None, "Licensed under the Apache License, Version 2.0."), (None, "Some program\n" + texts["MPL-2.0"])]
    docs = spark.createDataFrame(list(enumerate(t for _, t in rows)), "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [name for name, _ in rows]


def test_licenses_of_long_texts_and_clashing_columns(spark):
    """A licence inside a very long text doesn't match; columns named like the operator's are no matter; repeated rows are alike."""
    mit = licenses.LICENSES["MIT"]
    rows = [(1, "word " * 200_000 + mit), (2, mit + "\n" * 100_000), (2, mit + "\n" * 100_000), (None, mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as digest", "1 as canonical", "'z' as license_id")
    assert sorted(((r.doc_id, r.license_id) for r in licenses.scan(docs).collect()), key=str) == [(1, None), (2, "MIT"), (2, "MIT"), (None, "MIT")]


NOTICES = ["Copyright Jane Doe 2020", "Copyright The Foo Authors", "Copyright [yyyy] [name]", "Copyright <YEAR> <HOLDER>", "Copyright (c) <year> <owner>", "Portions Copyright (c) 2001 X", "; Copyright (c) 2020 X", "<!-- Copyright (c) 2020 X -->", "// Copyright 2020 X", "-- Copyright (c) 2020 X", "(c) 2020 X", "© X", "Copyright (c) 2020 X\nAll rights reserved.", "# Copyright 2020 X\n#\n# All rights reserved.", "All rights reserved.\nCopyright X", "Copyright X\nCopyright (c) 1999 Y. All rights reserved."]
SENTENCES = ["copyright holders or contributors be liable", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "copyright notice and this permission notice", "Copyright and Related Rights include", "copyright owner that is granting", "copyright license to reproduce", "All rights reserved."]


def test_copyright_notices(spark):
    mit = licenses.LICENSES["MIT"]
    rows = [n + "\n\n" + mit for n in NOTICES] + ["MIT License\n" + n + "\n" + mit for n in NOTICES] + [s + "\n" + mit for s in SENTENCES]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(docs).collect()}
    assert [rows[i] for i in range(2 * len(NOTICES)) if got[i] != "MIT"] == []
    assert [rows[i] for i in range(2 * len(NOTICES), len(rows)) if got[i] is not None] == []
    wrapped = [mit.replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace("copyright notice", "\ncopyright notice"), licenses.LICENSES["BSD-3-Clause"].replace("copyright", "\ncopyright").replace("COPYRIGHT", "\nCOPYRIGHT")]
    apache = (licenses.TEXTS / "Apache-2.0.txt").read_text(encoding="utf-8")
    wrapped.append(" ".join(apache.split("END OF TERMS")[0].split()))
    again = licenses.scan(spark.createDataFrame(list(enumerate(wrapped)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.license_id for r in again} == {0: "MIT", 1: "BSD-3-Clause", 2: "Apache-2.0"}


def _targets(sizes, weights, share=1.5, most=2.0):
    """The contract's rule, source by source: a full source leaves, and what it couldn't take is dealt again."""
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        part = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * part > most * sizes[i]]
        for i in full or open_:
            out[i] = most * sizes[i] if full else weights[i] * part
            left -= most * sizes[i] if full else 0
        open_ = [i for i in open_ if full and i not in full]
    return out


def test_targets(spark):
    rng = np.random.default_rng(0)
    cases = [[10, 10, 10], [0, 10], [0], [1, 1000, 1, 1], rng.integers(0, 1000, 50).tolist()]
    for sizes in cases:
        weights = [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sizes))]
        table = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))], "i int, size long, weight double")
        got = [r.target for r in mixing.with_targets(table, 1.5, 2.0).orderBy("i").collect()]
        assert got == pytest.approx(_targets(sizes, weights))
    assert _targets([10, 10, 10], [3, 1, 2]) == pytest.approx([20, 25 / 3, 50 / 3])


def test_mixing_query_against_plain_rules(spark):
    """The registered query on a whole table: sizes, sources' sizes and targets exact, taken words near targets, no document over twice its size."""
    from tessera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op7_mix_sources"](spark, sf).collect()}
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    total = collections.Counter()
    for r in docs:
        total[r.source] += size[r.doc_id]
    names = sorted(total, key=lambda s: (s is None, s))
    target = dict(zip(names, _targets([total[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))]), strict=True))
    taken = collections.Counter()
    for r in docs:
        g = got[r.doc_id]
        assert (g.size, g.source_size) == (size[r.doc_id], total[r.source]) and g.target == pytest.approx(target[r.source])
        assert 0 <= g.taken <= 2 * g.size and (not g.size or g.taken % g.size == 0)
        taken[r.source] += g.taken
    most = max(size.values())
    assert len(got) == len(docs) and all(abs(taken[s] - target[s]) <= 2 * most for s in names)


def test_mixing(spark, awkward, no_docs):
    rows = [(i, "w " * (1 + i % 30), f"s{i % 3}" if i % 7 else None) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(2000))
    taken, target = collections.Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 70 for s, t in target.items())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(docs.repartition(7)).collect()))
    assert mixing.mixture(awkward).count() == awkward.count()
    assert mixing.mixture(no_docs).collect() == []


def test_packing(spark, awkward, no_docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    docs = awkward.unionByName(spark.createDataFrame([(30, "日本語 mixed 文"), (31, "a <|endoftext|> b"), (32, "<|endoftext|>" * 3), (33, "lang " * 2000)], "doc_id long, text string"), allowMissingColumns=True).repartition(3)
    got = packing.pack(docs, window=64).collect()
    place, pieces = collections.defaultdict(list), collections.Counter()
    for r in got:
        place[r.sequence_id].append((r.offset, r.length))
    total = 0
    for s, parts in place.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        total += at
        assert at == 64 or s == max(place)
        assert {r.padded for r in got if r.sequence_id == s} == {64 if at & (at - 1) else at}
    want = collections.Counter()
    for r in docs.collect():
        ids = [*exact.encode(r.text or "", add_special_tokens=False).ids, 0]
        want[r.doc_id, len(ids)] += len(ids)
    for r in got:
        pieces[r.doc_id, r.doc_tokens] += r.length
    assert pieces == want and total == sum(want.values())
    assert packing.pack(no_docs).collect() == []


def test_quick_tokens_are_exact():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    encode = packing.encoder(packing.default_tokenizer())
    chars = [chr(c) for c in range(0x250)]
    texts = [f"a{x}b {x}{x} {x}1{x}" for x in chars] + ["".join(chars), " " * 50, "don't we'LL  \n\n x", "A" * 300]
    assert encode(texts) == [exact.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_query_on_a_whole_table(spark):
    """The registered query against the tokenizer called as the contract names it, piece by piece, at 1024."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm.queries import QUERIES

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sf = "/root/testdata/sf0.001"
    ids = {r.doc_id: [*exact.encode(r.text or "", add_special_tokens=False).ids, 0] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got, covered = QUERIES["op10_pack_sequences"](spark, sf).collect(), collections.Counter()
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(np.array(part, "<u4").tobytes()))
        covered[r.doc_id] += r.length
    assert covered == {d: len(x) for d, x in ids.items()}
    place = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert all(n[1] == (o + k if s == n[0] else 0) for (s, o, k), n in zip(place, place[1:], strict=False))


def test_language_query_on_a_whole_table(spark):
    """The registered query: held-out accuracy, und exactly for texts without a letter."""
    import unicodedata

    from tessera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    right = []
    for r in got:
        text = docs[r.doc_id].text or ""
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(unicodedata.category(c)[0] == "L" for c in text))
        if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und":
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert np.mean(right) > 0.97


def test_language_edges(spark):
    """Numbers that are no letters, columns with clashing names, no rows, a very long text."""
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)], "doc_id long, text string, lang string").selectExpr("*", "'x' as word", "'y' as bucket", "1 as n", "2 as score")
    model = LI.train(docs)
    ask = spark.createDataFrame([(1, "½ ² Ⅷ ४ 12"), (2, "the dog " * 200_000), (3, "_"), (None, "der hund")], "doc_id long, text string").selectExpr("*", "'x' as lang_pred", "1 as words")
    got = {r.doc_id: (r.lang_pred, r.score) for r in LI.identify(ask, model).collect()}
    assert got == {1: ("und", 0.0), 2: ("en", 1.0), 3: ("und", 0.0), None: ("de", 1.0)}
    assert LI.identify(ask.filter("false"), model).collect() == []


def test_toxicity(spark, no_docs):
    rng = np.random.default_rng(1)
    words = [f"w{''.join(chr(97 + int(c)) for c in str(i))}" for i in range(300)]
    rows, marks = [], []
    for i in range(900):
        text = rng.choice(words, 40).tolist()
        bad = i % 6 == 0
        rows.append((i, " ".join(text + (["nasty", "vile"] if bad else []))))
        if i % 2 == 0:
            marks.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "vile nasty")], "doc_id long, text string").selectExpr("*", "1 as y", "2 as h", "'q' as words")
    labels = spark.createDataFrame([*marks, (5000, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, toxicity.held_out_third()).collect()}
    assert len(got) == 903
    assert all(got[i].predicted == int(i % 6 == 0) for i in range(900))
    assert got[None].predicted == 1 and got[1000].predicted == got[1001].predicted == 0
    assert toxicity.toxicity(no_docs, labels, toxicity.held_out_third()).collect() == []
    assert {r.predicted for r in toxicity.toxicity(docs, labels.filter("false"), toxicity.held_out_third()).collect()} == {0}


def test_toxic_words_of_a_minority(spark):
    """A word that a few per cent of the toxic documents have is learned, and the words of one family of near copies are not."""
    rng = np.random.default_rng(2)
    words = [f"w{''.join(chr(97 + int(c)) for c in str(i))}" for i in range(300)]
    family = [f"f{chr(97 + i)}" for i in range(26)] + [f"g{chr(97 + i)}" for i in range(26)]
    rows, marks = [], []
    for i in range(4800):
        bad = i % 8 == 0
        text = rng.choice(words, 30).tolist() + (["rareslur"] if bad and i % 240 == 0 else ["nasty"] if bad else [])
        if i % 400 == 8:
            text = [*family, "nasty", f"x{chr(97 + i // 400)}"]
        rows.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    weights, _ = toxicity.train(docs, labels, toxicity.held_out_third(), least_z=3.5)
    assert weights["rareslur"] > 0 and weights["nasty"] > 0 and not set(weights) & set(family)


def test_toxic_stems(spark):
    """Words that occur once each but begin alike are learned by their beginning; the words of training and scoring are the same."""
    rng = np.random.default_rng(3)
    words = [f"w{''.join(chr(97 + int(c)) for c in str(i))}" for i in range(300)]
    ending = lambda i: "".join(chr(97 + int(c)) for c in f"{i:05d}")
    rows = [(i, " ".join(rng.choice(words, 30).tolist() + ([f"Schurk{ending(i)}"] if i % 8 == 0 else []))) for i in range(2000)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(2000)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, toxicity.held_out_third()).collect()}
    assert all(r.predicted == int(i % 8 == 0) for i, r in got.items())
    assert toxicity.letter_words("Æther ½x² Ⅷa_b 日本") == ["æther", "x", "a", "b", "日本"]
    assert toxicity.word_features("abcde") == ["abcde", "abc*", "abcd*"]


def test_toxicity_of_repeated_rows_and_long_texts(spark):
    """Repeated ids don't swell the sample, a toxic word counts wherever it is in a long text."""
    rows = [(i, f"plain text number {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} here" + (" nasty" if i % 5 == 0 else "")) for i in range(600)] + [(7, "again and again")] * 300 + [(None, "nobody")] * 300
    rows.append((5000, "fine word " * 60_000 + "nasty"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    sample = toxicity._sample(docs, 50, 1)
    assert 0 < sample.count() <= 50
    got = toxicity.toxicity(docs, labels, toxicity.held_out_third())
    assert got.count() == len(rows) and got.filter("doc_id = 5000 or doc_id % 5 = 0 and doc_id < 600").filter("predicted = 0").isEmpty()
