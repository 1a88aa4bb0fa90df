"""Jaccard join, vector search, near vectors, archives and the pipeline against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from namewright.llm import jaccard_join, maxscore, multi_index, queries, shingles, warc
from namewright.llm.components import components


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 700)] + [(900, i) for i in range(901, 1000)]
    df = spark.createDataFrame([*links, (5, None), (None, None)], "a long, b long")
    expected = union_find({n for p in links if p[0] != p[1] for n in p}, links)
    assert {r.node: r.label for r in components(df).collect()} == expected
    assert components(df.where("false")).count() == 0


# ---- n-gram Jaccard join

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def plain_groups(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    labels = union_find(ids, links)
    return {d: (len(sets[d]), labels[d]) for d in ids}


def corpus():
    """Groups of near copies around the threshold, a common passage, short, empty and repeated texts."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = words(60), []
    for _ in range(6):
        base = words(rng.randint(20, 200))
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy)
    rows += [passage + words(rng.randint(5, 40)) for _ in range(30)] + [words(rng.randint(1, 6)) for _ in range(20)] + [["a", "b"], ["A", "b"], ["a", "b", "c", "d", "e"]]
    texts = [" ".join(r) for r in rows] + ["", " \t\n", None, "x", "x", "word " * 3000, "word " * 3001]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in corpus()], "doc_id long, text string, n string, node int").repartition(5)


def test_near_groups_equal_brute_force(documents):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(documents).collect()}
    assert found == plain_groups(corpus())


def test_near_groups_in_small_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(documents).collect()}
    assert found == plain_groups(corpus())


def test_groups_of_nothing(documents):
    assert jaccard_join.near_groups(documents.where("false")).count() == 0
    assert {(r.n_shingles, r.component_id == r.doc_id) for r in jaccard_join.near_groups(documents.where("text is null or trim(text) = ''")).collect()} == {(0, True)}


def test_groups_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    rows = sorted((r.doc_id or -1, r.component_id) for r in jaccard_join.near_groups(df).collect())
    assert rows == [(-1, None), (3, 3), (7, 3), (7, 3)]


def test_region_links_equal_brute_force():
    rng = np.random.default_rng(0)
    for split in (False, True):
        base = rng.integers(0, 2**60, 120, dtype=np.uint64)
        arrays = [np.unique(np.concatenate([base[rng.random(120) < 0.93], rng.integers(0, 2**60, rng.integers(0, 8), dtype=np.uint64)])) for _ in range(150)]
        labels, left = rng.integers(0, 9, 150), np.arange(150) < 70
        expected = {
            (i, j)
            for i in range(150) for j in range(i + 1, 150)
            if labels[i] != labels[j] and (not split or left[i] != left[j])
            and 100 * (s := len(np.intersect1d(arrays[i], arrays[j]))) >= 80 * (len(arrays[i]) + len(arrays[j]) - s)
        }
        assert set(jaccard_join.region_links(arrays, labels, 80, left if split else None)) == expected and expected


def test_bucket_counts_never_understate():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 5000, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 5000, 40, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        x, y = (np.frombuffer(jaccard_join.counted(s), "<u2").astype(int) for s in (a, b))
        assert np.minimum(x, y).sum() * (len(a) + len(b) - shared) >= shared * np.maximum(x, y).sum()
        assert (jaccard_join.unpacked(jaccard_join.packed(a)) == a).all()


def test_shingle_sizes():
    import pyarrow as pa

    texts = [t for _, t in corpus()]
    assert [len(s) for s in shingles.shingle_sets(pa.array(texts))] == [len(shingle_set(t)) for t in texts]


# ---- exact search


def test_maxscore_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 12)) * (rng.random((700, 12)) < 0.6)
    x[50:60] = x[40]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [1.0, None]), (902, [float("nan")]), (903, [float("inf")]), (904, []), (905, [0.5, 0.25]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in maxscore.search(df, df.where("vec_id % 20 = 0"), shard_rows=100).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    full = {i: np.zeros(12, int) for i in [*range(700), 904, 905]}
    for i in range(700):
        full[i] = np.floor(64 * x[i]).astype(int)
    full[905][:2] = [32, 16]
    for q in [i for i in full if i % 20 == 0]:
        best = sorted((-int(full[q] @ full[i]), i) for i in full if i != q)[:20]
        assert sorted(found[q]) == [(k, i, -s) for k, (s, i) in enumerate(best, 1)], q
    assert set(found) == {i for i in full if i % 20 == 0}
    assert maxscore.search(df.where("false"), df.where("false")).count() == 0
    few = df.where("vec_id < 5")
    assert maxscore.search(few, few.where("vec_id = 0")).count() == 4


def plain_search(rows, k=20):
    """Exact search in Python's integers."""
    full = {i: [math.floor(64 * v) for v in x] for i, x in rows}
    out = {}
    for q in full:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(full[q], full[i])), i) for i in full if i != q)
            out[q] = [(r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def searched(df, **options):
    out = {}
    for r in maxscore.search(df, df.where("vec_id % 20 = 0"), **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(found) for q, found in out.items()}


@pytest.mark.parametrize("size", [1e3, 1e6, 3e8, 1e9])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(90, 3)) * size / 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = plain_search(rows)
    if any(abs(s) >= 2**63 for found in expected.values() for *_, s in found):
        with pytest.raises(Exception, match="does not fit a long"):
            searched(df, shard_rows=30)
    else:
        assert searched(df, shard_rows=30) == expected


def test_components_that_no_long_holds(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [2e300, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 2"):
        searched(df)


def test_search_with_clashing_columns_ties_and_repeats(spark):
    rows = [(i % 30, [float(i % 30 % 4), 1.0], "x", 1, 2, 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, score int, shard int, v int")
    found = searched(df)
    assert {q: len(v) for q, v in found.items()} == {0: 20, 20: 20}
    assert [(i, s) for _, i, s in found[0]][:4] == [(1, 4096), (1, 4096), (2, 4096), (2, 4096)]


def test_thresholds_rise_and_change_nothing():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(6000, 24)) * 64).astype(np.int64)
    x[rng.random(x.shape) < 0.5] = 0
    shard, asked = maxscore.Shard(np.arange(6000), x), np.arange(0, 6000, 20)
    first = maxscore.Shard(np.arange(2000), x[:2000]).best(asked, x[asked], np.full(len(asked), -np.inf), 20)
    fresh = shard.best(asked, x[asked], np.full(len(asked), -np.inf), 20)
    begun = shard.best(asked, x[asked], first.threshold, 20)
    assert (first.threshold <= fresh.threshold).all() and (first.threshold < fresh.threshold).any()
    for a, b in ((fresh.owner, begun.owner), (fresh.ids, begun.ids), (fresh.score, begun.score)):
        assert (a == b).all()
    full = x[asked] @ x.T
    full[np.arange(len(asked)), asked] = -(1 << 60)
    assert (np.sort(full, axis=1)[:, -20:][:, ::-1].ravel() == fresh.score).all()


# ---- near vectors


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base[rng.integers(0, 40, 500)] + rng.normal(size=(500, 16)) * 0.12, rng.normal(size=(500, 16))])
    x[7] = x[3]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(2000, None), (2001, [0.0] * 16), (2002, [1.0, None]), (2003, [float("nan")] * 16), (2004, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in multi_index.near_vectors(df, block_rows=64, cell_rows=16).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    true = int(link.sum())
    assert sum(r.n_links for r in found.values()) / true >= 0.97
    assert all(found[i].n_links <= link[i].sum() for i in range(1000))
    labels = union_find(range(1000), zip(*(a.tolist() for a in np.nonzero(link)), strict=True))
    assert sum(found[i].component_id == labels[i] for i in range(1000)) / 1000 > 0.97
    assert all(found[i].n_links == 0 and found[i].kept for i in range(2000, 2005)) and len(found) == 1005
    assert found[7].n_links == found[3].n_links
    assert multi_index.near_vectors(df.where("false")).count() == 0


def test_every_width_links_with_its_own(spark):
    """Two widths with neighbours each, one of few vectors, ties at the threshold, clashing columns and repeated rows."""
    rng = np.random.default_rng(1)
    base = {w: rng.normal(size=(12, w)) for w in (8, 5)}
    rows = [(i, [float(v) for v in base[w][i % 12] + rng.normal(size=w) * 0.2]) for i, w in enumerate(rng.choice([8, 8, 8, 5], 600).tolist())]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(5)] + [(1010, [-3.0]), (1011, [5.0]), (1012, [0.5]), (1013, [])]
    # At exactly 0.9 and one step below it.
    rows += [(2000, [1.0, 0.0, 0.0]), (2001, [0.9, math.sqrt(1 - 0.81), 0.0]), (2002, [0.9 - 1e-7, 0.0, math.sqrt(1 - (0.9 - 1e-7) ** 2)])]
    df = spark.createDataFrame([(i, v, "x", 1, 2, 3.0) for i, v in rows], "vec_id long, embedding array<double>, id string, n_links int, cell int, weight double").repartition(3)
    found = {r.vec_id: r for r in multi_index.near_vectors(df, recall=1.0, cell_rows=40, block_rows=50).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if len(v)}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    counts = {i: sum(i in p for p in links) for i, _ in rows}
    labels = union_find([i for i, _ in rows], links)
    sure = [i for i, _ in rows if i < 2000]
    assert {i: (found[i].n_links, found[i].component_id, found[i].kept) for i in sure} == {i: (counts[i], labels[i], labels[i] == i) for i in sure}
    assert found[1000].n_links == 4 and found[1011].n_links == 1 and found[1010].n_links == 0
    assert found[2002].n_links == 0


def test_codes_never_decide_wrongly():
    rng = np.random.default_rng(4)
    unit = multi_index.unit_rows(rng.normal(size=(60, 64)))
    unit = multi_index.unit_rows(unit[rng.integers(0, 60, 400)] + rng.normal(size=(400, 64)) * 0.045)
    true = unit @ unit.T >= 0.9
    i, j, certain = (np.concatenate(x) for x in zip(*multi_index.pair_ranges([c.tobytes() for c in multi_index.encode(unit)], np.zeros(400, int), [[0]] * 400, 0, 0.9, None), strict=True))
    assert true[i[certain], j[certain]].all() and 0 < certain.sum() < len(i)
    assert set(zip(*(x.tolist() for x in np.nonzero(np.triu(true, 1))), strict=True)) <= set(zip(i.tolist(), j.tolist(), strict=True))


def test_recall_with_hundreds_of_codewords(spark):
    """Recall against brute force where each half has 256 codewords; pairs of cosine 0.9 to 0.96."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(3000, 32))
    x = multi_index.unit_rows(centres[rng.integers(0, 3000, 8000)] + rng.normal(size=(8000, 32)) * 0.2)
    grid = multi_index.fit(x, 256, 0.9, 0.97)
    close = x @ x.T
    i, j = np.nonzero(np.triu((close >= 0.9) & (close < 0.96), 1))
    near = grid.near(x)
    met = (near[i] == near[j][:, :1]).any(1) | (near[j] == near[i][:, :1]).any(1)
    assert len(i) > 1000 and met.mean() >= 0.95 and grid.visits < grid.cells / 100


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(3000, 32))
    grid = multi_index.fit(sample, 8, 0.9, 0.95)
    x = multi_index.unit_rows(rng.normal(size=(1000, 32)))
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    v = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1)[:, None]
    a, b = grid.near(x), grid.near(v)
    met = (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
    assert met.mean() >= 0.9
    # The sequence is that of the sums of both halves' distances.
    d = lambda h, c: ((h[:, None] - c) ** 2).sum(2)
    every = (d(x[:, :16], grid.first)[:, :, None] + d(x[:, 16:], grid.second)[:, None, :]).reshape(1000, -1)
    assert (np.argsort(every, axis=1, kind="stable")[:, : grid.visits] == a).mean() > 0.999


# ---- archives


def test_archive_round_trip(spark, tmp_path):
    big, other = "é" * 700, "z" * 1200
    rows = [(1, "http://a/\r\nx", big), (2, "http://b", big), (3, None, other), (4, "http://c", "small"), (5, "http://d", "small"), (6, "u", None), (7, "u", ""), (9, "u", big), (9, "u", big), (None, "u", big), (10, "u", "a\r\n\r\nWARC/1.1\r\n" * 100)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(pages, folder, frame_bytes=2000, bundle_bytes=3000)
    found = sorted(((r.record_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_archives(index, folder).collect()), key=str)
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = 9 if html == big and i in (1, 2) else None
        expected.append((i or 0, "revisit" if refers else "response", refers, len(raw), hashlib.sha1(raw).hexdigest()))
    assert found == sorted(expected, key=str)
    place = index.where("record_id = 10").first()
    record = warc.read_record(folder, place.bundle, place.frame, place.offset, place.length)
    assert record[2] == 10 and record[8].decode() == rows[-1][2]
    assert warc.archive_roundtrip(pages.where("false")).count() == 0
    # The index decides what is read, and from where.
    assert {r.record_id for r in warc.read_archives(index.where("record_id in (3, 9)"), folder).collect()} == {3, 9}
    with pytest.raises(Exception, match="disagree"):
        warc.read_archives(index.withColumn("record_id", F.col("record_id") + 1), folder).collect()


def test_a_payload_beyond_a_frame_and_a_bundle(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, "u", rng.integers(32, 127, n, dtype=np.uint8).tobytes().decode()) for i, n in enumerate([10, 300_000, 2_000_000, 5])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(pages, folder, frame_bytes=1 << 16, bundle_bytes=1 << 18)
    assert {r.record_id: r.payload.decode() for r in warc.read_archives(index, folder, part_bytes=1000).collect()} == {i: h for i, _, h in rows}


def test_frames_stand_alone(spark, tmp_path):
    import zstandard

    writer = warc.BundleWriter(f"file://{tmp_path}", 3)
    for text in (b"one", b"two" * 1000):
        writer.frame(text)
    writer.close()
    raw = (tmp_path / writer.name).read_bytes()
    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as whole:
        assert whole.read() == b"one" + b"two" * 1000


# ---- pipeline


def test_pipeline_against_plain_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet").limit(120)
    extra = spark.createDataFrame([(100001, "12345 ---", "en", "s", 9), (100002, "token = 0123456789abcdefgh but the of and to", "en", "s", 42), (None, "the of and to in", "en", "s", 16)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 3"))
    kept = pipeline.language_id(spark, docs, source)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert 100001 not in {d for d, _ in rows} and len(rows) >= docs.count() - 3
    single = pipeline.near_duplicates(spark, kept, source)
    assert single.columns == docs.columns
    # Rows in order of id, those without one last: the first of each group stays.
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    labels = plain_groups([(k, t) for k, (_, t) in enumerate(order)])
    expected = [order[k] for k, (_, c) in labels.items() if k == c]
    assert sorted(((r.doc_id, r.text) for r in single.collect()), key=str) == sorted(expected, key=str)
    clean = pipeline.secret_scan(spark, single, source)
    assert clean.count() == single.count()
    assert clean.where("doc_id = 100002").first().text == "[SECRET] but the of and to"
    packed = pipeline.pack(spark, clean, source)
    assert packed.select(F.sum("length")).first()[0] == packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "secret_scan", "packing"]


def test_rows_that_share_an_id_are_documents_each(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    one, two, three = ("the first text of all is here now", "another one that says something else entirely today", "a third that nobody has seen in this house")
    rows = [(1, one), (1, two), (1, two), (2, one), (3, ""), (3, ""), (None, two), (None, three), (None, three), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = sorted(((r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert found == sorted([(1, one), (1, two), (None, three), (3, ""), (3, ""), (4, None)], key=str)
    assert pipeline.near_duplicates(spark, docs.where("false"), "").count() == 0


def test_texts_of_no_language_go_by_their_score(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    source = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{source}/documents.parquet").where("lang is not null")
    strange = spark.createDataFrame([(100001, "日本 漢字 仮名 文字 東京 京都", None, "s", 17), (100002, "привет мир это русский текст", None, "s", 28)], docs.schema)
    kept = {r.doc_id for r in pipeline.language_id(spark, docs.unionByName(strange), source).collect()}
    assert not kept & {100001, 100002} and len(kept) >= 0.99 * docs.count()


def test_stages_keep_columns_with_clashing_names(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    names = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, component_id string, spans long, n long"
    rows = [(1, "the of and to in that", "en", "s", 21, "a", 1, "b", 2, 3), (2, "the of and to in that", "en", "s", 21, "a", 1, "b", 2, 3), (3, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, names)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.schema.names == [x.split()[0] for x in names.split(", ")]
    assert [tuple(r) for r in docs.collect()] == [rows[0]]
    assert {r.doc_id for r in pipeline.pack(spark, docs, "").collect()} == {1}


def test_queries_have_names(spark):
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 11))


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    cursor = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    expected = sorted(str([row[names.index(c)] for c in sorted(names)]) for row in cursor.fetchall())
    assert sorted(str([r[c] for c in sorted(names)]) for r in df.collect()) == expected
