"""Operators that compare documents or vectors: repeats, near copies, vectors,
archives, and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from martkit.llm import ngram_join, pivot_index, queries, repeated_text, warc_chunks
from martkit.llm.common import Staging, components, for_workers
from martkit.session import new_path
from tests.conftest import rows
from tests.llm.helpers import SF, cosine_groups, documents, edge_rows, jaccard_groups, prose, repeats, sample


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    for_workers(spark)


def test_components(spark):
    chance = random.Random(4)
    edges = [(chance.randint(0, 300), chance.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(5000, 5000 + i) for i in range(50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()}
    root = {v: v for e in edges for v in e}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    alone = {v for v in root if all(a == b for a, b in edges if v in (a, b))}
    assert got == {v: r for v, r in root.items() if v not in alone}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("depth", [3, 10, 31])
def test_suffix_order(spark, depth):
    chance = random.Random(depth)
    strings = [[chance.choice([0, 1, 2, 3]) for _ in range(chance.randint(1, 40))] for _ in range(12)] + [[7] * 40, [7] * 50 + [9], [9, 7, 7, 9], [0], [5]]
    df = spark.createDataFrame(list(enumerate(strings)), "str long, s array<long>")
    rank = {(r["str"], r["at"]): r["rank"] for r in repeated_text.suffix_ranks(df, depth, Staging(spark)).collect()}
    known = [(i, a) for i, s in enumerate(strings) for a, v in enumerate(s) if v]
    assert set(rank) == set(known)

    def prefix(i, a):
        s = [*strings[i][a:], 0]
        s = s[: s.index(0)][:depth]
        return s

    order = sorted(known, key=lambda k: (rank[k], k))
    assert all(prefix(*x) <= prefix(*y) for x, y in zip(order, order[1:]))


def _with_repeats(seed: int) -> list[tuple]:
    """Passages shared at all offsets, near and exact copies, periodic texts."""
    chance = random.Random(seed)
    passages = [prose(100 * seed + k, chance.randint(40, 90)) for k in range(4)]
    docs = []
    for d in range(24):
        parts = [prose(1000 * seed + d, chance.randint(1, 60))]
        for _ in range(chance.randint(0, 2)):
            p = chance.choice(passages)
            a = chance.randint(0, 30)
            parts += [p[a : a + chance.randint(380, 460)], prose(chance.randint(0, 10**6), chance.randint(0, 20))]
        docs.append((d, chance.choice(["", " "]).join(parts)))
    whole = docs[3][1] + prose(9, 200)
    edited = whole.split()
    edited[len(edited) // 2] = "changed"
    docs += [(30, whole), (31, whole), (32, " ".join(edited)), (33, "ab" * 400), (34, "xyz " * 150), (35, "q" * 399), (36, "q" * 400), (36, "q" * 401)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    docs = _with_repeats(seed)
    df = documents(spark, docs, key="x", spans=1).repartition(3)
    got = rows(repeated_text.repeat_report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == repeats(docs)


def test_repeats_edges(spark):
    docs = edge_rows()
    df = documents(spark, docs)
    assert rows(repeated_text.repeat_report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == repeats(docs)
    assert repeated_text.repeat_report(df.limit(0)).count() == 0


def test_repeats_query(spark):
    assert rows(queries.op6_repeated_text(spark, SF)) == repeats(sample("documents", "doc_id, text"))


def _near_copies(seed: int, large: int) -> list[tuple]:
    chance = random.Random(seed)
    docs, d = [], 0
    for k in range(12):
        words = prose(seed * 50 + k, chance.randint(1, 150)).split()
        for _ in range(chance.choice([1, 2, 3, 6, large]) if k else large):
            some = list(words)
            for _ in range(chance.randint(0, max(1, len(words) // 40))):
                some[chance.randrange(len(some))] = f"w{chance.randint(0, 9)}"
            docs.append((d, " ".join(some)))
            d += 1
    return docs


def test_near_copies_equal_brute_force(spark):
    docs = _near_copies(3, 60)
    df = documents(spark, docs, cls="x", kept=1).repartition(4)
    got = ngram_join.similarity_join(df)
    assert rows(got, "doc_id", "n_links", "component_id") == jaccard_groups(docs)


def test_where_buckets_become_large_does_not_matter(spark, monkeypatch):
    docs = _near_copies(5, 40)
    df = documents(spark, docs)
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    few = rows(ngram_join.similarity_join(df), "doc_id", "n_links", "component_id")
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    assert rows(ngram_join.similarity_join(df), "doc_id", "n_links", "component_id") == few == jaccard_groups(docs)


def test_near_copies_edges(spark):
    docs = edge_rows()
    df = documents(spark, docs, class_id="x", weight=2)
    got = rows(ngram_join.similarity_join(df), "doc_id", "n_links", "component_id")
    assert got == jaccard_groups(docs)
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([0, 1, 2, 3, 5, 6, 7, 8, 10, None, None])
    assert ngram_join.similarity_join(df.limit(0)).count() == 0 and ngram_join.drop_near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("times", [10, 40])
def test_a_repeated_row_counts_once_a_class(spark, times):
    """The smallest id of a class, repeated with one text, beside two near copies."""
    docs = []
    for k in range(12):
        words = prose(700 + k, 120).split()
        near = [" ".join([*words[:at], "changed", *words[at + 1 :]]) for at in (20, 90)]
        docs += [(10 * k, " ".join(words))] * times + [(10 * k + 1, near[0]), (10 * k + 2, near[1]), (10 * k + 3, " ".join(words))]
    got = ngram_join.similarity_join(documents(spark, docs).repartition(4))
    assert rows(got, "doc_id", "n_links", "component_id") == jaccard_groups(docs)


def test_ids_with_several_texts_lose_near_copies_only(spark):
    words = [prose(900 + k, 120).split() for k in range(5)]
    near = lambda k: " ".join([*words[k][:60], "changed", *words[k][61:]])
    whole = lambda k: " ".join(words[k])
    clean = "zz " + prose(990, 80)  # after the other texts of its id
    docs = [
        (7, "zz " + whole(0)), (9, "zz " + near(0)),  # a group whose least id also stands for a near copy of 3
        (3, "aa " + whole(1)), (7, "aa " + near(1)),
        (7, clean), (7, clean), (7, ""), (7, None),
        (5, whole(2)), (5, near(2)), (6, whole(2)),  # near copies under one id
        (8, whole(3)), (8, whole(4)), (None, whole(3)),
        (4, ""), (4, "aa " + whole(1)),
    ]
    df = documents(spark, docs, cls="x", root=1).repartition(3)
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns
    want = [
        (7, "zz " + whole(0)), (3, "aa " + whole(1)), (7, clean), (7, ""), (7, None), (5, min(whole(2), near(2))),
        (8, whole(3)), (8, whole(4)), (None, whole(3)), (4, ""),
    ]
    assert rows(kept, "doc_id", "text") == sorted(want, key=repr)


def test_near_copies_query(spark):
    got = rows(queries.op9_ngram_join(spark, SF), "doc_id", "n_links", "component_id")
    assert got == jaccard_groups(sample("documents", "doc_id, text"))


def test_pruning_keeps_what_may_reach_the_threshold():
    least = ngram_join.least_matches(0.8)
    assert least[0] == 0 and all(0 <= b - a <= 1 for a, b in zip(least, least[1:]))
    assert 0.4 * 96 < least[96] < 0.75 * 96


def _vectors(seed: int) -> list[tuple]:
    chance = np.random.default_rng(seed)
    out = []
    for k in range(40):
        v = chance.normal(size=16)
        for _ in range(int(chance.integers(1, 5)) if k else 30):
            out.append((len(out), (v + 0.2 * chance.normal(size=16)).tolist()))
    out += [(500, None), (501, []), (502, [0.0] * 16), (503, [1.0] * 15 + [None]), (504, [float("nan")] * 16), (505, [float("inf")] * 16), (506, [1.0, 2.0])]
    out += [(510, [1.0, 2.1]), (511, [1.0, -2.0]), (512, [3.0]), (513, [4.0]), (514, [-4.0])]  # other lengths
    out += [(507, out[0][1]), (507, out[0][1]), (None, out[0][1]), (508, [1e-200] * 16), (509, [1e200] * 16)]
    return out


def test_vectors_against_brute_force(spark):
    """With all pivots named the index is exact; the recall of fewer is measured."""
    data = _vectors(1)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<double>, cls string, weight int").repartition(3)
    got = pivot_index.link_vectors(df, near=10_000, shared=1)
    assert rows(got, "vec_id", "n_links", "component_id") == cosine_groups(data)
    assert pivot_index.link_vectors(df.limit(0)).count() == 0


def test_chunks_of_vectors_do_not_matter(spark, monkeypatch):
    data = _vectors(2)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    whole = rows(pivot_index.link_vectors(df))
    monkeypatch.setattr(pivot_index, "CHUNK", 8)
    assert rows(pivot_index.link_vectors(df)) == whole


def test_recall_of_the_index_at_the_threshold(spark):
    """Pairs made to lie at a cosine of 0.9 to 0.95, among others."""
    chance = np.random.default_rng(6)
    base = chance.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = chance.normal(size=(300, 64))
    side -= (side * base[:300]).sum(axis=1, keepdims=True) * base[:300]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = chance.uniform(0.9, 0.95, (300, 1))
    near = c * base[:300] + np.sqrt(1 - c * c) * side
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    units = np.array([v for _, v in data])
    true = int(((units @ units.T) >= 0.9).sum() - len(units))
    found = pivot_index.link_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    total = sum(r["n_links"] for r in found.collect())
    assert 0.95 * true <= total <= true


def _crowd(n: int, dims: int) -> np.ndarray:
    """Unit vectors, a third of them around one centre at cosines of about 0.91
    with each other; half of these pairs and more are links."""
    chance = np.random.default_rng(n)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    units = unit(chance.normal(size=(n, dims)))
    centre = units[:1].copy()
    side = units[: n // 3]
    side = unit(side[1:] - (side[1:] @ centre.T) * centre)
    c = np.sqrt(chance.normal(0.91, 0.01, (len(side), 1)))
    units[1 : n // 3] = c * centre + np.sqrt(1 - c * c) * side
    return units[chance.permutation(n)]


def _cone(n: int, dims: int) -> np.ndarray:
    """Directions at a mean cosine of 0.85 with each other, as embeddings often
    have, half of them with a partner at 0.91."""
    chance = np.random.default_rng(n + 1)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit(chance.normal(size=(1, dims)))
    across = lambda x: unit(x - (x @ centre.T) * centre)
    side = across(chance.normal(size=(n // 2, dims)))
    c = 0.4  # of the parts across the centre, for 0.85 + 0.15 c = 0.91
    other = chance.normal(size=side.shape)
    other = across(other)
    other = unit(other - (other * side).sum(axis=1, keepdims=True) * side)
    sides = np.concatenate([side, c * side + math.sqrt(1 - c * c) * other])
    return (math.sqrt(0.85) * centre + math.sqrt(0.15) * sides)[chance.permutation(2 * (n // 2))]


def _loose(n: int, dims: int) -> np.ndarray:
    """Five groups with a mean cosine of 0.88, so that few of their pairs link."""
    chance = np.random.default_rng(n + 2)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = unit(chance.normal(size=(5, dims)))[chance.integers(0, 5, n)]
    side = chance.normal(size=(n, dims))
    side = unit(side - (side * centres).sum(axis=1, keepdims=True) * centres)
    return math.sqrt(0.88) * centres + math.sqrt(0.12) * side


@pytest.mark.parametrize(
    "shape, n, dims", [(_crowd, 20_000, 64), (_crowd, 20_000, 384), (_cone, 20_000, 64), (_cone, 40_000, 64), (_loose, 20_000, 64), (_loose, 20_000, 384)]
)
def test_recall_of_crowded_vectors(spark, shape, n, dims):
    """Production parameters, against every pair."""
    units = shape(n, dims)
    true = np.concatenate([((units[s : s + 500] @ units.T) >= 0.9).sum(axis=1) for s in range(0, len(units), 500)]) - 1
    data = pa.table({"vec_id": np.arange(len(units)), "embedding": pa.FixedSizeListArray.from_arrays(units.ravel(), dims).cast(pa.list_(pa.float64()))})
    got = pivot_index.link_vectors(spark.createDataFrame(data).repartition(4)).select("vec_id", "n_links").toArrow()
    found = np.zeros(len(units), np.int64)
    found[got.column("vec_id").to_numpy()] = got.column("n_links").to_numpy()
    recall = found.sum() / true.sum()
    print(f"{shape.__name__}: recall {recall:.5f} of {true.sum() // 2} links, {n} vectors, {dims} dimensions")
    assert true.sum() > 5_000 and recall >= 0.95 and (found <= true).all()


def test_pivots_lie_apart_unless_all_vectors_do_not():
    units = _crowd(3_000, 64)
    near = lambda x: ((x @ x.T) - np.eye(len(x))).max()
    few = pivot_index.thinned(units, 0.9)
    assert near(few) < 0.62 and 1_900 < len(few) < 2_010
    cone = np.concatenate([units, np.full((len(units), 1), 2.0)], axis=1) / np.sqrt(5)  # cosines of 0.8 about
    some = pivot_index.thinned(cone, 0.9)
    assert near(some) < 0.9 and len(some) > 900
    assert len(pivot_index.thinned(units[:0], 0.9)) == 0


def test_vector_query(spark):
    got = rows(queries.op1_pivot_index(spark, SF), "vec_id", "n_links", "component_id")
    assert got == cosine_groups([(i, list(v)) for i, v in sample("embeddings", "vec_id, embedding")])


PAGES = "page_id long, url string, html string"


def _expected_pages(pages):
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in pages:
        raw = (h or "").encode()
        to = first.get(h or "")
        to = None if to is None or to == p else to
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((p, len(raw), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_archives(spark, monkeypatch):
    long = prose(5, 30_000)
    pages = [
        (5, "http://a/%20b?x=1", long), (3, None, long), (4, "http://c\n: d", None), (9, "", ""), (9, "u", "short"), (9, "u", "short"), (9, "v", "other"),
        (None, "w", "short"), (None, None, "alone"), (12, " x ", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
    ]
    df = spark.createDataFrame([(*p, "x") for p in pages], PAGES + ", payload string").repartition(3)
    assert rows(warc_chunks.archive_report(df), *COLUMNS) == _expected_pages(pages)
    folder = new_path(spark, "warc-test")
    found = warc_chunks.read_archives(spark, folder, warc_chunks.write_archives(df, folder), size=1000)
    chunks = found.filter("page_id = 3").orderBy("chunk_no").collect()
    assert len(chunks) > 100 and b"".join(bytes(c["data"]) for c in chunks) == long.encode()
    done = 0
    for c in chunks[:3]:
        done += len(c["data"])
        so_far = base64.b32encode(hashlib.sha1(long.encode()[:done]).digest()).decode()
        assert c["bytes_so_far"] == done and c["digest_so_far"] == so_far and not c["last"]
    urls = {(r["page_id"], r["url"]) for r in found.collect()}
    assert {(p, u) for p, u, _ in pages} == urls
    for path in Path(folder).glob("*.warc.gz"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert warc_chunks.archive_report(df.limit(0)).count() == 0


def test_short_payloads_may_all_be_responses(spark):
    df = spark.createDataFrame([(1, "a", "x" * 10), (2, "b", "x" * 10), (3, "c", "y" * 50), (4, "d", "y" * 50)], PAGES)
    got = {r["page_id"]: r["refers_to"] for r in warc_chunks.archive_report(df, least_bytes=20).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_chunks_are_digested_in_order(spark):
    known = warc_chunks.records(spark.createDataFrame([(1, "a", "é" * 5000), (2, "b", ""), (3, "c", None)], PAGES))
    table = warc_chunks.chunk_table(known, 7)
    assert table.filter("page_id = 1").count() == -(-10_000 // 7)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc_chunks.digests(table).collect()}
    for p, raw in ((1, ("é" * 5000).encode()), (2, b""), (3, b"")):
        assert got[p] == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())


def test_archive_query(spark):
    assert rows(queries.op3_warc_chunks(spark, SF), *COLUMNS) == _expected_pages(sample("pages", "page_id, url, html"))


def test_pipeline_stages(spark):
    """Each stage against what its input asks for."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staging.keep(stage(spark, docs, SF), name)
        out[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    first, kept = (dict(x.select("doc_id", "text").collect()) for x in out["quality"])
    judged = {r["doc_id"]: r["kept"] for r in queries.op10_quality_rules(spark, SF).collect()}
    assert set(kept) == {d for d in first if judged[d]}
    before, after = (x.select("doc_id", "text").collect() for x in out["near_copies"])
    groups = jaccard_groups([tuple(r) for r in before])
    assert {r["doc_id"] for r in after} == {root for _, _, root in groups}
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out["private_data"][1].collect()}
    assert set(masked) == {r["doc_id"] for r in after} and all(len(t) == n for t, n in masked.values())
    mixed = Counter(r["doc_id"] for r in out["mixing"][1].collect())
    assert set(mixed) <= set(masked)
    packed = Counter()
    for r in out["packing"][1].collect():
        packed[r["doc_id"]] += r["length"]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in out["packing"][1].collect()}
    assert packed == Counter({d: tokens[d] * n for d, n in mixed.items()})
    assert corpus_pipeline.run(spark, SF).count() == out["packing"][1].count()


def test_pipeline_on_edges(spark):
    docs = documents(spark, edge_rows(), extra="x")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.collect()


@pytest.mark.parametrize("name", ["op3_warc_chunks", "op7_source_mix", "op9_ngram_join"])
def test_queries_equal_their_sql(spark, name):
    found = queries.QUERIES[name](spark, SF)
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert sorted(want.columns) == columns
    assert rows(found.select(*columns)) == sorted(want.select(*columns).fetchall(), key=repr)
