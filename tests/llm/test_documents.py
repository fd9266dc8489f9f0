"""Operators on single documents: tokens, personal data, quality, shards, mixing,
packing."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pyspark
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from martkit.llm import common, packed_ids, personal_data, quality_rules, queries, shard_shuffle, source_mix, window_packing
from martkit.llm.common import for_workers
from martkit.llm.tokens import Encoder
from tests.conftest import rows
from tests.llm.helpers import DOCS, SF, documents, edge_rows, prose, sample

PARTS = [*"ab éÉΣσ1½.,'#_\n\t\r \x85\xa0\x01\x1c<|>", "'ll", "  ", "\n\n", "<|endoftext|>"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    for_workers(spark)


@pytest.fixture(scope="module")
def coders():
    return [Encoder(p, cache=50, cache_kept=10) for p in (queries.BYTE_BPE, queries.WORD_BPE)]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_ids_equal_the_library(coders, texts):
    for coder in coders:
        found = coder.encode(texts)
        whole = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [x.tolist() for x in found] == [x.ids for x in whole]


def test_ids_equal_the_library_on_documents(coders):
    texts = [t for (t,) in sample("documents", "text")]
    for coder in coders:
        whole = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [x.tolist() for x in coder.encode(texts)] == [x.ids for x in whole]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, (1 << 32) - 1), max_size=300), st.data())
def test_packing_bits_is_a_round_trip(bits, values, data):
    ids = np.array(values, np.uint32) & np.uint32((1 << bits) - 1)
    raw = packed_ids.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    a = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - a))
    assert packed_ids.unpack(raw, a, n, bits).tolist() == ids[a : a + n].tolist()


@pytest.mark.parametrize("bits", [16, 17])
def test_files_give_any_range(tmp_path, bits, monkeypatch):
    from pyarrow import fs

    monkeypatch.setattr(packed_ids, "BLOCK", 64)
    chance = np.random.default_rng(3)
    docs = [chance.integers(0, 1 << 16, n).astype(np.uint32) for n in (0, 5, 200, 1, 64, 63)]
    path = str(tmp_path / "x.ids")
    out = packed_ids.Writer(fs.LocalFileSystem().open_output_stream(path), bits)
    for k, ids in enumerate(docs):
        out.add(None if k == 1 else k, ids)
    out.close()
    file = packed_ids.Reader(fs.LocalFileSystem().open_input_file(path))
    names, starts = file.documents(0, 6)
    assert names == [0, None, 2, 3, 4, 5]
    assert [file.read(int(a), int(b - a)).tolist() for a, b in zip(starts, starts[1:])] == [d.tolist() for d in docs]
    assert file.read(100, 150).tolist() == np.concatenate(docs)[100:250].tolist()


def _expected_ids(docs, coder, end):
    start, out = 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = np.array([*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_packed_ids(spark, coders):
    docs = edge_rows()
    df = documents(spark, docs, path="x", ids=1).repartition(3)
    assert rows(packed_ids.id_report(df, queries.BYTE_BPE)) == _expected_ids(docs, coders[0], 0)
    assert packed_ids.id_report(df.limit(0), queries.BYTE_BPE).count() == 0


def test_packed_ids_query(spark, coders):
    got = rows(queries.op2_packed_ids(spark, SF))
    assert got == _expected_ids(sample("documents", "doc_id, text"), coders[0], 0)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            ok = True
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m[0].split("."))
            if kind == "card":
                twice = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
                ok = 14 <= len(digits) <= 19 and (sum(twice) + sum(digits[-1::-2])) % 10 == 0
            if kind == "phone":
                ok = 10 <= len(digits) <= 15
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(BASE).index(s[0])))


PIECES = ["a", "b.c", "@", ".", "-", "+", " ", "(", ")", "1", "23", "456", "0", "4111 1111 1111 1111", "10.0.0.255", "256.1.1.1", "x@y.zz", "_", "%", "+1 (555) 010-9999", "é", "DE89370400440532013000"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert [s for s in personal_data.spans(text) if s[0] in personal_data.BASE] == plain_spans(text)


def test_long_runs_take_linear_time():
    for c in ("a", "1", "1.", "+", "a@", "@", "- ", "+1 "):
        personal_data.spans(c * 200_000)


def test_words_against_a_span_do_not_unmask_it(spark):
    at = lambda text: personal_data.score(text, *personal_data.spans(text)[0])
    assert [at(f"{w} 10.20.30.40 is it") for w in ("section", "Versions", "chapter", "intersection", "conversion", "of")] == [0.4, 0.4, 0.4, 0.6, 0.6, 0.6]
    assert at("section of the server 10.20.30.40") == 0.5 and at("a ship 10.20.30.40") == 0.6
    assert at("inter" + "section".ljust(40) + "10.20.30.40") == 0.6 and at("an " + "section".ljust(40) + "10.20.30.40") == 0.4
    assert at("10.20.30.40" + "section".rjust(40)) == 0.4 == at("10.20.30.40" + "section".rjust(40) + " a")
    assert at("10.20.30.40" + "section".rjust(40) + "al") == 0.6 == at("10.20.30.40" + "section".rjust(41))
    least = min(personal_data.SCORES[k] - 20 for k in personal_data.KINDS) / 100
    assert least == corpus_pipeline.LEAST_SCORE
    df = documents(spark, [(1, "see section 10.20.30.40 there"), (2, "release 1.2.3.4"), (3, "at 1.2.3.4")])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.private_data(spark, df, SF).collect()}
    assert got == {1: "see section <IP> there", 2: "release <IP>", 3: "at <IP>"}


def test_personal_data_query(spark):
    docs = sample("documents", "doc_id, text")
    got = {r["doc_id"]: r for r in queries.op4_personal_data(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, text in docs:
        found = plain_spans(text or "")
        counts = Counter(k for k, _, _ in found)
        assert [got[d][f"n_{k}"] for k in BASE] == [counts[k] for k in BASE]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert got[d]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[d]["spans"].split(",")) | {""}


def test_personal_data_edges(spark):
    docs = [*edge_rows(), (20, "IBAN DE89 3704 0044 0532 0130 00, mail a@b.co"), (21, "DE89 3704 0044 0532 0130 01")]
    df = documents(spark, docs, found="x", spans=1)
    got = personal_data.span_report(df)
    assert got.count() == len(docs) and personal_data.span_report(df.limit(0)).count() == 0
    by_id = {r["doc_id"]: r for r in got.filter("doc_id >= 20").collect()}
    assert by_id[20]["n_iban"] == 1 and by_id[20]["n_email"] == 1 and by_id[21]["n_iban"] == 0
    masked = {r["doc_id"]: r for r in personal_data.mask_personal_data(df).collect()}
    assert masked[20]["text"] == "IBAN <IBAN>, mail <EMAIL>" and masked[20]["found"] == "x"
    assert masked[0]["text"] is None and masked[1]["text"] == ""


def test_overlapping_spans_are_masked_once():
    assert personal_data.mask("0123456789", [("card", 2, 6), ("phone", 4, 8), ("ip", 8, 9)]) == "01<CARD><IP>9"


def plain_stats(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abé\U0001f600 \n\t\x0b\x0c\r\x1c\x85#|"), max_size=60))
def test_counts_equal_the_plain_definition(text):
    assert quality_rules.count_text(text.encode())[:5] == plain_stats(text)


def test_quality_query(spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = dict(sample("documents", "doc_id, text"))
    got = queries.op10_quality_rules(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        expected = plain_stats(docs[r["doc_id"]] or "")
        assert tuple(r[n] for n in names) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_rules_hold_on_other_documents():
    """Learned on one half of the labelled documents, the list is precise on the
    other half and finds nearly all bad ones."""
    big = SF.replace("0.001", "0.1")
    known = duckdb.sql(f"select text, quality from '{big}/documents.parquet' join '{big}/labels.parquet' using (doc_id) order by doc_id").fetchall()
    counts = np.array([quality_rules.count_text((t or "").encode()) for t, _ in known], float)
    named = dict(zip(quality_rules.COUNTS, counts.T))
    data = {f: named[a] / np.maximum(named[b], 1) if b else named[a] for f, (a, b) in quality_rules.FEATURES.items()}
    bad = np.array([q == 0 for _, q in known])
    half = np.random.default_rng(0).random(len(bad)) < 0.5
    rules = quality_rules.learn({f: v[half] for f, v in data.items()}, bad[half])
    hit = rules.hits({f: v[~half] for f, v in data.items()})
    assert (bad[~half] & hit).sum() >= 0.98 * hit.sum() and (bad[~half] & hit).sum() >= 0.95 * bad[~half].sum()


def test_quality_edges(spark):
    df = documents(spark, edge_rows(), stats="x", kept=1, reason=2)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rules = quality_rules.fit(df, none)
    assert not rules.rules
    got = quality_rules.judge(df, rules)
    assert got.count() == len(edge_rows()) and got.filter("kept is null or base_failed is null").count() == 0
    kept = quality_rules.filter_quality(df, rules)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 6, 9, None}
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (None, 1), (9, 1), (99, 0)], "doc_id long, quality int")
    assert not quality_rules.fit(df, labels).rules
    assert quality_rules.judge(df.limit(0), rules).count() == 0


def test_learned_list_separates(spark):
    chance = np.random.default_rng(1)
    x, y = chance.random(6000), chance.random(6000)
    bad = (x > 0.7) & (y < 0.4) | (x < 0.1)
    rules = quality_rules.learn({"symbols": x, "upper": y}, bad)
    assert (rules.hits({"symbols": x, "upper": y}) == bad).mean() > 0.95


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    places = shard_shuffle.permute(np.arange(n), n, 5)
    assert sorted(places.tolist()) == list(range(n))
    assert shard_shuffle.permute(places, n, 5, back=True).tolist() == list(range(n))
    row = n // 2
    assert shard_shuffle.row_at(*shard_shuffle.locate(row, n, 4, 9), n, 4, 9) == row


def test_shards(spark):
    docs = edge_rows()
    got = shard_shuffle.shard_report(documents(spark, docs, shard="x", row_no="y").repartition(3), 4).collect()
    assert len(got) == len(docs)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) <= set(range(4))
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    expected = sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs if d is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == expected
    for r in got:
        assert (r["shard"], r["slot"]) == shard_shuffle.locate(r["row_no"], len(docs), 4, 20)
    assert shard_shuffle.shard_report(documents(spark, docs).limit(0)).count() == 0


def test_shard_query(spark):
    got = queries.op5_shard_shuffle(spark, SF).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
    assert {r["law"] for r in got} == {"rows"} and len({(r["shard"], r["slot"]) for r in got}) == len(got)


def test_mix_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cursor = con.execute(source_mix.MIX_SQL)
    names = [d[0] for d in cursor.description]
    got = queries.op7_source_mix(spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert rows(got.select(*names)) == sorted(cursor.fetchall(), key=repr)


def test_mix_meets_the_weights(spark):
    data = [(i, "x", "en", "big" if i % 10 else ("small" if i % 20 else None), 1) for i in range(6000)]
    df = spark.createDataFrame(data, DOCS)
    weights = spark.createDataFrame([("big", 1.0), ("small", 2.0), (None, 1.0), ("absent", 5.0)], "source string, weight double")
    counts = {r["source"]: r["count"] for r in source_mix.replicate(df, weights).groupBy("source").count().collect()}
    for source, share in (("big", 0.25), ("small", 0.5), (None, 0.25)):
        assert abs(counts[source] - share * 6000) < 5 * (share * 6000) ** 0.5 * 3
    only = source_mix.replicate(df, weights.filter("source = 'small'"), epochs=2.0)
    assert only.filter("source is null or source = 'big'").count() == 0 and 11_000 < only.count() < 13_000


def test_mix_large_rates(spark):
    df = documents(spark, [(i, "x") for i in range(30)])
    got = source_mix.replicate(df, epochs=200.0).groupBy("doc_id").count().collect()
    mean = sum(r["count"] for r in got) / 30
    assert len(got) == 30 and abs(mean - 200) < 15


def test_mix_edges(spark):
    df = documents(spark, edge_rows(), weight=3, rate="x")
    copies = source_mix.replicate(df, epochs=3.0)
    again = source_mix.replicate(df.repartition(5), epochs=3.0)
    assert rows(copies, "doc_id", "copy", "n_copies") == rows(again, "doc_id", "copy", "n_copies")
    mixed = source_mix.mix(df, epochs=3.0)
    assert mixed.columns == df.columns and mixed.count() == copies.count()
    assert source_mix.mix(df.limit(0)).count() == 0 and source_mix.mix_report(df.limit(0)).count() == 0


def check_packing(got, docs, coder):
    """Every id lies in one piece, sequences have no gaps and fit their window."""
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        per_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        per_sequence[r["sequence_id"]].append(r)
    for parts in per_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= parts[0]["window"] <= 2048 and len({(r["window"], r["step_id"]) for r in parts}) == 1
    expected = Counter()
    for d, t in docs:
        ids = np.array([*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for a in range(0, len(ids), 2048):
            part = ids[a : a + 2048]
            expected[(d, a, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == expected


def test_packing_query(spark, coders):
    got = queries.op8_window_packing(spark, SF).collect()
    check_packing(got, sample("documents", "doc_id, text"), coders[1])


def test_packing_edges(spark, coders):
    docs = edge_rows()
    df = documents(spark, docs, length="x", deal=1, window=2)
    check_packing(window_packing.pack_documents(df, queries.WORD_BPE).collect(), docs, coders[1])
    assert window_packing.pack_documents(df.limit(0), queries.WORD_BPE).count() == 0


def test_packing_wastes_little_and_steps_are_equal():
    chance = np.random.default_rng(2)
    lengths = np.concatenate([chance.integers(1, 2049, 3000), chance.integers(1, 300, 6000), np.full(500, 2048)])
    window, offset, size = window_packing.fill(lengths)
    used = Counter()
    for w, n in zip(window.tolist(), lengths.tolist()):
        used[w] += n
    capacity = dict(zip(window.tolist(), size.tolist()))
    assert all(used[w] <= capacity[w] for w in used)
    assert sum(lengths) >= 0.995 * sum(capacity.values())
    assert all(used[w] == n for w, n in capacity.items() if n < 2048)
    assert len(set(capacity.values())) > 1


def test_prose_helper_is_stable():
    assert prose(1, 3) == prose(1, 3)


def test_packing_encodes_a_bounded_stretch_and_gives_memory_back(monkeypatch):
    """Workers live on for later stages, so neither a batch's size nor what the
    allocators keep may add up."""

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, fields):
            return run

    seen, back = [], []

    class Counting:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return [np.zeros(len(t) // 4, np.uint32) for t in texts]

    class Task:
        @staticmethod
        def get():
            return Task

        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(window_packing, "encoder", lambda path: Counting())
    monkeypatch.setattr(pyspark, "TaskContext", Task)
    monkeypatch.setattr(window_packing.F, "col", lambda name: SimpleNamespace(cast=lambda kind: SimpleNamespace(alias=lambda name: name)))
    monkeypatch.setattr(common, "give_back", lambda: back.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(range(64), pa.int64()), pa.array(["x" * (1 << 17)] * 64)], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(window_packing.pieces(Docs(), "", 1, most=corpus_pipeline.TEXT_BYTES)([batch])))
    assert sum(seen) == 64 << 17 and max(seen) <= 2 << 20
    assert out.num_rows == 64 * 17 and sum(out.column("length").to_pylist()) == 64 * ((1 << 15) + 1)
    assert back == [1]
    assert list(common.cells(pa.array([1, None, 3, 4, 5]), 2)) == [1, None, 3, 4, 5]
