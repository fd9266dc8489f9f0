"""Phrases, byte-level merges and links between tokenizers, against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martkit.llm import byte_merges, phrases, queries, token_links, words
from martkit.llm.common import for_workers
from tests.conftest import rows
from tests.llm.helpers import DOCS, SF, documents, edge_rows, prose, sample

PARTS = [*"ab éÉ1½.,'#_\n\t\r \x85\xa0\x01\x1c<|>　漢😀▁", "'ll", "  ", "\n\n", "the ", " the", "a" * 70, "<s>", "<|endoftext|>", "word. ", " .", "x,y"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=25).map("".join)


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    for_workers(spark)


# --- pieces -------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_spell_out_the_text(text):
    if text:
        for marks in (False, True):
            assert "".join(words.literal(p, marks) for p in words.pieces_of(text, marks)) == " " + text
        assert "".join(words.literal(p) for p in words.first_pieces(text)) == text


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_slices_lose_only_spaces(text, most):
    parts = list(words.slices_of(text, most))
    assert " ".join(parts) == text and all(not p[-1:].isspace() for p in parts[:-1])


# --- op11 ---------------------------------------------------------------------


def collocations(docs, least, top=2000, cover=80):
    """Rows of the report from plain counting; docs are (lang, text)."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lower):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        some = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        gone = {p[i : i + k] for p, n in some.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * n >= cover * f[p[i : i + k]]}
        scored = []
        for p, a in some.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out, key=repr)


def few_words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(["a", "B", "the", "é", "Çx", "und"]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\x0b"]) for _ in range(n))


def test_phrases_equal_plain_counting(spark, monkeypatch):
    texts = [few_words(k % 40, 300) for k in range(60)] + ["the a the a " * 30_000, "z " * 9000, None, "", " .\n", "no end"]
    docs = [(k, t, (None, "en", "und")[k % 3], "s", 0) for k, t in enumerate(texts)] * 2
    df = spark.createDataFrame(docs, DOCS)
    want = collocations([(d[2], d[1]) for d in docs], 30)
    assert rows(phrases.collocations(df)) == want and len(want) > 30
    # Short chunks, forced ends, a filter that is full, a top that cuts ties.
    for name, value in (("MEAN", 3), ("LONGEST", 8), ("FILTER_BITS", 1 << 16), ("COUNTED", 5000)):
        monkeypatch.setattr(phrases, name, value)
    assert rows(phrases.collocations(df, top=7)) == collocations([(d[2], d[1]) for d in docs], 30, 7)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6), st.integers(1, 6), st.integers(2, 9))
def test_chunks_hold_each_phrase_once(texts, mean, longest):
    pieces = [p for p in map(phrases.pieces_of, texts) if p]
    found, want = Counter(), Counter()
    for k, chunk in phrases.parse(pieces, mean, longest) if pieces else []:
        w = chunk.split(b" ")
        for size in range(1, 5):
            grams = (tuple(w[i : i + size]) for i in range(len(w) - size + 1) if i + size > phrases.OVERLAP)
            found.update((k, g) for g in grams if b"\n" not in g)
    for k, parts in enumerate(pieces):
        for part in parts:
            w = [x for x in part.split(b" ") if x]
            for size in range(1, 5):
                want.update((k, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    assert found == want


def test_phrases_of_the_sample_equal_sql(spark):
    found = queries.op11_phrases(spark, SF)
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = duck.sql(queries.ORACLE_SQL["op11_phrases"])
    assert found.columns == want.columns and rows(found) == sorted(want.fetchall(), key=repr)


def test_scores_pass_64_bits(spark, monkeypatch):
    large = 9_000_000_000_000
    held = [("en", "a", 1, large + 5), ("en", "b", 1, large + 7), ("en", "a b", 2, large)]
    frequent = spark.createDataFrame(held, "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 3 * large)], "lang string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda docs, least: (frequent, totals))
    want = 2000000 * large // (2 * large + 12)
    assert rows(phrases.collocations(None)) == [("en", 1, "a b", large, large + 5, large + 7, 3 * large, want)]


def test_phrases_of_odd_tables(spark):
    assert phrases.collocations(documents(spark, edge_rows(), rank=1, phrase="x", n=2)).count() >= 0
    assert phrases.collocations(documents(spark, edge_rows()).limit(0)).count() == 0


# --- op12 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(queries.BYTE_RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_merges.Coder(queries.BYTE_RANKS, public_tokenizers.PATTERN, most=60, kept=10)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_merges_equal_the_library(coder, library, text):
    ids = coder.encode_text(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcdehinorst'", min_size=1, max_size=64).map(str.encode), min_size=1, max_size=20))
def test_a_forest_merges_as_a_tree(coder, some):
    ids, counts = byte_merges.merge_forest(some, 64, coder.vocabulary)
    each = [byte_merges.merge_long(w, coder.vocabulary) for w in some]
    assert counts.tolist() == list(map(len, each)) and ids.tolist() == [i for e in each for i in e]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 128, 129, 3000])
def test_long_words_equal_the_library(coder, library, n):
    rng = random.Random(n)
    for text in ("a" * n, "".join(rng.choice("abcde") for _ in range(n)), "漢" * n):
        assert coder.encode_text(text).tolist() == library.encode_ordinary(text)


def _merged(docs, library):
    out = []
    for d, t in docs:
        ids = library.encode_ordinary(t or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_reports_of_merges(spark, library, monkeypatch):
    assert rows(queries.op12_byte_merges(spark, SF)) == _merged(sample("documents", "doc_id, text"), library)
    docs = edge_rows() + [(40, "  lead"), (41, "trail \n"), (42, "<|endoftext|> x")]
    report = lambda df: byte_merges.merge_report(df, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert rows(report(documents(spark, docs, n_tokens=7, ids_sha256="x"))) == _merged(docs, library)
    assert report(documents(spark, docs).limit(0)).count() == 0


def test_a_text_in_slices_has_the_same_ids(coder, library):
    text = prose(5, 3000) + "  x \n " + prose(6, 2000)
    small = words.Pieces()
    for n, part in enumerate(words.slices_of(text, 500)):
        small.add(words.runs_of(part) if n else words.first_runs(part))
    assert coder.encode(small)[0].tolist() == library.encode_ordinary(text)


# --- op13 ---------------------------------------------------------------------


def links(docs):
    """Rows of the report from whole texts, by the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(queries.BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    a.encode_special_tokens = True
    letters = token_links._byte_letters()
    seen, held = Counter(), []
    for d, t in docs:
        raw = (" " + (t or "")).encode()
        ids = [a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)] if t else [[], []]
        spelled = [[bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], []]
        for i in ids[1]:
            p = b.id_to_piece(i)
            spelled[1].append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode())
        groups = []
        if t and b"".join(spelled[0]) == raw == b"".join(spelled[1]):
            x, y, m, n = [], [], 0, 0
            todo = [list(zip(i, s)) for i, s in zip(ids, spelled)]
            while todo[0] or todo[1]:
                side = 0 if m <= n and todo[0] else 1
                i, s = todo[side].pop(0)
                if side == 0:
                    x.append(i)
                    m += len(s)
                else:
                    y.append(i)
                    n += len(s)
                if m == n:
                    groups.append((x, y))
                    x, y = [], []
        pairs = [(i, j) for x, y in groups for i in x for j in y]
        seen.update(set(pairs))
        held.append((d, groups, pairs))
    best = {}
    for (i, _), n in seen.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for d, groups, pairs in held:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        counts = [len(groups) and sum(len(g[k]) for g in groups) for k in (0, 1)]
        n_best = sum(seen[p] == best[p[0]] for p in pairs)
        out.append((d, *counts, len(groups), len(pairs), n_best, sum(seen[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def test_reports_of_links(spark, monkeypatch):
    assert rows(queries.op13_token_links(spark, SF)) == links(sample("documents", "doc_id, text"))
    rng = random.Random(3)
    odd = [(100 + k, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))) for k in range(150)]
    docs = edge_rows() + odd + [(90, "a ▁ b"), (91, " lead"), (92, "trail \n\n"), (93, " "), (94, "\n"), (95, "")] * 2
    report = lambda df: token_links.link_report(df, queries.BYTE_BPE, queries.PIECE_BPE)
    assert rows(report(documents(spark, docs, n_a=7, block=1, pairs="x"))) == links(docs)
    assert report(documents(spark, docs).limit(0)).count() == 0
    # Nothing to link at all.
    assert rows(report(documents(spark, [(1, None), (2, "▁")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.fixture(scope="module")
def alone():
    return token_links.Aligner(queries.BYTE_BPE, queries.PIECE_BPE, most=80, kept=10)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_blocks_equal_whole_texts(alone, texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    block = token_links._block(alone, 0, batch).to_pydict()
    want = links(list(enumerate(texts)))
    columns = [block[c][0] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests")]
    assert sorted(zip(*columns), key=repr) == [(*r[:5], r[7]) for r in want]


def test_packed_numbers_round_trip():
    import numpy as np

    for values in ([], [0], [5, 1 << 31, 7], list(range(1000))):
        assert token_links._unpacked(token_links._packed(np.array(values, np.int64))).tolist() == values
