"""Small tables and brute-force versions for the corpus operators."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sample(table: str, columns: str = "*", sf: str = SF) -> list[tuple]:
    return duckdb.sql(f"select {columns} from '{sf}/{table}.parquet'").fetchall()


def documents(spark, rows, **more):
    """A documents table of (doc_id, text) rows, with extra columns of clashing
    names where ``more`` gives them."""
    full = [(d, t, "en", f"src{(d or 0) % 3}", None if t is None else len(t)) for d, t in rows]
    df = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F

    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls, empty and white texts, ties, repeated rows, one very long text."""
    long = prose(1, 40_000)
    same = prose(2, 120)
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, same), (4, same), (4, same), (5, "one two three"), (6, long),
        (7, "a" * 3000), (8, "éß " * 200), (9, same + " more"), (None, same), (None, None), (10, "line\n" * 90),
    ]


def repeats(docs, length: int = 400) -> dict:
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per row, by every window."""
    raws = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(hashlib.blake2b(r[i : i + length], digest_size=12).digest() for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[hashlib.blake2b(r[i : i + length], digest_size=12).digest()] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((d, len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def jaccard_groups(docs, threshold: float = 0.8, words: int = 5) -> list[tuple]:
    """(doc_id, n_links, component_id) by comparing every pair of shingle sets."""
    sets = []
    for d, t in docs:
        w = (t or "").encode().split()
        grams = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
        sets.append((d, grams if d is not None else set()))
    return _groups(sets, lambda a, b: a and b and len(a & b) >= threshold * len(a | b))


def cosine_groups(rows, threshold: float = 0.9) -> list[tuple]:
    import numpy as np

    def unit(v):
        if not v or None in v:
            return None
        x = np.array(v, float)
        if not np.isfinite(x).all() or not x.any():
            return None
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    vectors = [(i, unit(v) if i is not None else None) for i, v in rows]
    ok = lambda a, b: a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold
    return _groups(vectors, ok)


def _groups(items, linked) -> list[tuple]:
    n = len(items)
    near = defaultdict(set)
    for i in range(n):
        for j in range(i + 1, n):
            if linked(items[i][1], items[j][1]):
                near[i].add(j)
                near[j].add(i)
    out, root = [], {}
    for i in range(n):
        if i not in root:
            group, todo = {i}, [i]
            while todo:
                for k in near[todo.pop()] - group:
                    group.add(k)
                    todo.append(k)
            for k in group:
                root[k] = items[i][0] if len(group) == 1 else min(items[g][0] for g in group)
        out.append((items[i][0], len(near[i]), root[i]))
    return sorted(out, key=repr)
