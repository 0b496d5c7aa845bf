"""Exact dedup, lexical search and the Merkle manifest against plain Python, on whole small tables and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_edges import DOCUMENTS, SCHEMA, benchmark, documents  # noqa: F401

from planact.llm import exact_dedup, lexical_search, merkle_manifest, queries

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- exact dedup ----------------------------------------------------------------------


@pytest.mark.parametrize("n, width", [(1, 1), (1, 1 << 38), (5, 5), (1000, 4096), (300, 1 << 38)])
def test_golomb_round_trip(n, width):
    values = np.unique(np.random.default_rng(n).integers(0, width, n))
    k, code = exact_dedup.golomb(values, width)
    assert (exact_dedup.ungolomb(len(values), k, code) == values).all()
    assert len(code) * 8 <= len(values) * (max(0, math.log2(width / len(values))) + 3) + 8


def plain_groups(data):
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[text or ""].append(doc_id)
    return groups


def test_exact_dedup_of_documents(spark):
    data = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op11_exact_dedup"](spark, SF).collect()}
    assert len(got) == len(data)
    groups = plain_groups(data)
    assert any(len(ids) > 1 for ids in groups.values())
    for text, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(ids), len(ids), i == max(ids), sha(text))


@pytest.mark.parametrize("settings", [{}, {"print_bits": 5, "bucket_bits": 2, "block_rows": 3}, {"block_rows": 1}, {"block_bytes": 1}])
def test_exact_dedup_of_odd_rows(spark, documents, settings):  # noqa: F811
    """Short prints collide: the bytes decide. Blocks of one row put nothing together by themselves."""
    docs = documents.repartition(3)
    found = exact_dedup.exact_duplicates(docs, **settings).collect()
    groups = plain_groups([d[:2] for d in DOCUMENTS])
    by_sha = {sha(t): ids for t, ids in groups.items()}
    assert len(found) == len(DOCUMENTS)
    for r in found:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(list(by_sha))
    kept = exact_dedup.deduplicated(docs, **settings)
    assert kept.columns == docs.columns
    assert rows(kept.select("doc_id")) == rows(spark.createDataFrame([(1,), (2,), (4,), (5,), (6,), (7,), (8,)], "doc_id long"))
    assert exact_dedup.exact_duplicates(docs.limit(0), **settings).count() == 0


def test_exact_dedup_after_a_change(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B "), (3, None), (None, "a b")], "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, normal=lambda c: F.trim(F.lower(c)))
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(
        [(1, 2, 3, False, sha("a b")), (2, 2, 3, True, sha("a b")), (3, 3, 1, True, sha("")), (None, 2, 3, False, sha("a b"))], key=repr
    )


# --- lexical search -------------------------------------------------------------------


def plain_terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def plain_search(docs, items, top=10):
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    found = []
    for item, text in items:
        scored = []
        for d, c in counts:
            if c:
                m = 10 + (90 * sum(c.values()) * n_docs) // total
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in set(plain_terms(text))
                    if c[w]
                )
                if score > 0:
                    scored.append((-score, d is None, d or 0, d))
        found += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(found, key=repr)


def test_search_of_benchmark_items(spark):
    docs = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    found = queries.QUERIES["op12_lexical_search"](spark, SF)
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(docs, items)


@pytest.mark.parametrize("short", [0.0, 0.02, 0.2, 1.0])
def test_best_of_a_shard(short):
    """All mixtures of accumulators and skipped lists find what scoring every document finds, ties included."""
    rng = np.random.default_rng(7)
    size, terms = 3000, 24
    lists = {}
    for t in range(terms):
        docs = np.flatnonzero(rng.random(size) < rng.choice([0.001, 0.01, 0.1, 0.6]))
        if len(docs):
            lists[t] = (docs, rng.integers(0, rng.choice([3, 50, 400]), len(docs)))
    shard = lexical_search.Shard.__new__(lexical_search.Shard)
    shard.size, shard.lists = size, lists
    for _ in range(60):
        asked = rng.choice(terms + 3, rng.integers(1, 12), replace=False).tolist()
        total = np.zeros(size, np.int64)
        for t in asked:
            if t in lists:
                total[lists[t][0]] += lists[t][1]
        expected = sorted(((int(-s), d) for d, s in enumerate(total) if s > 0))[:10]
        assert lexical_search.best_of(shard, asked, 10, short) == [(-s, d) for s, d in expected]


def test_search_of_odd_rows(spark, documents, benchmark):  # noqa: F811
    items = benchmark.select("item_id", "text", F.lit(1).alias("rank")).unionByName(
        spark.createDataFrame([(9, "Ships, HARBOUR über ships"), (10, "... !"), (11, "nowhere")], "item_id long, text string").withColumn("rank", F.lit(2))
    )
    extra = spark.createDataFrame([(20, "Über ships"), (21, "ÜBER Ships"), (22, "ships"), (23, "ships"), (None, "ships")], "doc_id long, text string")
    docs = documents.unionByName(extra, allowMissingColumns=True)
    plain = plain_search([d[:2] for d in DOCUMENTS] + [tuple(r) for r in extra.collect()], [(r.item_id, r.text) for r in items.collect() if r.text])
    for settings in ({}, {"vocabulary_bytes": 100}, {"shard_postings": 3, "short": 0.5}, {"short": 1.0}):
        found = lexical_search.search(docs, items, **settings)
        assert rows(found, "item_id", "rank", "doc_id", "score") == plain
    assert {p[0] for p in plain} >= {1, 9} and {p[0] for p in plain}.isdisjoint({10, 11, None})
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


# --- Merkle manifest ------------------------------------------------------------------


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climbed(hashes):
    """(root, [siblings of every leaf as (digest, is left)])"""
    paths, places, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for path, n in zip(paths, range(len(paths))):
            other = places[n] ^ 1
            path.append((level[other], other < places[n]) if other < len(level) else ("", False))
            places[n] >>= 1
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def plain_manifest(data):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in data:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        some = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees.append((some, *climbed([leaf_of(*r) for r in some])))
    root, above = climbed([t[1] for t in trees])
    found = []
    for (some, subroot, paths), up in zip(trees, above):
        for r, path in zip(some, paths):
            leaf = leaf_of(*r)
            marked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            folded = leaf_of(*r[:3], r[3] + 1, r[4]) if marked else leaf
            for other, left in path + up:
                folded = sha(other + folded if left else folded + other)
            proof = sha("".join(d for d, _ in path + up))
            found.append((r[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_of_documents(spark):
    data = [tuple(r) for r in table(spark, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = rows(queries.QUERIES["op13_merkle_manifest"](spark, SF), *MANIFEST)
    assert found == plain_manifest(data)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("settings", [{}, {"step": 1}, {"step": 2, "split": 2, "broadcast_bytes": 0}, {"step": 3, "split": 5, "broadcast_bytes": 0}])
def test_manifest_of_odd_rows(spark, documents, settings):  # noqa: F811
    """Null groups, ids and fields, groups of one, repeated rows; every step and both ways of joining."""
    more = [(i, f"t{i}", None if i % 3 else "xx", "s", None if i % 5 == 0 else 2**63 - 1, "x") for i in range(100, 140)]
    docs = documents.unionByName(spark.createDataFrame(more, SCHEMA), allowMissingColumns=True)
    data = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    claimed = [*fields[:3], F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars").cast("decimal(20)") + 1).otherwise(
        F.col("n_chars").cast("decimal(20)")), fields[4]]
    found = merkle_manifest.verified(docs.repartition(3), fields, claimed, "doc_id", "lang", **settings)
    found = found.select("id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256), "folded_root", "verified")
    assert rows(found) == plain_manifest(data)
    assert merkle_manifest.verified(docs.limit(0), fields, fields, "doc_id", "lang", **settings).count() == 0
    one = merkle_manifest.verified(docs.where("doc_id = 6"), fields, fields, "doc_id", "lang", **settings).collect()
    assert len(one) == 1 and one[0].verified and one[0].subroot == one[0].root == one[0].leaf and not one[0].proof
