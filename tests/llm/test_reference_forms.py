"""Each operator against a brute-force form of it, on whole small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash

from planact.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name, sf=SF):
    return queries.QUERIES[name](spark, sf).collect()


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Every document's smallest reachable one, by looking at all pairs until nothing changes."""
    ids = sorted(prints)
    component = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= 3 and component[a] < component[b]:
                    component[b], changed = component[a], True
    return component


def test_near_duplicates_stage_of_the_pipeline(spark, documents):
    """One document of each group stays, whole and unchanged."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    component = plain_components({d: plain_fingerprint(t) for d, t in documents.items()})
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, table, SF)
    assert kept.columns == table.columns
    assert {r.doc_id: r.text or "" for r in kept.collect()} == {d: t for d, t in documents.items() if component[d] == d}


def test_simhash(spark, documents):
    prints = {d: plain_fingerprint(t) for d, t in documents.items()}
    ids = sorted(prints)
    component = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op5_simhash")}
    assert got == {d: (f"{prints[d]:016x}", component[d]) for d in ids}
    assert len(set(component.values())) < len(ids)


def test_packing_covers_every_id_once(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op3_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length, r.padded_length))
    assert pieces.keys() == documents.keys()
    for doc_id, text in documents.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and {p for *_, p in parts} == {at if at & (at - 1) == 0 else 1024}
        used, padded = used + at, padded + parts[0][2]
    assert used / padded > 0.98


def plain_base(text):
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def check_secrets(row, text):
    base = plain_base(text)
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in base)
    assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert not set(filter(None, listed.split(","))) - set(row.spans.split(","))


def test_secrets(spark, documents):
    got = run(spark, "op7_secrets", "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert {r.doc_id for r in got} == texts.keys() and len(got) == len(texts)
    assert sum(r.n_assign + r.n_access for r in got) > 10
    for r in got:
        check_secrets(r, texts[r.doc_id] or "")


def test_sentence_spans(spark, documents):
    """Every run of the removed text occurs before; what is left has no repeated run."""
    from planact.llm import sentence_spans as s

    def runs(texts):
        found = defaultdict(list)
        for doc_id, text in texts.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            for _, h1, h2, start, end in s.runs_of(raw, np.array([0, len(raw)])):
                for a, b, x, y in zip(h1.tolist(), h2.tolist(), start.tolist(), end.tolist()):
                    found[a, b].append((doc_id, x, y))
        return found

    covered = defaultdict(set)
    for places in runs(documents).values():
        for doc_id, start, end in sorted(places)[1:]:
            covered[doc_id].update(range(start, end))
    got = {r.doc_id: r for r in run(spark, "op10_sentence_spans")}
    assert got.keys() == covered.keys() and got
    for doc_id, places in covered.items():
        raw = documents[doc_id].encode()
        assert got[doc_id].text == bytes(b for i, b in enumerate(raw) if i not in places).decode()
        text = documents[doc_id]
        removed = "".join(text[p.start : p.end] for p in got[doc_id].removed)
        assert len(removed) == got[doc_id].removed_chars
    # Equal hashes mean equal words.
    for places in runs(documents).values():
        assert len({" ".join(documents[d].encode()[a:b].lower().decode().split()) for d, a, b in places}) == 1


def test_warc(spark):
    import base64

    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    first = {}
    for page_id in sorted(pages):
        first.setdefault(pages[page_id], page_id)
    want = {
        (
            p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
            "response" if first[b] == p else "revisit", None if first[b] == p else first[b],
        )
        for p, b in pages.items()
    }
    assert {tuple(r) for r in run(spark, "op2_warc")} == want


def test_hamming_search_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], float)
    got = defaultdict(list)
    for r in sorted(run(spark, "op8_hamming_search", sf), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    queries_ = ids[ids % 20 == 0]
    assert got.keys() == set(queries_.tolist())
    hits = 0
    at = {i: n for n, i in enumerate(ids.tolist())}
    for q in queries_.tolist():
        scores = vectors @ vectors[at[q]]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits += len({int(ids[i]) for i in best} & {v for v, _ in got[q]})
        assert len(got[q]) == 20 and q not in dict(got[q])
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        assert np.allclose([s for _, s in got[q]], [scores[at[v]] for v, _ in got[q]], rtol=0, atol=1e-12)
    assert hits / (20 * len(queries_)) >= 0.9


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = run(spark, "op4_toxicity", sf)
    n_docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == n_docs
    right = total = caught = toxic = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            total, right = total + 1, right + (labels[r.doc_id] == r.predicted)
            toxic, caught = toxic + labels[r.doc_id], caught + (labels[r.doc_id] and r.predicted)
    assert right / total > 0.97 and caught / toxic > 0.9


def test_language_of_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = run(spark, "op6_language_id", sf)
    assert sum(r.language == r.declared for r in got) / len(got) > 0.99
    assert sum(r.accepted for r in got) / len(got) > 0.995


def test_decontamination_finds_whole_items(spark):
    sf = "/root/testdata/sf0.1"
    fold = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    docs = {r.doc_id: f" {fold(r.text)} " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: f" {fold(r.text)} " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    got = {(r.doc_id, r.item_id) for r in run(spark, "op1_decontamination", sf)}
    assert whole and whole <= got
    # What else is found holds at least a third of the item's words in its order.
    for d, i in got - whole:
        words = items[i].split()
        assert any(" ".join(words[k : k + len(words) // 3]) in docs[d] for k in range(len(words) * 2 // 3 + 1))
