"""The registered queries over the whole sf0.001 tables, digests included, and the
pipeline, all against plain Python written from the queries' contracts."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sparkmart.llm import bpe, quality, queries, secrets

SF_DIR = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
BASE = (("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
        ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0))


def _rows(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def _by_id(df, key="doc_id"):
    rows = df.collect()
    got = {r[key]: r for r in rows}
    assert len(got) == len(rows)
    return got


def _components(near, ids):
    """Smallest id reachable through a matrix of links."""
    comp = np.array(ids)
    while True:
        least = np.minimum(comp, np.array([comp[row].min(initial=comp.max()) for row in near]))
        if (least == comp).all():
            return comp.tolist()
        comp = least


def _contamination(docs):
    """doc_id -> (words, hit words, sorted items) by comparing every window."""
    split = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for r in _rows("benchmark"):
        w = split(r["text"])
        n = min(13, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[j:j + n]), set()).add(str(r["item_id"]))
    sizes, out = {len(k) for k in windows}, {}
    for r in docs:
        w, hit, items = split(r["text"]), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                found = windows.get(tuple(w[j:j + n]))
                if found:
                    hit.update(range(j, j + n))
                    items |= found
        out[r["doc_id"]] = (len(w), len(hit), sorted(items))
    return out


def _fingerprint(text):
    w = (text or "").translate(LOWER).encode().split()
    k = min(4, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[j:j + k]), 42) for j in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _simhash(docs):
    """doc_id -> (fingerprint, component) by comparing all pairs."""
    ids, prints = [r["doc_id"] for r in docs], [_fingerprint(r["text"]) for r in docs]
    u = np.array(prints, np.uint64)
    return dict(zip(ids, zip(prints, _components(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4, ids), strict=True), strict=True))


def _encode(tokenizer, text):
    ids = tokenizer.encode_ordinary(text)
    return len(ids), _sha(",".join(map(str, ids))), _sha(tokenizer.decode_bytes(ids))


@pytest.fixture(scope="module")
def docs():
    return _rows("documents")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.encoding(public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN)


def test_op1(spark, docs):
    got, want = _by_id(queries.op1_decontamination(spark, SF_DIR)), _contamination(docs)
    assert set(got) == set(want) and any(hit for _, hit, _ in want.values())
    for i, (words, hit, items) in want.items():
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (words, hit, len(items), _sha(",".join(items)))
        assert r.contaminated == (hit > 0 and 20 * hit >= words)


def test_op5(spark, docs):
    got = _by_id(queries.op5_secrets(spark, SF_DIR))
    assert len(got) == len(docs)
    for d in docs:
        text, base = d["text"] or "", []
        for k, (kind, pattern, least, group) in enumerate(BASE):
            base += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        r, base = got[d["doc_id"]], sorted(base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]
        told = [f"{BASE[k][0]}:{a}:{z}" for a, k, z in base]
        assert r.base_sha256 == _sha(",".join(told))
        listed = [s for s in r.spans.split(",") if s]
        assert [s for s in listed if s.split(":")[0] in ("assign", "access", "hex")] == told
        assert [int(s.split(":")[1]) for s in listed] == sorted(int(s.split(":")[1]) for s in listed)


def test_op6(spark):
    rows = _rows("embeddings")
    vector = next(k for k in rows[0] if isinstance(rows[0][k], list))
    x = [np.array(r[vector] if r[vector] is not None else [], float) for r in rows]
    size = max(map(len, x))
    good = np.array([len(v) == size and bool(np.isfinite(v).all()) and bool(v.any()) for v in x])
    m = np.stack([v if ok else np.zeros(size) for v, ok in zip(x, good, strict=True)])
    n = np.where(good, np.sqrt((m * m).sum(axis=1)), 1.0)
    near = (m @ m.T / (n[:, None] * n) >= 0.9) & good[:, None] & good
    np.fill_diagonal(near, False)
    ids = [r["vec_id"] for r in rows]
    got = _by_id(queries.op6_embedding_dedup(spark, SF_DIR), "vec_id")
    for i, links, comp in zip(ids, near.sum(axis=1).tolist(), _components(near, ids), strict=True):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links, comp, i == comp)


def test_op7(spark, docs, tokenizer):
    got = _by_id(queries.op7_byte_bpe(spark, SF_DIR))
    for d in docs:
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _encode(tokenizer, d["text"] or "")
        assert r.decoded_sha256 == _sha(d["text"] or "")


def test_op8(spark, docs):
    got = _by_id(queries.op8_lm_scoring(spark, SF_DIR))
    tokens = {d["doc_id"]: re.findall("[^\x20\x09-\x0D]+", (d["text"] or "").translate(LOWER)) + [None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = {}
    for i, w in tokens.items():
        for t in () if held[i] else w:
            count[t] = count.get(t, 0) + 1
    total = sum(count.values())
    for i, w in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(t in count for t in w), total)
        assert r.base_score == pytest.approx(sum(np.log10((count.get(t, 0) + 1) / (total + len(count) + 1)) for t in w))
        assert np.isfinite(r.score) and r.score <= 0
    # the model must beat the base where it has not learned
    assert sum(got[i].score for i in held if held[i]) > sum(got[i].base_score for i in held if held[i])


def test_op9(spark, docs):
    got, want = _by_id(queries.op9_simhash(spark, SF_DIR)), _simhash(docs)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{f:016x}", c) for i, (f, c) in want.items()}


@pytest.mark.parametrize("query,label,folds,fold,threshold", [("op2_toxicity", "toxic", 5, 0, 0.5), ("op10_quality", "quality", 4, 2, 0.7)])
def test_op2_op10(spark, query, label, folds, fold, threshold):
    sf_dir = "/root/testdata/sf0.01"
    got = _by_id(getattr(queries, query)(spark, sf_dir))
    marks = {r["doc_id"]: r[label] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % folds == fold) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got.values())
    held = [(r.predicted, marks[i]) for i, r in got.items() if r.held_out and marks.get(i) is not None]
    assert len(held) > 20 and sum(p == y for p, y in held) >= 0.95 * len(held)


def test_pipeline(spark, docs, tokenizer):
    """Stage by stage: the classifier's own scores, then brute force."""
    scores = _by_id(queries.op10_quality(spark, SF_DIR))
    left = [d for d in docs if scores[d["doc_id"]].score >= quality.THRESHOLD]
    assert 0 < len(left) < len(docs)
    groups = _simhash(left)
    left = [d for d in left if groups[d["doc_id"]][1] == d["doc_id"]]
    found = _contamination(left)
    left = [d for d in left if not (found[d["doc_id"]][1] and 20 * found[d["doc_id"]][1] >= found[d["doc_id"]][0])]
    want = {}
    for d in left:
        text, out, at, end = d["text"] or "", [], 0, -1
        spans = sorted((m.start(), m.end()) for r in secrets.RULES for m in re.finditer(r.pattern, text)
                       if m.end(r.group) - m.start(r.group) >= r.least)
        for a, z in spans:
            if a >= end:
                out += [text[at:a], "[secret]"]
            at = end = max(end, z)
        want[d["doc_id"]] = _encode(tokenizer, "".join(out) + text[at:])
    got = _by_id(corpus_pipeline.run(spark, SF_DIR))
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in got.items()} == want
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "byte_bpe"]


def test_pipeline_stages_keep_columns(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, table.limit(40), SF_DIR)
        assert kept.schema.names == table.schema.names
        assert stage(spark, table.where("false"), SF_DIR).count() == 0


def test_op11(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = sorted(queries.op11_packing(spark, SF_DIR).collect(), key=lambda r: (r.doc_id, r.start))
    want = []
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for n in [2048] * (len(ids) // 2048) + [1 << b for b in range(10, -1, -1) if len(ids) % 2048 >> b & 1]:
            want.append((d["doc_id"], at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), 0))
            at += n
    assert [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in rows] == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))


def test_op12(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pydict()
    y = np.floor(1024 * np.array(table["embedding"], float)).astype(np.int64) + 100_000
    n, s = len(y), y.sum(axis=0)
    cov = np.cov(y.T, bias=True)
    w, u = np.linalg.eigh(cov)
    want = (y - s / n) @ u[:, ::-1][:, :8] / np.sqrt(w[::-1][:8])
    rows = queries.op12_whitening(spark, SF_DIR).collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n} and all(0 <= r.identity_error <= 1e-9 for r in rows)
    place = {i: k for k, i in enumerate(table["vec_id"])}
    got = np.zeros((n, 8))
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == int(((n * y[place[r.vec_id]] - s) ** 2).sum())
        assert r.explained == pytest.approx(w[-r.component] / np.trace(cov))
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8


def test_op13(spark, docs):
    """Against the definition over the whole table; DuckDB does it at larger ones."""
    words = [(d["lang"] or "", d["source"] or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (d["text"] or "").translate(LOWER))) for d in docs]
    f, want = lambda p, q: (p - q) ** 2 // (p + q), set()
    for lang in {r[0] for r in words}:
        mine = [r for r in words if r[0] == lang]
        held = Counter(t for r in mine for t in set(r[2]))
        kept = [t for t, n in held.items() if n >= 10]

        def shares(rows):
            c = Counter(t for r in rows for t in r[2])
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return c, {t: 1 + 10 ** 9 * (c[t] + 2) // total for t in kept}
        _, q = shares(mine)
        of = {s: shares([r for r in mine if r[1] == s]) for s in {r[1] for r in mine}}
        for s, (c, p) in of.items():
            parts = {"pair": [(-sum(f(p[t], of[o][1][t]) for t in kept), o.encode()) for o in of if o != s],
                     "term": [(-f(p[t], q[t]), t.encode()) for t in kept if c[t] and p[t] > q[t]]}
            for part, ranked in parts.items():
                want |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(ranked)) if part == "pair" or k < 10}
    got = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in queries.op13_divergence(spark, SF_DIR).collect()]
    assert len(got) == len(want) > 100 and set(got) == want
