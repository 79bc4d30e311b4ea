"""The training-data operators against brute force on small, awkward inputs."""

import hashlib
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkmart.llm import (bpe, chat, covertree, decontaminate, divergence, graph, kernels, kneserney, packing, quality, secrets, simhash,
                           toxicity, training, trigrams, urlfilter, whitening)
from sparkmart.session import ensure_checkpoint_dir

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile("[^\x20\x09-\x0D]+")
rnd = random.Random(5)
VOCABULARY = ["the", "of", "Été", "a1", "b-c", "ça", "zz", "IDIOT", "über"] + [f"w{i}" for i in range(40)]


def _prose(n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


PASSAGE = _prose(20)
TEXTS = [None, "", "   \n", "one", _prose(5), PASSAGE, PASSAGE + " tail", "X " * 400 + PASSAGE, _prose(3000), _prose(60)]
TEXTS += [TEXTS[-1]] * 3 + [TEXTS[-1] + " more"] + [_prose(30) for _ in range(6)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS)] + [(5, PASSAGE, "again", 0), (None, PASSAGE, "no id", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, gram string, n_words int").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(len(TEXTS))] + [(3, None, None), (3, 1, 1), (None, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")


def _empty(df):
    return df.where("false")


def test_decontamination(spark, docs):
    words = WORD.findall(PASSAGE.translate(LOWER))
    items = spark.createDataFrame([(1, PASSAGE), (1, " ".join(words[2:9])), (2, "of the"), (3, None), (4, ""), (None, "one"), (10, PASSAGE[:70])],
                                  "item_id int, text string")
    windows = {}
    for item, text in items.collect():
        w = WORD.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        for j in range(len(w) - n + 1) if n else []:
            windows.setdefault(tuple(w[j:j + n]), set()).add(item)
    got = {(r.doc_id, r.n_words): r for r in decontaminate.find_contamination(docs, items).collect()}
    assert decontaminate.find_contamination(docs, items).count() == docs.count()
    for i, text in enumerate(TEXTS):
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        r = got[i, len(w)]
        assert (r.n_hit, r["items"]) == (len(hit), sorted(str(x) for x in found if x is not None))
    assert {r.n_hit for r in decontaminate.find_contamination(docs, _empty(items)).collect()} == {0}
    assert decontaminate.find_contamination(_empty(docs), items).count() == 0
    kept = decontaminate.remove_contaminated(docs, items.where("item_id = 1"))
    assert kept.columns == docs.columns and 6 not in [r.doc_id for r in kept.collect()]


def _print_of(text):
    w = (text or "").translate(LOWER).encode().split()
    if not w:
        return 0
    k = min(4, len(w))
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[j:j + k]), 42) for j in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs):
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of(F.col("fp")).alias("f"), "component_id").collect()
    assert len(got) == docs.count()
    assert all(r.f == f"{_print_of(TEXTS[r.doc_id if r.doc_id is not None else 5]):016x}" for r in got)
    assert {r.doc_id: r.component_id for r in got}[1] == 0            # no words: fingerprint zero
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == {r.component_id for r in got}
    assert simhash.near_duplicates(_empty(docs)).count() == 0
    # an id on rows of different groups: it goes from one and stays in the other
    torn = spark.createDataFrame([(3, TEXTS[8]), (5, TEXTS[8]), (5, TEXTS[9])], "doc_id int, text string")
    assert sorted((r.doc_id, r.text == TEXTS[9]) for r in simhash.keep_one(torn).collect()) == [(3, False), (5, True)]


def test_keep_one_without_ids(spark):
    texts = [TEXTS[9], TEXTS[14], TEXTS[15], TEXTS[9], TEXTS[16], TEXTS[8]]
    ids = [None, None, None, None, 4, 4]
    rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id int, text string")
    assert sorted(r.text for r in simhash.keep_one(rows.limit(4)).collect()) == sorted(texts[:3])
    assert sorted(r.text for r in simhash.keep_one(rows.limit(5)).collect()) == sorted({*texts[:5]})
    named = rows.unionByName(spark.createDataFrame([(8, TEXTS[14])], rows.schema)).where("doc_id IS NULL OR doc_id = 8")
    assert sorted((r.text, r.doc_id) for r in simhash.keep_one(named).collect()) == sorted(
        [(TEXTS[9], None), (TEXTS[15], None), (TEXTS[14], 8)])


def test_keep_one_least_id_of_two_groups(spark):
    twice = spark.createDataFrame([(5, TEXTS[8]), (5, TEXTS[9]), (9, TEXTS[13])], "doc_id int, text string")
    assert len({r.component for r in simhash.near_duplicates(twice).collect()}) == 2
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(twice).collect()) == sorted([(5, TEXTS[8]), (5, TEXTS[9])])


@pytest.mark.parametrize("cell_rows", [4096, 16])
def test_simhash_links(spark, cell_rows):
    """Chains, balls and strangers; small cells, large ones and cells dealt as block pairs."""
    rng = np.random.default_rng(3)
    prints = set(rng.integers(0, 1 << 63, 60).tolist())
    centre = 0x1234_5678_9ABC_DEF0
    for _ in range(150):
        x = centre
        for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
            x ^= 1 << b
        prints.add(x)
    x = 0x0F0F_0F0F_0F0F_0F0F
    for i in range(0, 60, 3):                                       # a chain of steps of three bits
        prints.add(x)
        x ^= 0b111 << i
    u = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4
    want = np.arange(len(u))
    while True:
        least = np.array([want[row].min() for row in near])
        if (least == want).all():
            break
        want = least
    df = spark.createDataFrame([(v,) for v in u.view(np.int64).tolist()], "fp bigint")
    got = {r.node: r.component for r in graph.components(simhash.links(df, cell_rows=cell_rows)).collect()}
    groups: dict = {}
    for v, w in zip(u.view(np.int64).tolist(), want.tolist()):
        groups.setdefault(w, set()).add(v)
    found: dict = {}
    for v, c in got.items():
        found.setdefault(c, set()).add(v)
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_secrets(spark, docs):
    text = ("é password: hunter22x, API_KEY='abc' token=abc.def-123 AKIA" + "Q" * 16 + " AKIAshort " + "0a" * 14 + " passwd=\"zzzzzz\" "
            "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " https://u:p@h secret = " + "f" * 30)
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    base = []
    for kind, pattern, least, group in (("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
                                        ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)):
        base += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(rows).collect()}
    assert [s for s in got[1] if s[0] in ("assign", "access", "hex")] == sorted(base, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
    assert {s[0] for s in got[1]} == {"assign", "access", "hex", "private_key", "code_host", "url_login"}
    assert got[2] == [] == got[3]
    clean = rows.select(secrets.redact(F.col("text")).alias("t")).collect()
    assert "hunter22x" not in clean[0].t and clean[1].t is None
    assert secrets.find_secrets(_empty(docs)).count() == 0


def test_private_key_bodies(spark):
    line, end = "MIIEpAIBAAKCAQEA" + "x9Y+" * 12, "-----END RSA PRIVATE KEY-----"
    head, body = end.replace("END", "BEGIN"), f"{line}\n{line}\nAb+Q=="
    cases = [(f"a {head}\n{body}\n{end} b", "a [secret] b"),
             (f"a {head}\nProc-Type: 4,ENCRYPTED\n\n{body}\n{end}\nb", "a [secret]\nb"),
             (f"a {head}\n{body}\n\nsome words\n{head}\n{body}\n{end}", "a [secret]\n\nsome words\n[secret]"),
             (f'"{head}\n{body}\n", b'.replace("\n", "\\n"), '"[secret]\\n", b'),
             (f"{head}\n{body}\n-----END EC PRIVATE KEY-----", "[secret]\n-----END EC PRIVATE KEY-----"),
             (f"{head}\r\n{line}", "[secret]"), (f"{head} and so on", "[secret] and so on"),
             (f"{head}\n" * 20_000, "[secret]\n" * 20_000)]                     # in linear time
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string")
    got = {r.i: r.t for r in rows.select("i", secrets.redact(F.col("text")).alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_trigram_queries_are_necessary():
    for rule in secrets.RULES:
        query = trigrams.trigram_query(rule.pattern)
        assert (query is None) == (rule.kind == "hex")
    assert trigrams.trigram_query("ab") is None and trigrams.trigram_query("abcd") == ("and", (b"abc", b"bcd"))
    assert trigrams.trigram_query("(abc|.)x") is None


def test_bpe(spark, docs):
    rank_file = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokenizer = bpe.encoding(rank_file, public_tokenizers.PATTERN)
    long = " ".join(_prose(50) + rnd.choice(["\n\n", "  ", " '", "12"]) for _ in range(700))
    assert bpe.encode(tokenizer, long) == tokenizer.encode_ordinary(long) and len(list(bpe.pieces(long))) > 2
    assert list(bpe.pieces("é" * 200_000)) == ["é" * 200_000]        # no safe boundary: one piece
    rows = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "<|endoftext|> 😀"), (4, "b")], "doc_id int, text string")
    out = bpe.encode_documents(rows, rank_file, public_tokenizers.PATTERN)
    got = {r.text_sha: r for r in out.withColumn("text_sha", F.col("decoded_sha256")).collect()}
    for text in (long, "", "<|endoftext|> 😀", "b"):
        r = got[hashlib.sha256(text.encode()).hexdigest()]
        ids = tokenizer.encode_ordinary(text)
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    back = {bytes(r.decoded) for r in bpe.decode_ids(out, rank_file, public_tokenizers.PATTERN).collect()}
    assert back == {t.encode() for t in (long, "", "<|endoftext|> 😀", "b")}


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, docs, labels, module, label):
    run = quality.score_quality if module is quality else toxicity.score_toxicity
    bad = "STOP!! THAT!! " if module is quality else "you idiot scum "
    rows = [(i, _prose(20) + (" " + bad * 3 if i % 3 == 0 else ""), i) for i in range(400)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    marks = spark.createDataFrame([(i, int((i % 3 == 0) == (module is toxicity))) for i in range(400)], f"doc_id bigint, {label} int")
    out = run(many, marks).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.FOLD) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == int((r.doc_id % 3 == 0) == (module is toxicity)) for r in held) >= 0.95 * len(held)
    odd = run(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in run(docs, _empty(labels)).collect()} == {0.5}
    assert run(_empty(docs), labels).count() == 0


def test_labelled_sample_counts_present_documents(spark):
    """Neither labels of absent documents nor repeated documents use up the bound."""
    rows = spark.createDataFrame([(i % 40, f"text {i}") for i in range(400)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id bigint, quality int")
    got = training.labelled_sample(rows, marks, "quality", 4, 2, 20).collect()
    assert len(got) == 20 == len({r.doc_id for r in got})
    assert all(r.y == r.doc_id % 2 and int(r.text[5:]) % 40 == r.doc_id for r in got)


def test_copies_of_a_training_row_count_once(spark):
    rows = [(i, f"{_prose(6)} {('good', 'awful')[i % 2]}") for i in range(300)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    once = spark.createDataFrame(rows, "doc_id bigint, text string")
    again = spark.createDataFrame(rows * 3, "doc_id bigint, text string").repartition(5)
    for a, b in zip(quality.fit_quality(once, marks), quality.fit_quality(again, marks), strict=True):
        assert (a == b).all()


def test_stages_keep_any_columns(spark):
    """Names that the stages use themselves, in any case."""
    odd = ["_quality_score", "_GONE", "_id", "_fp", "_own", "__own", "_bad_id", "_Bad_Key", "component", "fp", "n", "text_key", "predicted"]
    texts = [PASSAGE, PASSAGE + " tail", _prose(40), _prose(50), None]
    schema = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in odd)
    items = spark.createDataFrame([(1, PASSAGE)], "item_id int, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 6)], "doc_id bigint, quality int")
    for ids in ([1, 2, 3, 4, 5], [1, 1, 3, None, None]):        # the second way tells rows apart by fingerprint
        rows = spark.createDataFrame([(i, t, *[f"{c}{k}" for c in odd]) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], schema)
        for kept in (quality.keep_good(rows, rows, labels), simhash.keep_one(rows), decontaminate.remove_contaminated(rows, items)):
            assert kept.columns == rows.columns
            assert kept.exceptAll(rows).count() == 0 < kept.count()
        assert decontaminate.remove_contaminated(rows, items).count() == 3


def test_web_tokens_in_linear_time():
    rule = next(r for r in secrets.RULES if r.kind == "web_token")
    assert re.fullmatch(rule.pattern, "eyJhbGciOiJI.eyJzdWIiOi.sflKxwRJSM") and re.search(rule.pattern, "=eyJhbGciOiJI.eyJzdWIiOi.sflKxwRJSM;")
    for text in ("eyJ" * 350_000, "eyJaaaaaaaa." * 90_000, ("eyJ" * 30 + " ") * 12_000):
        began = time.monotonic()
        sum(1 for _ in re.finditer(rule.pattern, text))
        assert time.monotonic() - began < 2


def test_url_hosts_of_very_many_labels(spark):
    listed = spark.createDataFrame([("example.com", "/en/", "block"), ("com", "/", "allow")], "host string, path string, verdict string")
    host = "a." * 100_000 + "example.com"
    got = urlfilter.judge_urls(spark.createDataFrame([(1, f"http://{host}/en/x"), (2, f"http://{host}x/en/")], "page_id int, url string"), listed)
    assert [(r.page_id, r.rule, r.verdict) for r in got.orderBy("page_id").collect()] == [(1, "example.com/en/", "block"), (2, None, "allow")]


def _pieces(n, longest):
    """Lengths of the pieces of n ids, by the definition."""
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if n % longest >> b & 1]


def test_packing(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, _ = packing._tokenizer(path)
    odd = ["a  b  c d\u3000 e\n\n x\t y ", "é à ü  <|endoftext|> x", "\u0085 a\x1c b\x1f c  \n", "日本 語  です\r\n ok", "it's we'll '  s", "ñ\n", "a.b,c''s'd 1.2 a'll",
           "x" * 3000, " " * 500, "\u00d7, y\u00a0 z", "word " * 4000]
    more = docs.select("doc_id", "text", F.lit(9).alias("length"), F.lit("x").alias("BUCKET")).unionByName(
        spark.createDataFrame([(100 + i, t, 0, "y") for i, t in enumerate(odd)], "doc_id bigint, text string, length int, BUCKET string"))
    out = packing.pack_documents(more, path, longest=64).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    by_bucket = sorted((r.sequence_id, r.bucket) for r in out)
    assert [b for _, b in by_bucket] == sorted(b for _, b in by_bucket)            # equal lengths stand together
    assert all(r.offset == 0 and r.length == 1 << r.bucket == len(r.ids) <= 64 for r in out)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out)
    got, want = {}, {}
    for r in sorted(out, key=lambda r: r.start):
        got.setdefault(r.doc_id, []).append(r)
    rows = more.collect()
    assert len({r.doc_id for r in rows}) == len(got)
    for r in rows:
        want.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])
    for doc_id, texts in want.items():
        pieces = got[doc_id]
        assert sum(r.length for r in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            assert [i for r in pieces for i in r.ids] == texts[0]
            assert [r.length for r in pieces] == _pieces(len(texts[0]), 64) and {r.doc_tokens for r in pieces} == {len(texts[0])}
            assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
    assert packing.pack_documents(_empty(more), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(more, path, longest=100)


@pytest.mark.parametrize("trial", range(12))
def test_feast_finds_all_eigenpairs(trial):
    r = np.random.default_rng(trial)
    d = int(r.integers(1, 40))
    x = r.standard_normal((d, int(r.integers(1, 60))))
    a = np.kron(np.eye(3), x @ x.T) if trial % 3 == 0 else x @ x.T           # every third one with triple eigenvalues
    w = np.linalg.eigvalsh(a)
    for shift in r.uniform(-1, 1.1 * w[-1], 5):
        assert whitening.below(a, shift) == (w < shift).sum()
    found = whitening.slices(a, 8)
    values = []
    for lo, hi, count in found:
        e, v = whitening.feast(a, lo, hi, count)
        assert len(e) == count and np.abs(a @ v - v * e).max() < 1e-11 * w[-1] and np.abs(v.T @ v - np.eye(count)).max() < 1e-10
        values += e.tolist()
    want = w[::-1][:8][w[::-1][:8] > 1e-10 * w[-1]]
    assert np.allclose(np.sort(values)[::-1][:len(want)], want, rtol=1e-10)


def test_inertia_of_zero_pivots():
    assert whitening.below(np.array([[0.0, 1], [1, 0]]), 0.0) == 1 and whitening.below(np.zeros((3, 3)), 0.0) == 0
    assert whitening.slices(np.zeros((3, 3)), 8) == []


def test_whitening(spark):
    r = np.random.default_rng(3)
    x = (r.standard_normal((300, 6)) @ np.diag([3, 1, 1, 0.5, 0.2, 0]) + [0, 5, -5, 0, 0, 1]).astype(np.float32)
    rows = [(i, v.tolist(), i, "z") for i, v in enumerate(x)] + [(7, x[7].tolist(), 0, "copy"), (None, x[8].tolist(), 0, "no id")]
    bad = [(900, None), (901, []), (902, [1.0] * 5), (903, [float("nan")] * 6), (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (905, [float("inf")] * 6), (906, [3e38] * 6)]
    schema = "vec_id bigint, embedding array<float>, n int, whitened string"
    frame = spark.createDataFrame(rows + [(i, v, 0, "") for i, v in bad], schema).repartition(3)
    out = whitening.whiten(frame).collect()
    y = np.floor(1024 * np.array([v for _, v, *_ in rows], np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(y), y.sum(axis=0)
    cov = np.cov(y.T, bias=True)
    w, u = np.linalg.eigh(cov)
    w, u = w[::-1][:5], u[:, ::-1][:, :5]                    # the sixth direction does not vary
    want = (y - s / n) @ u / np.sqrt(w)
    assert len(out) == n and {o.n for o in out} == {n} and all(len(o.whitened) == 5 for o in out)
    place = {i: k for k, (i, *_) in enumerate(rows)}
    got = np.array([o.whitened for o in out])
    mine = want[[place[o.vec_id] for o in out]]
    assert np.abs(got * np.sign((got * mine).sum(axis=0)) - mine).max() < 1e-9
    assert all(int(o.deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(y[place[o.vec_id]], s)) for o in out)
    assert out[0].explained == pytest.approx((w / np.trace(cov)).tolist()) and 0 <= out[0].identity_error < 1e-10
    one = whitening.whiten(frame.where("vec_id = 3")).collect()
    assert len(one) == 1 and one[0].whitened == [] and int(one[0].deviation) == 0
    assert whitening.whiten(_empty(frame)).count() == 0 == whitening.whiten(frame.where("vec_id = 900")).count()


def test_unmix_undoes_mix():
    x = np.random.default_rng(1).integers(0, 2 ** 63, 1000).astype(np.uint64) * np.uint64(2)
    assert (kneserney.unmix(kernels.mix(x)) == x).all()


def test_gram_is_exact():
    y = np.array([[2 ** 30, -3], [5, 2 ** 31 - 1], [-7, 11]], np.int64)
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(2)] for i in range(2)]
    assert whitening.gram(y).tolist() == want


def _divergence(rows, least, top):
    """The audit by its definition, in whole numbers."""
    letter = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    words = [(lang or "", source or "", letter.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in words}:
        mine = [r for r in words if r[0] == lang]
        kept = [t for t in {t for r in mine for t in r[2]} if sum(t in r[2] for r in mine) >= least]

        def shares(groups):
            c = {t: sum(r[2].count(t) for r in groups) for t in kept}
            return c, {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        _, q = shares(mine)
        sources = {r[1] for r in mine}
        of = {s: shares([r for r in mine if r[1] == s]) for s in sources}
        for s in sources:
            c, p = of[s]
            pairs = [(-sum(f(p[t], of[o][1][t]) for t in kept), o.encode()) for o in sources - {s}]
            terms = [(-f(p[t], q[t]), t.encode()) for t in kept if c[t] and p[t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(3, 4), (1, 2), (1000, 10)])
def test_divergence(spark, least, top):
    rows = [(rnd.choice(["de", "en"]), rnd.choice(["a", "a", "b", "c"]), _prose(rnd.randrange(30))) for _ in range(60)]
    rows += [("de", "empty", ""), ("fr", "alone", "Le le LE chat"), (None, None, None), (None, "a", "x y"), ("en", None, "the THE Été")] + [rows[0]] * 5
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(4)
    got = sorted(tuple(r) for r in divergence.audit_sources(frame, least, top).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == _divergence(rows, least, top) and len(got) > 10
    assert divergence.audit_sources(_empty(frame)).count() == 0


def test_skyband_holds_all_leaders():
    r = np.random.default_rng(2)
    n, lang_n = r.integers(1, 9, 500), r.integers(9, 20, 500)
    term = np.array([f"t{i}".encode() for i in r.permutation(500)], object)
    kept = set(divergence.skyband(n, lang_n, term, 3).tolist())
    for i in range(500):
        over = sum(n[j] >= n[i] and lang_n[j] <= lang_n[i] and term[j] < term[i] for j in range(500) if j != i)
        assert (i in kept) == (over < 3)


def test_shares_by_long_division():
    for count, total, terms in ((0, 0, 1), (10 ** 13, 2 * 10 ** 13, 10 ** 6), (7, 10, 3), (5 * 10 ** 14, 10 ** 15, 1)):
        assert int(divergence.share(count, total, terms)) == 1 + 10 ** 9 * (count + 2) // (total + 2 * terms)


def test_toxic_pairs(spark):
    """The label depends on two words together; each word alone is balanced."""
    rows = [(i, f"{_prose(9)} {('group', 'folks')[i % 2]} {_prose(9)} {('insult', 'praise')[i // 2 % 2]}") for i in range(1000)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 2 == i // 2 % 2)) for i in range(1000)], "doc_id bigint, toxic int")
    held = [r for r in toxicity.score_toxicity(many, marks).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 2 == r.doc_id // 2 % 2) for r in held) >= 0.95 * len(held) > 100


def test_url_filter(spark):
    listed = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                                    ("Org", None, "block"), ("org", "", "allow"), (None, "/", "block"), ("x.org", "/", None)],
                                   "host string, path string, verdict string")
    urls = ["http://EXAMPLE.com/en/a?x", "https://a.www.example.com/en/", "http://www.example.com/de", "http://b.com", "http://com/",
            "ftp://q.org#f", "notexample.org/en/", None, "http://notexample.net/en/", "://x.example.com/en/#a", "http://ecom/en/"]
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "org": "block"}
    got = urlfilter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), listed).collect()
    assert len(got) == len(urls)
    for r in got:
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
        fits = [k for k in rules for h, _, p in [k.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith(_ + p)]
        best = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best, rules[best] if best else "allow")
    assert {r.rule for r in urlfilter.judge_urls(spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string"), _empty(listed)).collect()} == {None}


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "a<|b", 0.0), (1, 2, 1, "assistant", "x\\l</s>\n", 1.0), (1, 3, 1, "assistant", "y", 5.0), (1, 4, 3, "user", None, 0.0),
            (1, 4, 3, "user", None, 0.0), (2, 1, 9, "a|>\nb", "orphan", None), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0),
            (None, 1, None, "assistant", "", 1.0)]
    df = spark.createDataFrame(rows, "conv_id int, msg_id int, parent_id int, role string, text string, score double")
    every = chat.format_conversations(df, best=None)
    got = {(r.conv_id, r.leaf_id): r for r in every.select(
        "conv_id", "leaf_id", "rank", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == {
        (1, 2): [("user", "a<|b"), ("assistant", "x\\l</s>\n")], (1, 4): [("user", "a<|b"), ("assistant", "y"), ("user", "")],
        (2, 1): [("a|>\nb", "orphan")], (None, 1): [("assistant", "")]}
    assert got[1, 4].rank == 1 and got[1, 2].rank == 2 and got[1, 2].loss == "x\\l</s>\n" and got[2, 1].loss == ""
    assert {r.leaf_id for r in chat.format_conversations(df).where("conv_id = 1").collect()} == {4}
    assert chat.format_conversations(_empty(df)).count() == 0
    chain = spark.createDataFrame([(7, t, "user", str(t)) for t in range(100)] + [(7, None, None, None)], "conv_id int, turn int, role string, text string")
    turns = chat.format_conversations(chat.as_messages(chain)).select(chat.read_turns(F.col("formatted")).alias("t")).first().t
    assert [t.text for t in turns] == [""] + [str(t) for t in range(100)]


@pytest.mark.parametrize("block_rows", [4096, 24])
def test_cover_tree(spark, block_rows):
    rng = np.random.default_rng(1)
    points = [rng.normal(size=6) for _ in range(60)]
    points += [points[0] + rng.normal(scale=s, size=6) for s in (0.01, 0.1, 0.3, 0.5) for _ in range(25)] + [points[1]] * 4 + [points[2] * 7]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    odd = [None, [], [0.0] * 6, [None] * 6, [float("nan")] * 6, [float("inf")] + [1.0] * 5]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(2000, [1.0, 0.0]), (2001, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    x = np.stack(points)
    n = np.sqrt((x * x).sum(axis=1))
    near = (x @ x.T) / (n[:, None] * n) >= 0.9
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        least = np.array([min([c, *comp[row]]) for c, row in zip(comp, near)])
        if (least == comp).all():
            break
        comp = least
    got = {r.vec_id: r for r in covertree.near_duplicates(df, block_rows=block_rows).collect()}
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i in range(len(x))] == [
        (int(near[i].sum()), int(comp[i]), bool(comp[i] == i)) for i in range(len(x))]
    assert all((got[1000 + i].n_links, got[1000 + i].component_id) == (0, 1000 + i) for i in range(len(odd)))
    assert (got[2001].n_links, got[2001].component_id) == (1, 2000)
    assert covertree.near_duplicates(_empty(df)).count() == 0


def test_cover_tree_blocks_are_exchanged_once(spark, monkeypatch, tmp_path):
    """Shuffled bytes grow with the rows, not with the block pairs; cells, blocks and shuffles do not stay."""
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1200, 8)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    plans, real = [], covertree.reliable_checkpoint

    def seen(table, **how):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return real(table, **how)
    monkeypatch.setattr(covertree, "reliable_checkpoint", seen)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before, setting = set(folder.glob("run-*")), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = covertree.near_duplicates(df, block_rows=32)
    links, = (p for p in plans if "low_part" in p)
    assert "CartesianProduct" in links and "FlatMapGroups" not in links
    assert set(folder.glob("run-*")) == before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    assert {r.vec_id: r.n_links for r in found.collect()} == dict(enumerate(((x @ x.T >= 0.9).sum(axis=1) - 1).tolist()))
    raw = rng.normal(size=(300, 64)).astype(np.float32)
    block = covertree.Block(np.arange(300), np.ones(300, np.int64), raw)
    assert len(block.pack()) < raw.nbytes + 40_000                     # floats stay floats
    assert (covertree.Block.unpack(block.pack()).unit == block.unit).all()


def test_language_model(spark, docs):
    out = {r.doc_id: r for r in kneserney.score_documents(docs.where("doc_id IS NOT NULL AND NOT (doc_id = 5 AND gram = 'again')")).collect()}
    tokens = {i: TOKEN.findall((t or "").translate(LOWER)) + ["</end>"] for i, t in enumerate(TEXTS)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count: dict = {}
    for i, w in tokens.items():
        for t in w if not held[i] else []:
            count[t] = count.get(t, 0) + 1
    total, size = sum(count.values()), len(count)
    for i, w in tokens.items():
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(t in count for t in w), total)
        assert r.base_score == pytest.approx(sum(np.log10((count.get(t, 0) + 1) / (total + size + 1)) for t in w))
        assert r.score <= 1e-9 and np.isfinite(r.score)
    assert kneserney.score_documents(docs).count() == docs.count()
    assert kneserney.score_documents(_empty(docs)).count() == 0


def _kneser_ney(texts, order):
    """log10 probability of a text by the definition: interpolated modified Kneser-Ney over
    tuples of tokens, from raw counts of the highest order and numbers of distinct words before
    a shorter gram (occurrences where it begins a text)."""
    start, raw = ("<s>",), [{} for _ in range(order + 1)]
    for w in texts:
        for i in range(len(w)):
            for m in range(1, order + 1):
                gram = ((start if i - m + 1 == -1 else ()) + tuple(w[max(0, i - m + 1):i + 1]))
                if len(gram) == m:
                    raw[m][gram] = raw[m].get(gram, 0) + 1
    count = [None] * (order + 1)
    count[order] = raw[order]
    for m in range(order - 1, 0, -1):
        before = {}
        for gram in raw[m + 1]:
            before[gram[1:]] = before.get(gram[1:], 0) + 1
        count[m] = {g: raw[m][g] if g[0] == "<s>" else before[g] for g in raw[m]}
    spare, about = [None] * (order + 1), [None] * (order + 1)
    for m in range(1, order + 1):
        spare[m] = kneserney.discounts(np.array([sum(c == k for c in count[m].values()) for k in (1, 2, 3, 4)]))
        about[m] = {}
        for g, c in count[m].items():
            total = about[m].setdefault(g[:-1], [0, 0, 0, 0])
            total[0] += c
            total[min(c, 3)] += 1
    size = len(raw[1])

    def p(gram):
        m = len(gram)
        below = p(gram[1:]) if m > 1 else 1 / (size + 1)
        total = about[m].get(gram[:-1])
        if not total:
            return below
        c = count[m].get(gram, 0)
        return (c - spare[m][min(c, 3)]) / total[0] + sum(spare[m][k] * total[k] for k in (1, 2, 3)) / total[0] * below

    def score(w):
        return sum(np.log10(p(((start if i - order + 1 < 0 else ()) + tuple(w[max(0, i - order + 1):i + 1]))[-order:])) for i in range(len(w)))
    return score


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_by_definition(spark, docs, order, monkeypatch):
    monkeypatch.setattr(kneserney, "SHARD_TOKENS", 512)           # several shards of a small corpus
    rows = docs.where("doc_id IS NOT NULL AND gram = 'clash'")
    out = {r.doc_id: r.score for r in kneserney.score_documents(rows, order).collect()}
    tokens = {i: TOKEN.findall((t or "").translate(LOWER)) + ["</end>"] for i, t in enumerate(TEXTS)}
    score = _kneser_ney([w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2], order)
    assert len(out) == len(TEXTS)
    for i, w in tokens.items():
        assert out[i] == pytest.approx(score(w), rel=1e-9), i
    assert kneserney.score_documents(_empty(docs), order).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_model_probabilities_sum_to_one(spark, docs, order):
    model = kneserney.train(docs.where("doc_id IS NOT NULL"), order).open()
    words = np.concatenate([s for s in model.vocabulary.shards])
    unknown = np.array([12345], np.uint64)
    for first in (words[3], unknown[0]):
        pairs = np.concatenate([np.array([first, w], np.uint64) for w in [*words, *unknown]])
        bounds = np.arange(0, len(pairs) + 1, 2)
        single = np.concatenate([np.array([first], np.uint64) for _ in range(len(words) + 1)])
        both = model.score(pairs, bounds)[3] - model.score(single, np.arange(len(single) + 1))[3]
        assert np.sum(10.0 ** both) == pytest.approx(1.0)
