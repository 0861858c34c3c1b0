"""Token counts, vector codes and the filter audit against brute force, and the columns of their queries."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ball_kmeans, catalog, filter_audit, token_counts
from ledgerlens.llm.transducer import Transducer

from llm.helpers import ROWS, awkward, empty, with_clashes

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(catalog.public_tokenizer())


@pytest.fixture(scope="module")
def compiled():
    with open(catalog.public_tokenizer(), encoding="utf-8") as f:
        return token_counts.Tokenizer(f.read())


def lengths(library, texts):
    return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


# ---- transducers

def run_alone(machine, data):
    state, out = machine.start, []
    for b in data.tolist():
        out.append(machine.emit[state * 256 + b])
        state = machine.step[state * 256 + b] // 256
    return out


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, 5000, 70_000])
def test_chunks_compose_to_a_single_run(size):
    rng = np.random.default_rng(size)
    # states that never meet (a permutation for each byte), so every map stays complete
    apart = Transducer(np.array([rng.permutation(5) for _ in range(256)]).T, rng.integers(0, 99, (5, 256)), start=3)
    for machine in (apart, token_counts.splitter(), filter_audit.scanner()):
        data = rng.integers(0, 133, size).astype(np.uint8)
        assert machine.run(data).tolist() == run_alone(machine, data)


# ---- token counts

def test_counts_equal_the_library_on_odd_texts(library, compiled):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCÉéßñ 0123456789'’.,!<|>_-\t\n 　́中文字ÅΣİ😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["it's don't we're they've I'll I'm he'd 're 'r 'v 'l x'rx ''s !'s 'sun 'sS'l", "", " ", "'" * 50,
              "a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|> <|endoftext|", "\x1c\x85x", "é 가"]
    assert compiled.count([t.encode() for t in texts]).tolist() == lengths(library, texts)


def test_words_longer_than_a_chunk(library, compiled):
    rng = random.Random(6)
    texts = ["a" * 5000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), "中文字" * 3000, "=" * 3000, "4" * 3000]
    assert compiled.count([t.encode() for t in texts]).tolist() == lengths(library, texts)
    # chunks of a few bytes: every word is cut and every chunk runs twice
    data, starts = np.frombuffer(b"thequickbrownfox", np.uint8).astype(np.int64), np.array([0])
    data = np.concatenate([data[:-1], data[-1:] + 256])
    counter = compiled.counter
    assert {int(counter.emitted(data, starts, chunk).sum()) for chunk in (1, 2, 3, 5, 64)} == {
        lengths_of for lengths_of in [len(counter.bpe(data.tolist()))]}


def test_counts_of_whole_documents(spark, library):
    got = catalog.op11_tokens(spark, "/root/testdata/sf0.01")
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    rows = {r["doc_id"]: r for r in got.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [d["text"] or "" for d in docs]
    assert len(rows) == len(docs)
    for d, t, n in zip(docs, texts, lengths(library, texts)):
        assert tuple(rows[d["doc_id"]]) == (d["doc_id"], len(t.encode()), n, n > 2048)


def test_counts_of_awkward_rows(spark, library):
    docs = with_clashes(awkward(spark), "n_tokens", "key")
    got = token_counts.with_counts(docs, catalog.public_tokenizer())
    rows = got.collect()
    assert len(rows) == docs.count() and got.columns[-2:] == ["n_bytes", "n_tokens"]
    for r in rows:
        assert r["n_tokens"] == lengths(library, [r["text"] or ""])[0]
        assert r["n_bytes"] == len((r["text"] or "").encode())
    assert token_counts.with_counts(empty(docs), catalog.public_tokenizer()).count() == 0
    broken = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    (row,) = token_counts.with_counts(broken, catalog.public_tokenizer()).collect()
    assert row["n_tokens"] == lengths(library, ["a�b"])[0] and row["n_bytes"] == 3


# ---- vector codes

def brute_codes(rows, rounds=6, entries=16):
    """rows: (id, list of floats, label); integer k-means of each part."""
    import math
    kept = [(i, [math.floor(4096 * float(v)) for v in x], lab) for i, x, lab in rows
            if x and all(v is not None and math.isfinite(v) for v in x)]
    if not kept:
        return {}, ""
    d = len(kept[0][1]) // 8
    part = lambda x, p: x[p * d:(p + 1) * d]
    first = sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1]))[:entries]
    books = [[part(k[1], p) for k in first] for p in range(8)]
    gap = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b))
    near = lambda x, p: min((gap(part(x, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(8):
            groups = {}
            for _, x, _ in kept:
                groups.setdefault(near(x, p)[1], []).append(part(x, p))
            new.append([[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else old
                        for e, old in enumerate(books[p])])
        books = new
    out = [(i, "".join(f"{near(x, p)[1]:02x}" for p in range(8)), sum(near(x, p)[0] for p in range(8)), lab) for i, x, lab in kept]
    most, total = (1 << 63) - 1, {}  # sums are cut to a long
    out = [(i, c, min(e, most), lab) for i, c, e, lab in out]
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    text = ",".join(str(v) for b in books for c in b for v in c)
    return sorted([(i, c, e, min(total[lab], most)) for i, c, e, lab in out], key=repr), hashlib.sha256(text.encode()).hexdigest()


def run_codes(spark, tmp_path, rows, kind="float"):
    path = str(tmp_path)
    spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("error", F.lit(1)).write.mode(
        "overwrite").parquet(f"{path}/embeddings.parquet")
    got = catalog.op12_codes(spark, path)
    assert got.dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"),
                          ("codebooks_sha256", "string")]
    out = got.collect()
    return sorted([tuple(r)[:4] for r in out], key=repr), {r["codebooks_sha256"] for r in out}


@pytest.mark.parametrize("scale", [1.0, 0.003, 1e5, 1e12])
def test_codes_equal_plain_k_means(spark, tmp_path, scale):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [(i, [float(np.float32(v * scale)) for v in centres[rng.integers(40)] + rng.normal(size=16) * 0.1], [None, 1, 2][i % 3])
            for i in range(300)]
    want, book = brute_codes(rows)
    assert run_codes(spark, tmp_path, rows) == (want, {book})


def test_codes_of_awkward_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    same = [0.25] * 8
    rows = [(5, same, 1), (5, same, 1), (5, [0.5] * 8, None), (7, same, None), (None, [0.1] * 8, 3), (1, None, 1), (2, [nan] + [0.0] * 7, 1),
            (3, [inf] + [0.0] * 7, 1), (4, [None] + [0.0] * 7, 1), (6, [], 1), (8, [-0.00001] * 8, 2)]
    want, book = brute_codes([r for r in rows])
    assert run_codes(spark, tmp_path, rows) == (want, {book})
    assert run_codes(spark, tmp_path, [(1, None, 1)]) == ([], set())
    # lengths that cannot be cut, or differ from the first row's, take no part
    odd = [(1, [0.0] * 7, 1), (2, same, 1), (3, [0.0] * 16, 1)]
    assert run_codes(spark, tmp_path, odd)[0] == [(2, "00" * 8, 0, 0)]


def test_rings_compare_less_than_everything(monkeypatch):
    rng = np.random.default_rng(1)
    book = rng.integers(-4000, 4000, (16, 8))
    true = rng.integers(0, 16, 4000)
    x = book[true] + rng.integers(-300, 300, (4000, 8))
    seen = []
    plain = ball_kmeans.squared
    monkeypatch.setattr(ball_kmeans, "squared", lambda a, b: seen.append(len(a)) or plain(a, b))
    code, far = ball_kmeans.assign(x, book, true)
    every = ((x[:, None, :] - book[None]) ** 2).sum(-1)
    assert (code == every.argmin(1)).all() and (far == every.min(1)).all()
    assert sum(seen) < 4000 * 3  # 16 for each row without balls
    code, far = ball_kmeans.assign(x, book, np.zeros(4000, np.int64))  # any start gives the same
    assert (code == every.argmin(1)).all()


# ---- filter audit

def brute_audit(docs, labels):
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    least = {}
    for k, t, _ in docs:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    rows = []
    for k, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in zip("ABCDE", [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), k is not None and least[t] < k]) if bad}
        rows.append((lang or "", fails, k in good and k is not None, k in toxic and k is not None))
    out, shares = {}, {}
    for order in permutations("ABCDE"):
        for part, fails, g, t in rows:
            gone = False
            for step, f in enumerate(order, 1):
                c = out.setdefault((part, "".join(order), step), [0] * 6)
                here = f in fails
                c[0] += not gone and not here
                c[1] += here and not gone
                c[2] += here and gone
                c[3] += fails == {f}
                c[4] += here and not gone and g
                c[5] += here and not gone and t
                shares[part, f] = shares.get((part, f), 0) + (here and not gone)
                gone |= here
    return sorted((p, o, s, *c, shares[p, o[s - 1]]) for (p, o, s), c in out.items())


def test_audit_equals_brute_force_with_awkward_rows(spark, tmp_path):
    rng = random.Random(2)
    words = ["alpha", "Beta", "GAMMA", "delta#", "eta", "été", "x"]
    prose = lambda n, many: " ".join(rng.choice(words) + (str(rng.randrange(many)) if many else "") for _ in range(n))
    extra = [(20 + i, prose(rng.choice([50, 99, 100, 150]), rng.choice([0, 1000, 5000])), rng.choice(["en", "fr", None]), "s", 1)
             for i in range(60)]
    extra += [(100 + i, extra[i % 7][1], "en", "s", 1) for i in range(40)]
    docs = with_clashes(awkward(spark, extra), "part", "n", "fails")
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(1, 130)] + [(1, 1, 1), (1, 0, 0), (None, 1, 1)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = catalog.op13_filter_audit(spark, str(tmp_path))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == names and dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    want = brute_audit([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], labels)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_audit_of_empty_tables(spark):
    docs, labels = empty(awkward(spark)), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    assert filter_audit.audit(spark.createDataFrame([(1, None, None, None, None)], ROWS), labels).count() == 600


def test_distinct_words_when_all_hashes_are_equal():
    texts = [b"ab ab abc " * 3 + b"abcdefgh1 abcdefgh2 abcdefgh1", b"", b"ab", b"a" * 3000 + b" " + b"a" * 3000]
    data, at = filter_audit.joined(texts, b"\n")
    seen = filter_audit.scanner().run(data)
    starts = np.flatnonzero(seen & filter_audit.WORD_START)
    spans = filter_audit.Spans(data, starts, np.flatnonzero(seen & filter_audit.WORD_END) - starts)
    owner = np.searchsorted(at, starts, "right") - 1
    same = lambda o: np.zeros(len(o), np.uint64)
    assert filter_audit.distinct_words(spans, owner, 4, same).tolist() == [4, 0, 1, 1]
    assert filter_audit.distinct_words(spans, owner, 4).tolist() == [4, 0, 1, 1]
