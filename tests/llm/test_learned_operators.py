"""Language, secrets, language model, packing, toxicity and the pipeline: round trips, brute force and held-out checks."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import gru_language, lbl_lm, packing_swap, secret_markov, weak_toxicity
from ledgerlens.llm.catalog import public_tokenizer
from ledgerlens.llm.common import connected_components, remainder
from llm.helpers import awkward, empty, with_clashes


# ------------------------------------------------------------------ shared
def test_components_of_a_random_graph(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_planner_sizes_of_components_stay_small(spark):
    """The planner's size estimate doesn't grow with the rounds: its digits tripled with each one."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    for _ in range(2):  # links that follow from components, as a second round of operators has
        comp = connected_components(edges)
        assert comp._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 2000
        edges = edges.join(comp, edges.a == comp.node).select("a", "b")


def test_remainder_is_crc32_of_the_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 5, 123456, None)], "doc_id long").select("doc_id", remainder("doc_id", 4).alias("r")).collect()
    assert [r["r"] for r in rows] == [*(zlib.crc32(str(i).encode()) % 4 for i in (0, 5, 123456)), -1]


# ------------------------------------------------------------------ 3
def test_gru_gradients_match_differences():
    net = gru_language.Network(["a", "b", "c"], hidden=3, seed=1)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    runs, label = [b"abca", b"zz", b"q"], np.array([0, 2, 1])
    _, g = net.gradients(runs, label)
    for k in ("uf", "cb", "o", "wf"):
        for at in [tuple(x) for x in np.argwhere(np.abs(g[k]) > 1e-5)[:3]]:
            old, e = net.p[k][at], 1e-3
            net.p[k][at] = old + e
            up, _ = net.gradients(runs, label)
            net.p[k][at] = old - e
            down, _ = net.gradients(runs, label)
            net.p[k][at] = old
            assert math.isclose((up - down) / (2 * e), g[k][at], rel_tol=0.05, abs_tol=2e-4)


def test_language_of_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(gru_language, "STEPS", 250)
    rng = random.Random(1)
    syllables = {"xx": ["ka", "to", "mi", "zu"], "yy": ["sch", "ung", "der", "ein"], "zz": ["ción", "que", "lla", "os"]}
    rows = [(i, " ".join("".join(rng.choice(syllables[g]) for _ in range(rng.randrange(1, 4))) for _ in range(12)).title(), g)
            for i, g in ((i, rng.choice(list(syllables))) for i in range(200))]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "12 3.4 !", "zz"), (903, "kato mizu", None), (903, "kato mizu", None), (904, "q" * 5000, "xx")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "h", "rank", "key")
    held = remainder("doc_id", 4) == 2
    model = gru_language.fit(docs, learn=~held)
    out = gru_language.identified(docs.withColumn("held", held), model).collect()
    seen = [r for r in out if r["held"] and r["lang"] and r["__lang"] != "und"]
    assert sum(r["lang"] == r["__lang"] for r in seen) >= 0.95 * len(seen) and all(0 <= r["__score"] <= 1 for r in out)
    und = {r["doc_id"] for r in out if r["__lang"] == "und"}
    assert und == {900, 901, 902}
    none = gru_language.fit(empty(docs))
    assert {r["__lang"] for r in gru_language.identified(docs, none).collect()} == {"und"}
    assert gru_language.identified(empty(docs), model).count() == 0


# ------------------------------------------------------------------ 5
def test_secret_spans(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
    rows = [(i, " ".join("".join(rng.choice(["an", "the", "or", "ing"]) for _ in range(3)) for _ in range(60))
             + f" token={rng.getrandbits(80):020x} ") for i in range(60)]
    special = {100: f"é {text} end", 101: 'PassWord" : "abc/d=1\' api_key=short7 apikey: tiny', 102: "AKIA" + "Z" * 16 + " AKIAX",
               103: "deadbeef" * 3, 104: None, 105: "", 106: "secret=" + "ab12" * 8, 107: "thingananthethingananthe a_long_identifier_name 4111111111111111"}
    docs = spark.createDataFrame([*rows, *special.items()], "doc_id long, text string")
    docs = with_clashes(docs, "kind", "spans", "n")
    found = {r["doc_id"]: r["__spans"] for r in secret_markov.scan(docs, secret_markov.fit(docs)).collect()}
    plain = lambda d: [(s["kind"], s["start"], s["end"]) for s in found[d]]
    assert plain(100) == [("markov", 2, 34)] and found[100][0]["score"] >= secret_markov.THRESHOLD
    assert plain(101) == [("assign", 0, 20), ("assign", 22, 36)]
    assert plain(102) == [("access", 0, 20)] and plain(103) == [("hex", 0, 24)]
    assert plain(104) == plain(105) == plain(107) == []
    assert plain(106) == [("assign", 0, 39), ("hex", 7, 39)]
    assert secret_markov.scan(empty(docs), secret_markov.fit(empty(docs))).count() == 0


# ------------------------------------------------------------------ 6
def test_language_model_counts_and_normalisation(spark, monkeypatch):
    monkeypatch.setattr(lbl_lm, "BLOCK_BYTES", 3_000)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["The", "of", "a", f"w{int(rng.paretovariate(0.6)) % 500}"]) for _ in range(rng.randrange(1, 80)))) for i in range(300)]
    rows += [(900, None), (901, ""), (901, ""), (902, "x y Z\x0bq"), (None, "the of")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), "word", "c", "block", "keys")
    out = lbl_lm.scores(docs, remainder("doc_id", 10) == 0).collect()
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\0"] for i, t in rows}
    count = Counter()
    for i, _ in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            count.update(tokens[i])
    n, v = sum(count.values()), len(count)
    assert len(out) == len(rows)
    for r in out:
        t = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0 and math.isfinite(r["score"])
    assert lbl_lm.scores(empty(docs), F.lit(False)).count() == 0
    model = lbl_lm.LogBilinear(lbl_lm.OUTPUTS, seed=2)
    every = [float(np.exp(model.log_probabilities(np.array([3, 9, y], np.int32), np.array([0]))[2])) for y in range(lbl_lm.OUTPUTS)]
    assert math.isclose(sum(every), 1.0, rel_tol=1e-4)


def test_every_block_is_trained(spark, monkeypatch):
    """Blocks of one document of 300 words; of the first by hash the document is held out."""
    monkeypatch.setattr(lbl_lm, "START_TOKENS", 700)
    first = spark.range(12).orderBy(F.xxhash64("id"), "id").first()[0]
    order = [r[0] for r in spark.range(12).orderBy(F.xxhash64("id"), "id").collect()]
    words, rows = [b"", *(b"w%d" % i for i in range(20))], []
    rng = np.random.default_rng(1)
    for block in range(12):
        ids = [1]
        while len(ids) < 300:
            ids.append(ids[-1] % 20 + 1 if rng.random() < 0.9 else int(rng.integers(1, 21)))
        ids.append(0)
        held = block == first
        n = np.bincount(ids, minlength=21) * (not held)
        rows.append(([block], [held], [301], ids, words, n.tolist(), block))
    table = spark.createDataFrame(rows, "keys array<long>, held array<boolean>, sizes array<int>, ids array<int>, "
                                        "words array<binary>, counts array<long>, block long").repartition(5)
    counts = lbl_lm._pairs(table).filter("n > 0").groupBy("word").agg(F.sum("n").alias("c"))
    sh = lbl_lm.shares(counts)
    total = sh.output_tokens()
    assert total[0] == 11 and total.sum() == 11 * 301 and total[1:21].sum() == 11 * 300
    ids, starts = lbl_lm._first_tokens(table, sh)
    assert len(ids) == 700 and starts.tolist() == [0, 301, 602]
    model = lbl_lm.fit(table, sh)
    assert np.allclose(model.b[21:1 + lbl_lm.WORDS], model.b[21], atol=0.5) and model.b[1] > model.b[21]
    some = lbl_lm.fit(table.filter(F.col("block").isin(order[:4])), sh)  # the same starting tokens
    assert not np.allclose(model.flat(), some.flat(), atol=1e-5)


def test_weights_of_a_large_corpus_come_from_all_blocks(spark, monkeypatch, tmp_path):
    """Above START_TOKENS no block starts the weights alone: all train, each in a round, and the driver reads no tokens."""
    monkeypatch.setattr(lbl_lm, "START_TOKENS", 700)
    monkeypatch.setattr(lbl_lm, "PART_TOKENS", 700)
    monkeypatch.setattr(lbl_lm, "JOIN_TOKENS", 1)
    monkeypatch.setattr(lbl_lm, "_first_tokens", lambda *_: pytest.fail("a sample of the tokens"))
    words, rows = [b"", *(b"w%d" % i for i in range(20))], []
    for block in range(24):
        ids = [1 + (7 * i + block) % 20 for i in range(300)] + [0]
        rows.append(([block], [False], [301], ids, words, np.bincount(ids, minlength=21).tolist(), block))
    made = spark.createDataFrame(rows, "keys array<long>, held array<boolean>, sizes array<int>, ids array<int>, "
                                       "words array<binary>, counts array<long>, block long")
    made.repartition(24, "block").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/blocks")
    table = spark.read.parquet(f"{tmp_path}/blocks")
    for blocks in (made, table):  # by hash, by file
        parts = [{r[0] for r in p.select("block").collect()} for p in lbl_lm._dealt(blocks, 6)]
        assert sum(map(len, parts)) == 24 and set().union(*parts) == set(range(24))
    sh = lbl_lm.shares(lbl_lm._pairs(made).groupBy("word").agg(F.sum("n").alias("c")))
    assert np.isfinite(lbl_lm.fit(table, sh).flat()).all()
    whole = lbl_lm.fit(made, sh).flat()
    for gone in (0, 11, 23):
        assert not np.allclose(whole, lbl_lm.fit(made.filter(F.col("block") != gone), sh).flat(), atol=1e-6)


def test_every_round_of_a_large_corpus_trains_all_blocks(spark, monkeypatch):
    """F8: a round trained one of up to six parts, so a block was trained once, or twice if there were four parts."""
    monkeypatch.setattr(lbl_lm, "START_TOKENS", 700)
    trained = []
    monkeypatch.setattr(lbl_lm, "_one_round", lambda table, sh, noise, begin, *a: trained.extend(
        r["block"] for r in table.select("block").collect()) or begin)
    table = spark.range(24).select(F.col("id").alias("block"))
    sh = lbl_lm.Shares(24 * 301, 21, [b"w%d" % i for i in range(20)], np.full(20, 360.0), np.zeros(lbl_lm.CLASSES), np.zeros(lbl_lm.CLASSES))
    for part_tokens in (100, 1_800, 100_000):  # six, four parts and one
        monkeypatch.setattr(lbl_lm, "PART_TOKENS", part_tokens)
        trained.clear()
        lbl_lm.fit(table, sh)
        assert sorted(trained) == sorted([*range(24)] * lbl_lm.ROUNDS)


def test_noise_contrastive_training_learns_context():
    rng = np.random.default_rng(0)
    ids = np.zeros(60_000, np.int32)
    for i in range(1, len(ids)):  # an output mostly names the next one
        ids[i] = (ids[i - 1] * 7 + 3) % 40 if rng.random() < 0.8 else rng.integers(0, 40)
    starts = np.arange(0, len(ids), 100)
    noise = (np.bincount(ids, minlength=40) + 0.5) / (len(ids) + 20)
    model = lbl_lm.LogBilinear(40)
    model.b = np.log(noise).astype(np.float32)
    before = model.log_probabilities(ids, starts).mean()
    for n in range(4):
        model.train(ids, starts, noise, 0.02, n, 0.005, 24)
    assert model.log_probabilities(ids, starts).mean() > before + 0.5


# ------------------------------------------------------------------ 7
def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    path = public_tokenizer()
    whole = Tokenizer.from_file(path)
    odd = ["a <|endoftext|> b", "x<|endoftext|>y<|startoftext|>", "<|ENDOFTEXT|> <|endoftext", "", "Hello, WORLD. a.. b,. x., ,", "a\x01b \x01", "x\x1cy\x85z w　q", "<|endoftext|> hi", "É é ΣΑΣ ́",
           "it's I'LL 12 345\n\n!!?a", "word" * 40 + " b", "你好 🙂🙂x", "İstanbul ﬁ"]
    for t, ids in zip(odd, packing_swap.encode([t.encode() for t in odd], path)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_idle_workers_forget_their_words(monkeypatch):
    monkeypatch.setattr(packing_swap, "FORGET_AFTER", 0.2)
    path, texts = public_tokenizer(), [b"some words, some of them twice", b"words"]
    first, memory = packing_swap.encode(texts, path), packing_swap._tokenizer(path)[2]
    until = time.monotonic() + 20
    while (memory["new"] or memory["old"]) and time.monotonic() < until:
        time.sleep(0.1)
    assert not memory["new"] and not memory["old"]
    assert packing_swap.encode(texts, path) == first and memory["new"]


@pytest.mark.parametrize("seed", range(6))
def test_local_search_packs_all_within_capacity(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, rng.choice([200, 900, 4095])) for _ in range(rng.choice([1, 30, 1200]))]
    bins = packing_swap.pack_lengths(sizes)
    assert sorted(itertools.chain.from_iterable(bins)) == list(range(len(sizes)))
    fill = [sum(sizes[i] for i in b) for b in bins]
    assert max(fill) <= 4096
    if len(sizes) > 1000 and max(sizes) < 1000:
        assert len(bins) <= math.ceil(sum(sizes) / 4096) + 1


def test_packing_round_trip(spark):
    docs = with_clashes(awkward(spark), "piece", "grp", "fill", "doc")
    out = packing_swap.packed(docs, public_tokenizer(), capacity=512, group=4)
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for seq in by.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 512
    text = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null").collect()}
    for d in (1, 3, 4, 6, 8):
        ids = np.frombuffer(packing_swap.encode([(text[d] or "").encode()], public_tokenizer())[0], "<u4").tolist() + [1]
        mine = sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["piece"])
        want = [(p, s, zlib.crc32(np.array(ids[s:s + 512], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 512))]
        assert [(r["piece"], r["start"], r["ids_crc32"]) for r in mine] == want
    assert sum(r["doc_id"] == 2 and r["piece"] == 0 for r in rows) == 2
    assert packing_swap.packed(empty(docs), public_tokenizer()).count() == 0


# ------------------------------------------------------------------ 10
def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    insults, prose = ["scumbag", "idiotic", "loweish", "loweien", "trashy"], ["sun", "tree", "house", "blue", "walk", "river"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = [rng.choice(prose) + str(rng.randrange(300)) for _ in range(25)] + ([rng.choice(insults)] * 2 if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w).title()))
        labels.append((i, int(toxic)))
    rows += [(2000, None), (2001, ""), (2002, "q " * 20_000)]
    labels += [(0, 1), (None, 1), (5000, 1), (7, None)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), "key", "y", "on")
    lab = with_clashes(spark.createDataFrame(labels, "doc_id long, toxic int"), "key", "n")
    held = remainder("doc_id", 4) == 2
    model = weak_toxicity.fit(docs, lab, learn=~held)
    out = {r["doc_id"]: r for r in weak_toxicity.scored(docs.withColumn("held", held), model).collect()}
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[2000]["score"] < 0.3 and out[2001]["score"] < 0.3
    hit = [(out[i]["score"] >= 0.3) == (i % 6 == 0) for i in range(900) if out[i]["held"]]
    assert sum(hit) >= 0.98 * len(hit)
    assert {r["score"] for r in weak_toxicity.scored(docs, weak_toxicity.fit(docs, empty(lab))).collect()} == {float(1 / (1 + np.exp(40.0)))}
    assert weak_toxicity.scored(empty(docs), model).count() == 0


def test_rare_toxic_words_beside_many_frequent_ones(spark):
    """More frequent ordinary features than any list of candidates by frequency would hold."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    prose, insults = [word(8) for _ in range(2500)], ["zz" + word(7) for _ in range(20)]
    rows, labels = [], []
    for i in range(800):
        toxic = i % 2 == 0
        w = rng.sample(prose, 1200) + ([insults[i // 2 % 20]] if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = remainder("doc_id", 4) == 2
    model = weak_toxicity.fit(docs, lab, learn=~held)
    out = weak_toxicity.scored(docs.filter(held), model).collect()
    hit = [(r["score"] >= 0.3) == (r["doc_id"] % 2 == 0) for r in out]
    assert sum(hit) >= 0.95 * len(hit)


def test_label_model_recovers_rates():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < 0.01) for a in (0.6, 0.5, 0.4)], 1)
    votes = np.c_[votes, votes[:, 0]].astype(float)  # the last voter repeats the first
    post, rates, weight = weak_toxicity.label_model(votes, 0.2)
    assert ((post > 0.5) == y).mean() > 0.93 and weight[0] == weight[3] == 0.5 and weight[1] == 1
    assert rates[1, 0] > 0.4 and rates[0, 0] < 0.1


# ------------------------------------------------------------------ the pipeline
def test_pipeline_stages_keep_their_contracts(spark):
    import corpus_pipeline
    from conftest import SF001
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        rows = out.collect()
        now = {r["doc_id"] for r in rows}
        assert now <= ids and (name in ("line_dedup", "packing") or len(rows) == len(now))
        ids = now
        docs = spark.createDataFrame(rows, out.schema)
    assert ids


def test_pipeline_stages_on_awkward_and_empty_tables(spark):
    import corpus_pipeline
    from conftest import SF001
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(docs), SF001).count() == 0
        out = stage(spark, docs, SF001)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
    assert out.count() > 0
