"""Decontamination, top-k, SimHash, lines and passages against brute force and on awkward rows."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import compact_windows, fuzzy_lines, impact_topk, simhash_ball, wu_manber
from llm.helpers import awkward, empty, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


# ------------------------------------------------------------------ 1
def _contamination_brute(docs, items, k=10):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(k, len(w))
        for s in range(len(w) - n + 1 if w and i is not None else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    ids |= wins[tuple(w[s:s + n])]
        out.append((d, len(w), len(hit), sorted(ids)))
    return out


def test_contamination_equals_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(30)] + ["Élan", "a", "b"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, text(14)), (2, text(12)), (2, text(12)), (3, "A, b"), (4, None), (5, "..."), (None, text(11)), (6, "zz")]
    docs = [(i, " ".join(filter(None, [text(rng.randrange(40)), rng.choice(items)[1], text(rng.randrange(40)), "A...b"[: rng.randrange(6)]])))
            for i in range(60)] + [(60, None), (61, ""), (61, ""), (None, items[0][1])]
    want = sorted(map(str, _contamination_brute(docs, items)))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def got():
        rows = wu_manber.contamination(with_clashes(d, "doc", "txt", "items"), i).collect()
        return sorted(str((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]))) for r in rows)

    assert got() == want
    monkeypatch.setattr(wu_manber, "PATTERNS_PER_BLOCK", 5)  # items in several blocks
    assert got() == want
    kept = wu_manber.drop_contaminated(d, i)
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(x[0]) for x in _contamination_brute(docs, items) if not x[2])


def test_contamination_on_awkward_rows(spark):
    docs = awkward(spark)
    items = docs.selectExpr("doc_id as item_id", "text")
    assert wu_manber.contamination(docs, items).count() == docs.count()
    assert wu_manber.contamination(docs, empty(items)).agg({"n_hit": "sum"}).first()[0] == 0
    assert wu_manber.contamination(empty(docs), items).count() == 0


# ------------------------------------------------------------------ 2
def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in (rng.normal(size=8) if i % 7 else np.ones(8))], 1) for i in range(300)]
    rows += [(300, None, 1), (301, [1.0, None] + [0.0] * 6, 1), (302, [float("nan")] + [0.0] * 7, 1),
             (303, [float("inf")] + [0.0] * 7, 1), (304, [], 1), (None, [0.0] * 8, 1), (350, [0.0] * 8, 1)]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), "score", "rank", "key")
    valid = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _ in rows
             if i is not None and v and None not in v and all(map(math.isfinite, v))}
    want = []
    for q in sorted(i for i in valid if i % 50 == 0):
        best = sorted((-int(valid[q] @ valid[c]), c) for c in valid if c != q)[:5]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    monkeypatch.setattr(impact_topk, "WAVES", 7)
    got = impact_topk.top_k(df, df.filter("vec_id % 50 = 0"), 5, block=64, query_block=3)
    assert sorted(map(tuple, got.collect())) == want
    few = df.filter("vec_id < 3")
    assert impact_topk.top_k(few, few, 5).count() == 6
    assert impact_topk.top_k(empty(df), df, 5).count() == 0 and impact_topk.top_k(df, empty(df), 5).count() == 0


@pytest.mark.parametrize("scale", [1.0, 5e3, 2e4, 1e5, 1e7, 1e30])
def test_top_k_of_large_components(scale):
    """Scores of any size: exact integers up to 64 bits, beyond that the largest ones, ties to the smaller id."""
    rng = np.random.default_rng(int(scale) % 1000)
    cut = lambda v: np.clip(np.floor(256 * v), -2.0 ** 62, 2.0 ** 62)
    rows = np.array([[int(x) for x in v] for v in cut(rng.normal(size=(300, 16)) * scale)], np.int64)
    ids = rng.permutation(1000)[:300]
    index = impact_topk.Index(ids, rows)
    exact = rows.astype(object) @ rows.astype(object).T
    for i in range(0, 300, 3):
        best = sorted((-max(min(exact[i][j], 2 ** 63 - 1), 1 - 2 ** 63), ids[j]) for j in range(300) if j != i)[:5]
        assert index.top(rows[i], ids[i], 5) == [(-s, j) for s, j in best]


def test_queries_keep_their_block_in_any_row_order(spark):
    """The plan deals queries by no row number, and other orders of the rows give the same blocks."""
    df = spark.createDataFrame([(i, [float(i % 13), float(i), 1.0]) for i in range(400)], "vec_id long, embedding array<float>")
    ask = impact_topk.quantised(df)
    blocks = [{r["key"]: r["qb"] for r in impact_topk.dealt_queries(d, 5).collect()}
              for d in (ask, ask.repartition(7), ask.orderBy(F.desc("key")))]
    assert blocks[0] == blocks[1] == blocks[2] and set(blocks[0].values()) == set(range(5))
    top = impact_topk.top_k(df.filter("vec_id < 50"), df, 3, block=20, query_block=64)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("monotonically_increasing_id") == 1  # the candidates only


# ------------------------------------------------------------------ 9
def test_fingerprint_links_keep_all_components(spark):
    """Random balls, a dense family of over SMALL members and pairs that differ inside one block only."""
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1]
    fps = set(seeds)
    for s in seeds:
        for _ in range(6):
            x = s
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            fps.add(x)
    centre = rng.getrandbits(64)
    for _ in range(300):  # a family in which most are near each other
        x = centre
        for b in rng.sample(range(64), rng.randrange(0, 3)):
            x ^= 1 << b
        fps.add(x)
    for lo, hi in simhash_ball.BLOCKS:
        x = rng.getrandbits(64)
        fps |= {x, x ^ (0b111 << lo), x ^ (0b111 << lo) ^ (0b101 << (hi - 3)) ^ (1 << (lo + 4))}
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    want = {f: root(f) for f in fps}
    signed = lambda x: x - 2**64 if x >> 63 else x
    from ledgerlens.llm.common import connected_components
    comp = {r["node"]: r["component"] for r in connected_components(simhash_ball.fingerprint_links(
        spark.createDataFrame([(signed(f),) for f in fps], "fp long"))).collect()}
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups({f: comp.get(signed(f), signed(f)) for f in fps}) == groups(want)


def test_fingerprint_by_definition():
    import xxhash
    t = "A b  c\td E f b c D"
    w = t.lower().split()
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(len(w) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    got = simhash_ball.fingerprints([t.encode(), b"", b" x ", ("é " * 600).encode()])
    assert int(got[0]) == want and got[1] == 0 and int(got[2]) == xxhash.xxh64_intdigest(b"x", 42)
    assert int(got[3]) == xxhash.xxh64_intdigest("é é é".encode(), 42)


def test_near_duplicates_on_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "fp", "cls", "lead", "row")
    out = simhash_ball.near_duplicate_classes(docs)
    comp = {r["doc_id"]: r["component"] for r in out.collect()}
    assert out.count() == docs.count() and comp[1] == comp[2] == 1 and comp[3] == comp[4] == comp[5] == 3
    kept = simhash_ball.keep_one_per_class(docs)
    assert kept.columns == docs.columns and kept.count() == len({r["component"] for r in out.collect()})
    assert simhash_ball.keep_one_per_class(empty(docs)).count() == 0
    assert simhash_ball.near_duplicate_classes(empty(docs)).count() == 0


# ------------------------------------------------------------------ 8
def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def _lines_brute(rows):
    import xxhash
    norm = lambda s: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", s.lower()).strip(" ")
    first, occ = {}, []
    for d, t in sorted(set(rows)):
        for p, line in enumerate(t.split("\n")):
            if norm(line):
                first.setdefault(norm(line), (d, p))
                occ.append((d, p, norm(line)))
    bits = {}
    for n in first:
        hs = [xxhash.xxh64_intdigest(w.encode(), 42) for w in n.split(" ")]
        bits[n] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    parent = {n: n for n in first}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(first, 2):
        if (bits[a] ^ bits[b]).bit_count() <= 3 and _distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
            parent[root(a)] = root(b)
    keep = {}
    for n, p in first.items():
        keep[root(n)] = min(keep.get(root(n), p), p)
    return {(d, p) for d, p, n in occ if keep[root(n)] != (d, p)}


def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(200)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 60))) for _ in range(25)]

    def variant(line):
        w = line.split()
        if len(w) > 20 and rng.random() < 0.7:
            w[rng.randrange(len(w))] = rng.choice(vocab)
        return rng.choice(["", " - "]) + " ".join(w).upper() + rng.choice(["", "!", "\r"])

    rows = [(d, "\n".join(variant(rng.choice(base)) if rng.random() < 0.8 else "" for _ in range(6))) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = fuzzy_lines.removed_lines(docs)
    got = {(r["doc"], p) for r in gone.collect() for p in r["removed"]}
    assert got == _lines_brute(rows) and got
    out = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(docs).collect()}
    text = dict(rows)
    for d, t in out.items():
        assert t == "\n".join(x for p, x in enumerate(text[d].split("\n")) if (d, p) not in got)


def _line_copies(edit, seed=4, n=30):
    """Lines of 3 to 60 words, each in one document, and a copy with an edit in another."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    rows, wanted = [], {}
    for size in (3, 5, 8, 10, 15, 20, 30, 60):
        for _ in range(n):
            base = " ".join(word() for _ in range(size))
            copy = edit(rng, base, word)
            if _distance(base, copy) <= int(max(len(base), len(copy)) * 0.2 + 1e-9):
                wanted[len(rows) + 1] = size
                rows += [(len(rows), base), (len(rows) + 1, copy)]
    return rows, wanted


def _typo(rng, line, word):
    at = rng.randrange(len(line))
    return line[:at] + rng.choice("abcdefgh") + line[at + 1:]


def _replaced(rng, line, word):
    w = line.split(" ")
    for at in rng.sample(range(len(w)), max(1, len(w) // 10)):
        w[at] = word()
    return " ".join(w)


@pytest.mark.parametrize("edit", [_typo, _replaced])
def test_near_lines_of_all_lengths_are_found(spark, edit):
    rows, wanted = _line_copies(edit)
    gone = fuzzy_lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), rule=fuzzy_lines.EDIT)
    got = {r["doc"] for r in gone.collect()}
    found = {size: sum(d in got for d, s in wanted.items() if s == size) / sum(s == size for s in wanted.values())
             for size in sorted(set(wanted.values()))}
    print(edit.__name__, found)
    assert got <= set(wanted) and min(found.values()) >= 0.9


def test_line_sketches_run_without_python(spark):
    plan = fuzzy_lines.occurrences(awkward(spark), "doc_id", "text", fuzzy_lines.EDIT)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_line_dedup_on_awkward_rows(spark, monkeypatch):
    docs = with_clashes(awkward(spark), "th", "doc", "removed", "pos")
    out = fuzzy_lines.dedup_lines(docs)
    rows = out.collect()
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in rows]
    assert 2 not in ids and {1, 3, 4, 5, 6, 8} <= set(ids)  # a copy goes, blank and null texts stay
    assert next(r["text"] for r in rows if r["doc_id"] == 3) is None
    assert fuzzy_lines.dedup_lines(empty(docs)).count() == 0
    monkeypatch.setattr(fuzzy_lines, "BROADCAST_ROWS", 0)  # the way without broadcast gives the same
    assert sorted(map(str, fuzzy_lines.dedup_lines(docs).collect())) == sorted(map(str, rows))


def test_lines_run_without_python(spark):
    plan = fuzzy_lines.occurrences(awkward(spark), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


# ------------------------------------------------------------------ 4
def test_compact_windows_partition_all_subsequences():
    rng = np.random.default_rng(0)
    for n, least in ((60, 5), (90, 46), (45, 46), (46, 46), (120, 10)):
        v = rng.permutation(n).astype(np.uint64) + np.uint64(1)
        seen = {}
        for f, c, last in zip(*compact_windows.compact_windows(v, least)):
            for x in range(f, c + 1):
                for y in range(max(c, x + least - 1), last + 1):
                    assert (x, y) not in seen and v[x:y + 1].min() == v[c]
                    seen[(x, y)] = c
        assert len(seen) == sum(1 for x in range(n) for y in range(x + least - 1, n))


def test_planted_passages_are_found_and_others_left(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    passage, short, long = prose(55), prose(30), prose(200)
    near = list(long)
    near[100] = "changed"
    docs = [(i, prose(rng.randrange(60)) + passage + prose(rng.randrange(60))) for i in range(12)]
    docs += [(20, prose(40) + long), (21, near + prose(70)), (30, prose(80) + short), (31, short + prose(90)), (40, prose(300))]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    out = {r["doc_id"]: r for r in compact_windows.repeated_passages(df).collect()}
    for d, w in docs[:12]:
        at = next(i for i in range(len(w)) if w[i:i + 55] == passage)
        assert [(s["first"], s["last"]) for s in out[d]["spans"]] == [(at, at + 54)] and out[d]["component"] == 0
    assert out[21]["component"] == 20 and out[20]["n_words_repeated"] >= 190
    assert all(out[d]["n_passages"] == 0 and out[d]["component"] == d for d in (30, 31, 40))


def test_passages_of_common_shingles_are_found(spark):
    """Every shingle of the passages also occurs in many unrelated texts."""
    rng = random.Random(3)
    prose = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    docs, n = [], 0
    passages = [prose(70) for _ in range(6)]
    for p in passages:
        for _ in range(2):
            docs.append((n, prose(30) + p + prose(30)))
            n += 1
    for p in passages:
        for _ in range(40):
            pieces = [p[i:i + 7] for i in range(0, 64)]
            rng.shuffle(pieces)
            docs.append((1000 + n, [w for piece in pieces for w in piece + prose(3)]))
            n += 1
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    out = {r["doc_id"]: r for r in compact_windows.repeated_passages(df).collect()}
    found = [out[d + 1]["component"] == d and out[d]["n_words_repeated"] >= 50 for d in range(0, 12, 2)]
    assert all(found), found
    assert all(r["n_passages"] == 0 for d, r in out.items() if d >= 1000)


def test_passages_behind_foreign_first_texts_are_found(spark):
    """Parts of the passage, too short to be alike, lie in many other texts, one of which is the first of most buckets."""
    rng = random.Random(11)
    prose = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    passages = [prose(52) for _ in range(4)]
    docs = []
    for i, p in enumerate(passages):
        whole = prose(40) + p + prose(40)
        docs += [(10 * i, whole), (10 * i + 1, prose(45) + p + prose(45)), (10 * i + 2, whole)]
        docs += [(1000 * (i + 1) + 100 * at + n, prose(45) + p[at:at + 44] + prose(45)) for at in range(9) for n in range(25)]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    out = {r["doc_id"]: r for r in compact_windows.repeated_passages(df).collect()}
    for i in range(4):
        assert [out[10 * i + k]["component"] for k in range(3)] == [10 * i] * 3, i
        assert out[10 * i + 1]["n_words_repeated"] >= 50 and out[10 * i + 2]["n_words_repeated"] == 132
    assert all(r["n_passages"] == 0 for d, r in out.items() if d >= 1000)


def test_rest_of_a_bucket_is_all_other_pairs(monkeypatch):
    monkeypatch.setattr(compact_windows, "PAIRS_AT_ONCE", 7)
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(0, 6, 60)) * 8
    group, ref = rng.integers(0, 4, 60), rng.integers(0, 30, 60)
    reach, centre = np.full(60, (0 << 32) | 90), np.arange(60, dtype=np.int32)
    got = [(r["ref"], r["rep"], r["centre"], r["diag"]) for b in compact_windows._rest_of(key, group, ref, reach, centre) for r in b.to_pylist()]
    want = []
    for i in range(60):
        for j in range(i + 1, 60):
            if key[i] == key[j] and group[i] != group[j] and ref[i] != ref[j]:
                a, b = (i, j) if ref[i] > ref[j] else (j, i)
                want.append((ref[a], ref[b], centre[a], centre[a] - centre[b]))
    assert sorted(got) == sorted(want)


def test_passages_on_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "ref", "spans", "key", "grp")
    out = compact_windows.repeated_passages(docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == docs.count()
    assert rows[1]["component"] == rows[2]["component"] == rows[7]["component"] == 1 and rows[3]["n_passages"] == 0
    assert compact_windows.repeated_passages(empty(docs)).count() == 0


def test_alike_rejects_what_is_not_similar():
    a = np.arange(100)
    b = np.r_[np.arange(50), 1000 + np.arange(200), np.arange(50, 100)]
    parts = compact_windows.alike(a, b, 46, 0.8)
    assert parts and all(y - x >= 45 and y2 - x2 <= 60 for x, y, x2, y2 in parts)
    assert compact_windows.alike(a, 500 + a, 46, 0.8) == []


@pytest.mark.parametrize("least", [5, 46])
def test_shingles_of_joined_texts(least):
    h, n = compact_windows.shingle_hashes([b"a b c d e f", b"", b"x", b"A,b;c d  e", b"b c d e f"])
    assert n.tolist() == [2, 0, 0, 1, 1] and h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


def _wide_print(line):
    """The fingerprint of the rule WIDE as one number, by counting bits one by one."""
    import xxhash
    pad = f" {line} "
    parts = set(line.split(" ")) if len(line) > fuzzy_lines.LONG else {pad[i:i + 3] for i in range(len(pad) - 2)}
    seed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    out = 0
    for shift, size, own in ((0, 4 * fuzzy_lines.WIDE_SIZE, 42), (4 * fuzzy_lines.WIDE_SIZE, 3 * fuzzy_lines.WIDE_SIZE, seed)):
        hs = [xxhash.xxh64_intdigest(p.encode(), own) for p in parts]
        for i in range(size // 2):  # a sum holds the bits i and 32 + i of the hashes
            for at, bit in ((i, i), (size // 2 + i, 32 + i)):
                out |= (2 * sum(h >> bit & 1 for h in hs) > len(hs)) << shift + at
    return out


def test_wide_lines_equal_brute_force(spark):
    """Lines that meet, by blocks counted here one by one, and are alike: the same groups."""
    rows = [r for seed, edit in ((5, _typo), (6, _replaced)) for r in _line_copies(edit, seed, 4)[0]]
    rows = [(i, line) for i, (_, line) in enumerate(rows)]
    rows += [(len(rows) + i, line.upper() + " !\n" + line) for i, (_, line) in enumerate(rows[:6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    norm = lambda s: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", s.lower()).strip(" ")
    occ = [(d, p, norm(x)) for d, t in rows for p, x in enumerate(t.split("\n"))]
    bits = {n: _wide_print(n) for _, _, n in occ}
    parent = {n: n for n in bits}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    block = lambda v, b: v >> fuzzy_lines.WIDE_SIZE * b & (1 << fuzzy_lines.WIDE_SIZE) - 1
    for a, b in itertools.combinations(bits, 2):
        meet = sum(block(bits[a], k) == block(bits[b], k) for k in range(fuzzy_lines.WIDE_BLOCKS)) >= 2
        if (meet and (len(a) > fuzzy_lines.LONG) == (len(b) > fuzzy_lines.LONG)
                and (bits[a] ^ bits[b]).bit_count() <= fuzzy_lines.WIDE_BITS
                and _distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)):
            parent[root(a)] = root(b)
    keep = {}
    for d, p, n in occ:
        keep[root(n)] = min(keep.get(root(n), (d, p)), (d, p))
    expected = {(d, p) for d, p, n in occ if keep[root(n)] != (d, p)}
    got = {(r["doc"], p) for r in fuzzy_lines.removed_lines(docs, rule=fuzzy_lines.WIDE).collect() for p in r["removed"]}
    assert got == expected and len(got) > 12


def test_wide_lines_recall_by_length(spark):
    """Copies with one changed letter: nearly all of the long lines are found, and nothing else."""
    rows, wanted = _line_copies(_typo)
    gone = fuzzy_lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), rule=fuzzy_lines.WIDE)
    got = {r["doc"] for r in gone.collect()}
    found = {size: sum(d in got for d, s in wanted.items() if s == size) / sum(s == size for s in wanted.values())
             for size in sorted(set(wanted.values()))}
    print("wide", found)
    assert got <= set(wanted) and found[30] >= 0.8 and found[60] >= 0.8


def test_wide_lines_on_awkward_rows(spark, monkeypatch):
    docs = with_clashes(awkward(spark), "th", "doc", "removed", "pos")
    out = fuzzy_lines.dedup_lines(docs, rule=fuzzy_lines.WIDE)
    rows = out.collect()
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in rows]
    assert 2 not in ids and {1, 3, 4, 5, 6, 8} <= set(ids)
    assert next(r["text"] for r in rows if r["doc_id"] == 3) is None
    assert fuzzy_lines.dedup_lines(empty(docs), rule=fuzzy_lines.WIDE).count() == 0
    monkeypatch.setattr(fuzzy_lines, "BROADCAST_ROWS", 0)  # the way without broadcast gives the same
    assert sorted(map(str, fuzzy_lines.dedup_lines(docs, rule=fuzzy_lines.WIDE).collect())) == sorted(map(str, rows))
    lines = fuzzy_lines._hashed_lines(docs, "doc_id", "text")
    plan = fuzzy_lines.wide_fingerprints(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
