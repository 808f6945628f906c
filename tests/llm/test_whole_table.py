"""Centroid clustering, suffix-array dedup and the filter audit against plain Python."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from regspark.llm import centroids, filter_audit, induced_sort, suffix_dedup

SF = "/root/testdata/sf0.001"


# --- centroid clustering --------------------------------------------------------------

def plain_clusters(rows, k, rounds, dims, scale):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cent = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        own = [[v for _, v in kept if near(v)[1] == j] for j in range(len(cent))]
        cent = [[sum(col) // len(vs) for col in zip(*vs)] if vs else c for vs, c in zip(own, cent)]
    if not cent:
        return []
    best = [(i, *near(v)[::-1]) for i, v in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return [(i, j, d, sum(e for _, x, e in best if x == j), sum(e for *_, e in best), names[j]) for i, j, d in best]


def test_clusters_match_plain_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [0.25] * 6) for i in range(300, 340)] + [(5, rows[5][1]), (None, rows[7][1]), (900, None), (901, [0.1] * 5),
             (902, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, V int")
    for k, lead in ((16, 3), (5, 6)):
        got = [tuple(r) for r in centroids.cluster_vectors(df, k, 3, 6, 64, lead).collect()]
        assert sorted(got, key=str) == sorted(plain_clusters(rows, k, 3, 6, 64), key=str)
    for none in (df.where("false"), df.where("vec_id IS NULL"), df.where("vec_id > 900 AND vec_id < 905")):
        assert centroids.cluster_vectors(none, 16, 3, 6).collect() == []
    with pytest.raises(Exception, match="do not fit a long"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [3e9])], "vec_id long, embedding array<double>"), dims=1).collect()


def test_bounds_rule_out_centroids_without_changing_the_nearest():
    rng = np.random.default_rng(4)
    x = (rng.normal(0, 1, (500, 1, 16)) * np.r_[np.full(4, 90.0), np.full(12, 4.0)] + rng.integers(-300, 300, (1, 1, 16))).reshape(500, 16).astype(np.int64)
    cent = x[:12].copy()
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :5]
    cluster, best, measured = centroids.nearest(x, *centroids.rotated(x, axes), cent, axes)
    d = ((x[:, None] - cent[None]) ** 2).sum(axis=2)
    assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert len(x) <= measured < 0.5 * d.size


# --- induced suffix sorting ---------------------------------------------------------------

@pytest.mark.parametrize("block, leaf, budget", [(1, 1, 1), (3, 2, 50), (16, 8, 1 << 20), (1 << 16, 1024, 1 << 20)])
def test_induced_order_and_prefixes(monkeypatch, block, leaf, budget):
    monkeypatch.setattr(induced_sort, "BLOCK", block)
    monkeypatch.setattr(induced_sort, "LEAF", leaf)
    rng = random.Random(block)
    for _ in range(100):
        s = [rng.randrange(rng.choice([1, 2, 3, 5, 200])) for _ in range(rng.randint(1, 50))]
        s = s * rng.choice([1, 1, 2, 5]) + [0] * rng.choice([0, 0, 30]) + s[: rng.randint(0, 9)]
        text = np.array([x + 1 for x in s] + [0], np.uint16)
        depth, got, common = rng.choice([1, 3, 10, 400]), [], []

        def emit(pos, lcp, _):
            got.extend(pos.tolist())
            common.extend(lcp.tolist())

        induced_sort.sorted_suffixes(text, max(s) + 2, depth, emit, budget)
        t = text.tolist()
        assert got == sorted(range(len(s)), key=lambda i: t[i:], reverse=True)
        for a, b, n in zip(got, got[1:], common[1:]):
            assert n == next((k for k in range(depth) if t[a + k] != t[b + k]), depth)


def test_queue_spills_and_keeps_the_order(monkeypatch):
    monkeypatch.setattr(induced_sort, "BLOCK", 64)
    rng = np.random.default_rng(1)
    for keys, expected in ((40, 10_000), (5000, 10_000)):
        queue = induced_sort.SymbolQueue(keys, expected, 500)
        key = rng.integers(0, keys, 10_000)
        for a in range(0, 10_000, 700):
            part = np.arange(a, min(10_000, a + 700))
            queue.push(induced_sort.Tuples(key[part], part, np.zeros(len(part), np.uint16)))
        assert queue.file is not None and queue.held <= 500
        out = []
        while len(rows := queue.head(100)[0]):
            out += rows.pos.tolist()
            queue.take(len(rows))
        assert out == np.argsort(key, kind="stable").tolist()


# --- suffix-array dedup ---------------------------------------------------------------------

def plain_repeats(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = np.flatnonzero(gone & ~np.append(False, gone[:-1])).size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_match_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, line = prose(120), prose(25)  # the line alone is shorter than a string
    texts = [prose(rng.randint(0, 200)) for _ in range(20)]
    texts += [prose(30) + " " + passage[rng.randint(0, 40):] + prose(20) for _ in range(15)]
    texts += [prose(rng.randint(50, 90)) + line + prose(60) for _ in range(60)]
    texts += [texts[0]] * 3 + [None, "", "x" * 399, "y" * 400, " " * 2000, "ab" * 900, " " * 500, passage, prose(3000) + passage + prose(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, passage), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "q", b"z") for i, t in rows], "doc_id long, text string, tid string, bytes binary")
    want = sorted(((i, *w) for (i, _), w in zip(rows, plain_repeats([t for _, t in rows], 400))), key=str)
    assert sum(w[2] for w in want) > 10_000 and any(w[3] > 0 and w[2] < w[1] for w in want)
    for kwargs in ({}, {"hot_segments": 3, "shard_bytes": 20_000}):
        assert sorted((tuple(r) for r in suffix_dedup.drop_repeats(df, **kwargs).collect()), key=str) == want
    assert suffix_dedup.drop_repeats(df.where("false")).collect() == []
    assert suffix_dedup.drop_repeats(df.where("text IS NULL")).collect()[0].n_bytes == 0


def test_repeats_match_brute_force_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain_repeats([r.text for r in rows], 400)))
    assert sorted(tuple(r) for r in suffix_dedup.drop_repeats(docs).collect()) == want


def test_batches_in_memory_give_what_induction_gives(monkeypatch):
    rng = random.Random(12)
    for _ in range(60):
        letters, length = rng.choice(["a", "ab", "abc", "abcdefgh"]), rng.choice([2, 3, 5, 8, 20, 43, 44, 100])
        parts = ["".join(rng.choice(letters) for _ in range(length + rng.choice([0, 3, 40]))).encode() for _ in range(rng.randint(1, 12))]
        weights = [rng.choice([1, 1, 2]) for _ in parts]
        want = suffix_dedup.repeated_starts(parts, weights, length)
        assert suffix_dedup.repeated_starts_in_memory(parts, weights, length) == want
    # whole keys share a batch; only a key beyond it is sorted by induction
    keys, parts = [3, 1, 3, 2, 1, 3], [b"abcabc", b"xyxyx", b"cabcab", b"q" * 40, b"yxyxy", b"zzzabc"]
    by_hand = {0: [[0, 4]], 1: [[0, 3]], 2: [[0, 4]], 3: [[0, 38]], 4: [[0, 3]], 5: [[3, 4]]}
    calls, induction = [], suffix_dedup.repeated_starts
    monkeypatch.setattr(suffix_dedup, "repeated_starts", lambda p, w, n: calls.append(p) or induction(p, w, n))
    for size, beyond in ((1000, []), (20, [[parts[3]]]), (1, [[parts[1], parts[4]], [parts[3]], [parts[0], parts[2], parts[5]]])):
        calls.clear()
        assert dict(suffix_dedup._runs_by_key(keys, parts, [1] * 6, 3, size)) == by_hand
        assert calls == beyond


def test_equal_strings_share_a_key():
    rng = np.random.default_rng(8)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    data[3000:3600] = data[500:1100]
    data[[499, 1100, 2999, 3600]] = [97, 97, 98, 98]  # equal there and no further
    first, _, _ = suffix_dedup.start_keys(data, 400)
    hot = np.unique(first)
    for finer in ((), ((24, hot),), ((24, hot), (1, np.unique(suffix_dedup.start_keys(data, 400, ((24, hot),))[0])))):
        key, _, live = suffix_dedup.start_keys(data, 400, finer)
        assert live.all() and (key[500:701] == key[3000:3201]).all()
    assert len(np.unique(key)) == len(key) - 201  # one place: the key is the string
    assert [suffix_dedup.rolling_hash(data[:40], n).size for n in (1, 7, 32, 40)] == [40, 34, 9, 1]


# --- filter audit ------------------------------------------------------------------------------

def plain_audit(docs, labels):
    import re

    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = []
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        bad |= {"A"} if len(words) < 100 else set()
        bad |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        bad |= {"D"} if re.search("[#$%&*|]", t) else set()
        bad |= {"E"} if i is not None and i > first[t] else set()
        fails.append((lang or "", bad, any(d == i and q == 1 for d, q, _ in labels if d is not None),
                      any(d == i and x == 1 for d, _, x in labels if d is not None)))
    rows, removed_by = [], {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                everywhere = [f for f in own if letter in f[1]]
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(removed)
                rows.append([part, "".join(order), step, len(left), len(removed), len(everywhere) - len(removed) - sum(
                    1 for f in everywhere if not (set(order[: step - 1]) & f[1]) and f not in removed),
                    sum(f[1] == {letter} for f in own), sum(f[2] for f in removed), sum(f[3] for f in removed), letter])
    return sorted((*r[:-1], removed_by[r[0], r[-1]]) for r in rows)


def test_audit_matches_plain_filters(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["A#", "BIG", "LOUD", "x|y"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([5, 90, 120, 200]))) for _ in range(60)]
    texts += [" ".join(f"u{i}" for i in range(150)), None, "", "ABC " * 200, "a\x0bb\x0cc\x1dd\xa0e " * 40, "É" * 300, "x " * 100_000]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(150)]
    docs += [(7, docs[7][1], "en"), (None, docs[3][1], "en"), (None, "only here", None), (149, docs[2][1], "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 140, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    d = spark.createDataFrame([(*r, 1, "m") for r in docs], "doc_id long, text string, lang string, mask int, part string")
    ls = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int, DOC_ID2 int")
    want = plain_audit(docs, labels)
    for cells in (None, 1 << filter_audit.BLOCK_BITS):
        assert sorted(tuple(r) for r in filter_audit.audit_filters(d, ls, cells).collect()) == want
    assert filter_audit.audit_filters(d.where("false"), ls).collect() == []
    bare = filter_audit.audit_filters(d, ls.where("false")).collect()
    assert sum(r.good_lost + r.toxic_lost for r in bare) == 0 and len(bare) == len(want)


def test_sketch_never_clears_a_repeated_text(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK_BITS", 8)
    rng = random.Random(6)
    texts = [f"text {rng.randrange(700)}" for _ in range(1000)]
    cells = filter_audit.sketch_cells(len(texts))
    sketch = filter_audit.counting_sketch(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7), cells)
    cleared = [t for t in texts if filter_audit.seen_once(sketch, filter_audit.text_hash(t.encode()), cells)]
    assert all(texts.count(t) == 1 for t in cleared)
    assert len(cleared) > 0.7 * sum(texts.count(t) == 1 for t in texts)
    assert all(a != b for a, b in (filter_audit.text_cells(filter_audit.text_hash(str(i).encode()), 256) for i in range(500)))
