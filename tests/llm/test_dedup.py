"""Near-duplicate operators against brute force, and their defined edge cases."""

import random

import numpy as np
import pytest

from regspark.llm.components import connected_components, local_roots
from regspark.llm.embedding_dedup import embedding_links, linked_pairs
from regspark.llm.minhash import minhash_groups, near_duplicates_dropped
from regspark.llm.shingles import superminhash


def components(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_chains_stars_and_duplicates(spark, tmp_path):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (2000, 2001), (2001, 2000)]
    links += [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(250)]
    rng.shuffle(links)
    edges = spark.createDataFrame(links + [(None, 3)], "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    want = components({x for e in links for x in e}, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert all(got.get(x, x) == want[x] for x in touched)
    assert connected_components(edges.where("false")).count() == 0


def test_local_roots():
    a, b = np.array([3, 4, 6]), np.array([2, 3, 5])
    assert local_roots(7, a, b).tolist() == [0, 1, 2, 2, 2, 5, 5]


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[100:])
        sig = superminhash([a, b], 64)
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.03
    assert np.std(errors) < 0.0625  # plain MinHash with 64 slots
    # every slot of a set smaller than the signature is filled, from the same permutation
    one = superminhash([np.array([7], np.uint64)], 16)[0]
    assert sorted(one >> 22) == list(range(16))


def brute_groups(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(list(sets), links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def corpus(seed=5, families=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 220))]
        for _ in range(rng.randint(1, 7)):
            text = base[:]
            for _ in range(rng.choice((0, 0, 1, 2, 4, 8, 16))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, rng.choice((" ", "\n", "\t ")).join(text).title() if rng.random() < 0.2 else " ".join(text)))
            n += 1
    return rows


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_minhash_groups_match_brute_force(spark, width, percent):
    rows = corpus() + [(9000, ""), (9001, None), (9002, " \t\n"), (9003, "one"), (9004, "ONE"), (9005, "a b"), (9006, "A  b")]
    # a long chain: each text close to the next only
    words = [f"x{i}" for i in range(130)]
    rows += [(9100 + k, " ".join(words[2 * k : 2 * k + 100])) for k in range(12)]
    got = minhash_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_groups(rows, width, percent)


def test_minhash_hot_buckets_are_tiled_without_loss(spark, monkeypatch):
    import regspark.llm.minhash as module

    monkeypatch.setattr(module, "TILE_DOCS", 8)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(160):  # variants near the threshold of each other
        text = base[:]
        for at in rng.sample(range(120), rng.randint(2, 6)):
            text[at] = f"v{rng.randrange(50)}"
        rows.append((i, " ".join(text[: rng.randint(100, 120)])))
    got = minhash_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_groups(rows, 3, 85)


def test_minhash_null_ids_repeats_extra_columns_and_empty(spark):
    rows = [(1, "a b c d e f g", "x", 5), (2, "a b c d e f g", "y", 6), (None, "a b c d e f g", "z", 7), (2, "a b c d e f g", "y", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_shingles int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash_groups(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 1, False), (2, 1, False), (None, None, True)], key=str)
    kept = near_duplicates_dropped(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]
    clash = df.toDF("doc_id", "text", "DOC_ID", "TEXT")  # names that differ in case only
    assert near_duplicates_dropped(clash).columns == clash.columns and near_duplicates_dropped(clash).count() == 2
    assert minhash_groups(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        minhash_groups(df.drop("text"))


def brute_vectors(rows, threshold):
    """rows: (id, vector, label); link counts by row position, components by id."""
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    links, counts = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] \
                    and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                counts[i] += 1
                links.append((rows[i][0], rows[j][0]))
    comp = components([r[0] for r in rows], links)
    return sorted((r[0], n, comp[r[0]], comp[r[0]] == r[0]) for r, n in zip(rows, counts))


@pytest.mark.parametrize("tile", [4, 64])
def test_embedding_links_match_brute_force(spark, tile):
    rng = np.random.default_rng(2)
    rows = []
    for family in range(14):
        base = rng.standard_normal(24)
        for k in range(rng.integers(1, 12)):
            v = base + rng.standard_normal(24) * rng.choice([0, 0.05, 0.2, 0.3])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(family % 3)))
    rows += [(500, None, 1), (501, [0.0] * 24, 1), (502, [float("nan")] + [1.0] * 23, 1), (503, [1.0] * 24, None),
             (504, [float("inf")] * 24, 1), (505, [None] + [1.0] * 23, 1), (506, [], 1), (507, [1.0, 2.0], 1), (508, [2.0, 4.0], 1),
             (509, [-0.0, 1.0], 1), (510, [0.0, 1.0], 1), (511, [1e150, 1e150], 2), (512, [1.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = sorted(tuple(r) for r in embedding_links(df, 0.93, tile=tile).collect())
    assert got == brute_vectors(rows, 0.93)


def test_embedding_empty_repeats_and_null_id(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0], 1, "a"), (4, [1.0, 0.0], 1, "a"), (None, [1.0, 0.0], 1, "b"), (9, [1.0, 0.01], 1, "c")],
                               "vec_id long, embedding array<double>, label int, kept string")
    got = sorted((tuple(r) for r in embedding_links(df).collect()), key=str)
    assert got == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 0, None, False), (9, 2, 4, False)], key=str)
    assert embedding_links(df.where("false")).count() == 0


def test_early_stopping_is_exact():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((80, 40)) * np.geomspace(1, 0.01, 40)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = linked_pairs(x, x, axes, 0.7, True)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(a, b) for a in range(80) for b in range(a + 1, 80) if u[a] @ u[b] >= 0.7}
    assert set(zip(i.tolist(), j.tolist())) == want
