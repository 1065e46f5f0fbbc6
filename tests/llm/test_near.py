"""Near-duplicate operators against brute force."""

import random

import numpy as np

from tracewell.llm import near_vectors, ngram_join
from tracewell.llm.spark_util import components


def _sets(rows):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def _brute(ids, linked):
    parent = {i: i for i in ids}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_jaccard_join(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows, n = [], 0
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 12, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            rows.append((n, text + (" " + passage if group % 3 == 0 else "")))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "Two Words"), (n + 4, "two\x0bwords"), (n + 5, "two words "), (n + 6, "one"), (n + 6, "one"), (n + 7, passage.upper())]
    sets = _sets(rows)
    linked = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = _brute([r[0] for r in rows], linked)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (2, 128):
        got = ngram_join.near_duplicates(docs.withColumn("node", docs["doc_id"]), frequent=frequent).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert sorted((r["doc_id"], r["n_shingles"]) for r in got) == sorted((i, len(s)) for (i, _), s in zip(rows, sets))
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (200, 201), (200, 201)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 32))
    close = base[:150] + rng.normal(size=(150, 32)) * 0.15
    hot = base[:1] + rng.normal(size=(700, 32)) * 0.01
    x = np.vstack([base, close, hot, base[5:6].repeat(3, 0), -base[7:8], 3 * base[8:9]]).astype(np.float32)
    unit = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = unit.astype(float) @ unit.T.astype(float) >= 0.95
    np.fill_diagonal(s, False)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(9000, None, 1), (9001, [0.0] * 32, 1), (9002, [float("nan")] * 32, 1), (9003, [float("inf")] + [0.0] * 31, 1), (9004, [], 1), (9005, [None] * 32, 1)]
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, links int")).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= s.sum(1)).all() and links.sum() >= 0.97 * s.sum()
    want = _brute(range(len(x)), [(i, j) for i, j in zip(*np.nonzero(s)) if i < j])
    assert sum(got[i]["component_id"] == want[i] for i in want) >= 0.98 * len(want)
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i, *_ in odd)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert near_vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_near_vectors_of_several_lengths(spark):
    """Directions of unequal weight around a common offset, in three lengths at once, with repeated ids and columns named like inner ones."""
    rng = np.random.default_rng(8)
    rows, want_links, want = [], {}, {}
    for at, d in ((0, 48), (10_000, 20), (20_000, 1)):
        x = rng.normal(size=(700, d)) / np.arange(1, d + 1) + 0.3 * rng.normal(size=d)
        x = np.vstack([x, x[:200] + rng.normal(size=(200, d)) * 0.1 / np.arange(1, d + 1), x[:3]])
        unit = near_vectors.unit(x)
        s = unit @ unit.T >= 0.95
        np.fill_diagonal(s, False)
        rows += [(at + i, v.tolist(), 0, 0) for i, v in enumerate(x)]
        want_links |= {at + i: int(k) for i, k in enumerate(s.sum(1))}
        want |= _brute([at + i for i in range(len(x))], [(at + i, at + j) for i, j in zip(*np.nonzero(s)) if i < j])
    rows += [rows[5], rows[5]]
    got = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, low int")).collect()
    assert len(got) == len(rows)
    found = {r["vec_id"]: r["n_links"] for r in got}
    assert all(found[i] <= want_links[i] for i in found) and sum(found.values()) >= 0.95 * sum(want_links.values())
    assert sum(r["component_id"] == want[r["vec_id"]] for r in got) >= 0.95 * len(got)


def test_recall_at_the_threshold():
    """New pairs with a cosine of exactly 0.95 meet in a table and are within the radius."""
    rng = np.random.default_rng(2)
    d = 64
    centres, offset = rng.normal(size=(200, d)), rng.normal(size=d) * 0.2
    kinds = {
        "isotropic": lambda m: rng.normal(size=(m, d)),
        "clustered": lambda m: centres[rng.integers(0, 200, m)] + 0.7 * rng.normal(size=(m, d)),
        "falling": lambda m: rng.normal(size=(m, d)) / np.arange(1, d + 1),
        "falling around an offset": lambda m: rng.normal(size=(m, d)) / np.arange(1, d + 1) + offset,
    }
    for name, make in kinds.items():
        sample, other = near_vectors.unit(make(4096)), near_vectors.unit(make(3000))
        for n in (10_000, 10**8):
            index = near_vectors.learn(sample, n)
            for a, b in near_vectors.threshold_pairs(other, 0.95, seed=77):
                (ka, wa), (kb, wb) = index.codes(a), index.codes(b)
                met = near_vectors._met(ka ^ kb, wa, wb).any(1) & (np.bitwise_count(ka ^ kb).sum(1) <= index.radius)
                assert met.mean() >= 0.95, (name, n)
