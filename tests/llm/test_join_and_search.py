"""Jaccard join and vantage-point search against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import op03_ngram_jaccard as jac
from shelfwise.llm import op06_vantage_point as vp


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [f"c{i}" for i in range(30)]
    rows = []
    for g in range(14):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 5, 7, 20, 60, 120]))] + common[:rng.choice([0, 12, 30])]
        for _ in range(rng.choice([1, 2, 6, 14])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), (" " if rng.random() < .5 else "\n").join(w)))
    rows += [(900, ""), (901, None), (902, "  \t "), (903, "w1"), (904, "W1"), (905, "w1 w2"), (906, "w1 w2 w3")]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (None, rows[3][1]), (1000, "é " * 4 + "A B C D"), (1001, "é " * 4 + "a b c d")]
    return rows


@pytest.mark.parametrize("k,percent,frequent", [(4, 85, 64), (5, 80, 3)])
def test_components_match_brute_force(spark, monkeypatch, k, percent, frequent):
    monkeypatch.setattr(jac, "MIN_FREQUENT", frequent)
    monkeypatch.setattr(jac, "LOCAL", 1)
    monkeypatch.setattr(jac, "FEW", 2)
    rows = corpus(k)
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows],
                               "doc_id long, text string, node string, n int, component int").repartition(5)
    got = jac.jaccard_components(df, k, percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows, k, percent)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 80), st.sampled_from([80, 85, 95]), st.floats(0, 1))
def test_similar_sets_share_a_signature(seed, n, percent, often):
    """The scheme's guarantee, for any choice of frequent tokens."""
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    y = np.unique(np.concatenate([np.delete(x, rng.integers(0, len(x), rng.integers(0, max(1, n // 8) + 1))),
                                  rng.integers(0, 2**63, rng.integers(0, max(1, n // 8) + 1), dtype=np.uint64)]))
    both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
    if not len(y) or 100 * both < percent * union or len(x) == len(y) == both:
        return
    every = np.union1d(x, y)
    frequent = np.sort(every[rng.random(len(every)) < often])
    (a, rare_a), (b, rare_b) = (jac.signatures(s, frequent, percent) for s in (x, y))
    least = -(-percent * (len(x) + len(y)) // (100 + percent))
    need = [p - len(s) + least for p, s in ((rare_a, x), (rare_b, y)) if p]
    assert len(np.intersect1d(a, b)) >= max(1, min(need, default=1))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(4, 150), st.sampled_from([80, 85, 95]), st.floats(0, 1))
def test_similar_sets_reach_each_other_by_a_difference(seed, n, percent, often):
    """Two sets that link are both linked to the center or have a difference from it in common, each within
    the other's reach, whatever tokens come last."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    change = lambda s, most: np.unique(np.concatenate([
        np.delete(s, rng.integers(0, len(s), rng.integers(0, most + 1))),
        rng.integers(0, 2**63, rng.integers(0, most + 1), dtype=np.uint64)]))
    center, x = change(base, n // 4), change(base, n // 4)
    y = change(x, n // 10)

    def similar(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= percent * (len(a) + len(b) - both)
    if not (len(center) and len(x) and len(y)) or not similar(x, y) or similar(x, center) and similar(y, center):
        return
    every = np.union1d(np.union1d(x, y), center)
    late = rng.permutation(every[rng.random(len(every)) < often])
    a, b = ({t: (e, r) for t, e, r in jac.differences(center, s, late, percent)} for s in (x, y))
    assert any(a[t][0] <= b[t][1] and b[t][0] <= a[t][1] and a[t][0] + b[t][0] > 0 for t in a.keys() & b.keys())


def test_documents_of_one_template_make_no_pairs(spark, monkeypatch):
    """A loose group without a link: nothing is left to check, however large the group."""
    rows = [(i, " ".join([f"t{j}" for j in range(120)] + [f"o{i}_{j}" for j in range(15)])) for i in range(300)]
    met = []
    apart = jac.Join._apart
    monkeypatch.setattr(jac.Join, "_apart", lambda self, r: met.append(apart(self, r)) or met[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jac.jaccard_components(df, 4, 85).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 300
    assert met[0].count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(1024, 9000), st.floats(0, 1))
def test_sketches_never_differ_in_more_than_their_sets(seed, n, share):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    y = np.unique(np.concatenate([x[rng.random(len(x)) < share], rng.integers(0, 2**63, rng.integers(0, 9000), dtype=np.uint64)]))
    if min(len(x), len(y)) >= jac.SKETCHED:
        assert jac.least_apart(jac.sketch(x), jac.sketch(y)) <= len(np.setxor1d(x, y))
    assert jac.sketch(x[:jac.SKETCHED - 1]) is None


def test_large_documents_of_one_passage_are_not_checked(spark, monkeypatch):
    """Their bitmaps are full and tell nothing: the sketches leave no pair of them; the two near copies link."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(200)]
    texts = [[f"o{i}_{j}" for j in range(4000)] + passage for i in range(6)]
    texts.append([w if rng.random() > .005 else "new" for w in texts[0]])
    met, meet = [], jac.Join._meet
    monkeypatch.setattr(jac.Join, "_meet", lambda self, pairs, *rest: met.append(pairs.count()) or meet(self, pairs, *rest))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jac.jaccard_components(df, 4, 85).collect()}
    assert got == {i: i for i in range(6)} | {6: 0}
    assert sum(met) == 1


def test_signatures_stay_linear():
    t = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64))
    assert len(jac.signatures(t, t, 85)[0]) < 2 * len(t)


def test_deduplicate_keeps_one_of_each(spark):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(3, text, "s"), (2, text, "s"), (2, text, "s"), (5, text + " end", "s"), (6, "quite another text of five words", "s"),
            (7, "", "s"), (8, None, "s"), (None, "only null id here in this row", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = jac.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(["2", "6", "7", "8", "None"])


def test_jaccard_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jac.jaccard_components(df, 4, 85).collect() == []
    assert jac.deduplicate(df).collect() == []


def test_chain_becomes_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in jac.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100


def vectors(n=1500, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(40, dim))[rng.integers(0, 40, n)] + 0.2 * rng.normal(size=(n, dim))
    v[50:80] = v[50]
    return v


def test_exact_search_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vp, "SHARD_ROWS", 300)
    monkeypatch.setattr(vp, "QUERY_BLOCK", 5)
    v = vectors()
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    bad = [(2000, None, 1), (2100, [0.0] * 12, 1), (2200, [float("nan")] + [1.0] * 11, 1), (2300, [None] + [1.0] * 11, 1),
           (2400, [float("inf")] * 12, 1), (None, [1.0] * 12, 1), (2500, [], 1), (2600, [1.0, 2.0], 1), (2700, [1.0, 2.5], 1), rows[7]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, v int")
    use = vp.usable(df)
    got = {}
    for r in vp.nearest(use, use.where("vec_id % 100 = 0"), 10, 1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 100)) | {2600, 2700}
    for q in range(0, 1500, 100):
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(len(v)), d)) if i != q][:10]
        assert [x[1] for x in sorted(got[q])] == best
        assert np.allclose([x[2] for x in sorted(got[q])], d[best], rtol=0, atol=1e-12)
    assert [x[1] for x in got[2600]] == [2700]


def test_relaxed_factor_looks_at_less_and_recalls_most():
    v = vectors(4000)
    ids = np.arange(len(v))
    tree = vp.VantagePointTree(ids, v)
    q = ids[::40]
    exact = tree.search(q, v[q], 10, 1.0)[1]
    all_seen, tree.visited = tree.visited, 0
    near = tree.search(q, v[q], 10, 0.6)[1]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, near, strict=True)])
    assert tree.visited < all_seen < len(v) * len(q)
    assert recall >= 0.9


def test_search_of_an_empty_table(spark):
    use = vp.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert vp.nearest(use, use).collect() == []
