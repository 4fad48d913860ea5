"""Centroid clustering, substring dedup by seeds and fill-in-middle against brute force, on awkward inputs too."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flightmart.llm import fim, pivots, registry, seed_dedup
from test_llm_documents import SF, WORD, awkward, table, texts  # noqa: F401  (fixtures)


def rows(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("name, tables", [
    ("op11_pivot_clusters", "embeddings"), ("op12_seed_dedup", "documents"), ("op13_fill_in_middle", "documents")])
def test_query_matches_sql(spark, name, tables):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view {tables} as select * from read_parquet('{SF}/{tables}.parquet')")
    res = con.execute(registry.ORACLES[name])
    cols = [d[0] for d in res.description]
    want = Counter(tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall())
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols) and rows(got) == want


# -- centroid clustering ---------------------------------------------------------

def brute_clusters(vectors, dimensions, count, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]

    def name(i):
        return hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()

    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:count]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        groups = {}
        for (c, _), (_, v) in zip(assign(), kept, strict=True):
            groups.setdefault(c, []).append(v)
        for c, vs in groups.items():
            centroids[c] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return Counter((i, c, d) for (i, _), (c, d) in zip(kept, assign(), strict=True)), centroids


def vector_table(spark, data):
    """Vectors with clashing extra columns."""
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in data],
                                 "vec_id long, embedding array<float>, cluster int, v string, n double")


@pytest.mark.parametrize("count", [1, 3, 7, 40])
def test_clusters_match_brute_force(spark, count):
    rnd = random.Random(count)
    near = [[rnd.choice([-1.5, -1, 0, 0.25, 1, 3]) for _ in range(4)] for _ in range(60)]      # many ties
    far = [[rnd.uniform(-50, 50) for _ in range(4)] for _ in range(60)]
    same = [[1.0, 1.0, 1.0, 1.0]] * 30
    bad = [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 1.0, 1.0], [1.0, float("nan"), 1.0, 1.0],
           [float("inf"), 1.0, 1.0, 1.0], [1.0, 1.0, 1.0, float("-inf")]]
    data = list(enumerate(near + far + same + bad)) + [(None, near[0]), (None, far[0]), (5, near[5]), (5, far[1])]
    data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]
    got, centroids = pivots.clustered(vector_table(spark, data), dimensions=4, centroids=count)
    want, expected = brute_clusters(data, 4, count, pivots.ROUNDS)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got.collect()) == want
    assert centroids.tolist() == expected


def test_empty_centroids_stay_and_fewer_vectors_than_centroids(spark):
    data = [(i, [2.0, 2.0, 2.0, 2.0]) for i in range(5)] + [(9, [-1.0, 0.0, 0.0, 0.0])]
    got, centroids = pivots.clustered(vector_table(spark, data), dimensions=4)
    want, expected = brute_clusters(data, 4, 40, pivots.ROUNDS)
    assert len(centroids) == 6 and centroids.tolist() == expected
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got.collect()) == want


def test_no_vectors(spark):
    got = pivots.digests(vector_table(spark, [(1, None), (2, [1.0])]))
    assert got.collect() == []
    full = pivots.digests(vector_table(spark, [(1, [0.5] * 64)]))
    assert sorted(full.columns) == sorted(got.columns) and full.first().distance == 0


def test_components_beyond_the_exact_range_fail(spark):
    with pytest.raises(Exception, match="don't fit a long"):
        pivots.digests(vector_table(spark, [(1, [1e9] * 64)])).collect()
    widest = [(1, [float(1 << 19)] * 64), (2, [-float(1 << 19)] * 64)]
    got, _ = pivots.clustered(vector_table(spark, widest), centroids=1, rounds=0)
    assert max(r.distance for r in got.collect()) == 64 << 56


def test_pivot_bounds_rule_out_most_centroids_and_no_nearest_one():
    rng = np.random.default_rng(3)
    middles = rng.integers(-2000, 2000, (40, 64))
    x = middles[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 64))
    fixed = pivots.spread_pivots(middles)
    far = np.sqrt(pivots.squared(x, fixed).astype(float))
    best, dist, measured = pivots.nearest(x, far, middles, fixed)
    every = pivots.squared(x, middles)
    assert (best == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
    assert measured < 0.2 * every.size


# -- substring dedup --------------------------------------------------------------

def brute_cut(data, window=seed_dedup.WINDOW):
    big = 1 << 63
    docs = [((big if i is None else i), WORD.findall(t or "")) for i, t in data]
    first = {}
    for i, w in docs:
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, (big + 1, 0)), (i, p))
    out = Counter()
    for (i, _), (key, w) in zip(data, docs, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (key, p):
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[(i, len(w), len(gone), kept)] += 1
    return out


def cut(spark, data):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept)
                   for r in seed_dedup.without_repeats(table(spark, data)).collect())


def test_cut_texts_match_brute_force(spark, awkward):  # noqa: F811
    assert cut(spark, awkward) == brute_cut(awkward)


def test_cut_matches_brute_force_on_few_words_and_edited_copies(spark):
    """Periodic texts, copies with edits closer than a window, and passages of about one window."""
    rnd = random.Random(11)
    data = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 90)))) for i in range(40)]
    data += [(100, "a " * 500), (101, "a " * 19), (102, "a " * 20), (103, "ab " * 60)]
    base = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
    for i in range(40):
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        lo = rnd.randrange(0, 60)
        data.append((200 + i, " ".join(w[lo:lo + rnd.randrange(10, 120)])))
    passage = [f"p{i}" for i in range(26)]
    for i in range(40):                                   # 18 to 26 words in surroundings of their own
        lo = rnd.randrange(0, 5)
        part = passage[lo:lo + rnd.randrange(18, 27)]
        data.append((300 + i, " ".join([f"l{i}-{j}" for j in range(15)] + part + [f"r{i}-{j}" for j in range(15)])))
    data += [(205, "another text " + " ".join(base[:40])), (205, None), (None, " ".join(base)), (None, " ".join(base))]
    assert cut(spark, data) == brute_cut(data)


def test_maximal_repeats_name_their_source(spark):
    base = [f"w{i}" for i in range(100)]
    data = [(1, " ".join(base)), (2, " ".join(["x"] * 7 + base[10:80] + ["y"] * 3)), (3, " ".join(base[:19])),
            (4, " ".join(base[50:75] + ["z"] + base[20:45]))]
    got = {(r.id, r.start, r.end, r.from_id, r.from_start) for r in seed_dedup.repeats(table(spark, data)).collect()}
    assert got == {(2, 7, 77, 1, 10), (4, 0, 25, 1, 50), (4, 26, 51, 1, 20)}


def test_a_group_of_copies_makes_rows_in_proportion(spark):
    """Copies of a passage in surroundings of their own: matches grow with the copies, not their square."""
    def count(n):
        data = [(i, " ".join([f"a{i}-{j}" for j in range(25)] + [f"p{j}" for j in range(30)] + [f"b{i}-{j}" for j in range(25)]))
                for i in range(n)]
        return seed_dedup.matches(table(spark, data)).count()
    assert count(120) <= 2.2 * count(60)


def test_anchors_of_equal_windows_are_equal():
    rnd = random.Random(2)
    words = [rnd.choice(["a", "b", "c"]) for _ in range(400)]
    batch = seed_dedup.Words(pa.array([" ".join(words), " ".join(words[100:200])]))
    batch.hash_runs()
    at, text = seed_dedup.anchors(batch)
    places = set(at.tolist())
    for t, lo, hi in ((0, 0, 400), (1, 400, 500)):
        for p in range(lo, hi - seed_dedup.WINDOW + 1):
            inside = [a - p for a in range(p, p + seed_dedup.REACH + 1) if a in places]
            assert inside, "every window holds an anchor"
    starts = {p for p in places if p < 400}
    assert {p - 400 + 100 for p in places if p >= 400} <= starts


# -- fill in the middle -------------------------------------------------------------

def brute_fim(doc_id, text):
    import re

    t = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, t)
    if h4 % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_matches_brute_force_and_restores(spark, awkward):  # noqa: F811
    rnd = random.Random(4)
    odd = ["<P>", "a <S> b", "x<M", "<P", "P>", "<", ">", "a<", "<P >", " ", "\n\n", "é ", " é", "日本 語", "\x1c\x85", "　x",
           "<S", "M> <", "𝒳 𝒴", "a\x00b"]
    data = list(awkward) + [(5000 + i, "".join(rnd.choice(odd) for _ in range(rnd.randrange(1, 9)))) for i in range(800)]
    got = fim.restored(fim.transformed(table(spark, data))).collect()
    want = Counter((*brute_fim(i, t), t or "") for i, t in data)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_outputs_that_do_not_fit_their_form(spark):
    data = [("psm", "<P>a<S>b<M>c"), ("psm", "<S>a<P>b<M>c"), ("spm", "<S>a<P>b<M>c"), ("psm", "no marks"), ("spm", ""),
            ("psm", "<P>a<S>b<M>c<M>"), ("plain", "<P>x"), ("psm", "x<P>a<S>b<M>c"), (None, "as it is"), ("psm", None)]
    df = spark.createDataFrame([(o, f, "old") for f, o in data], "output string, form string, text string")
    got = {(r.form, r.output): r.text for r in fim.restored(df).collect()}
    assert got[("psm", "<P>a<S>b<M>c")] == "acb" and got[("spm", "<S>a<P>b<M>c")] == "bca"
    assert got[("plain", "<P>x")] == "<P>x" and got[(None, "as it is")] == "as it is"
    assert [v for k, v in got.items() if k[0] in ("psm", "spm")].count(None) == len(data) - 4


@pytest.mark.parametrize("fn", [seed_dedup.digests, seed_dedup.repeats, fim.digests])
def test_empty_tables(spark, fn):
    assert fn(table(spark, [])).collect() == []
    assert fn(table(spark, [(1, None), (2, "")])).count() in (0, 2)
