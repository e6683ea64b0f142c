"""Vector codes, fingerprints and whitening against brute force."""

import hashlib
import random
from math import floor

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SMALL
from helixframe.llm import laesa, registry, simhash, whitening
from llm.conftest import prose

VECTORS = "vec_id long, embedding array<float>, label int, part int, n long, code string, i int, s string, dim int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows, parts=3):
    """rows: (vec_id, embedding, label); other columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, v, c, 1, 1, "x", 1, "x", 1) for i, v, c in rows], VECTORS).repartition(parts)


def odd_vectors(dim, n, seed=0, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (7, dim))
    vectors = (centre[rng.integers(0, 7, n)] + rng.normal(0, spread, (n, dim))).astype(np.float32)
    rows = [(int(i), v.tolist(), int(i) % 3 or None) for i, v in zip(rng.permutation(n) * 3, vectors)]
    rows += [(rows[0][0], rows[0][1], 2), rows[1], (None, vectors[3].tolist(), 1), (5000, vectors[4].tolist(), None)]
    return rows + [(9001, None, 1), (9002, [], 1), (9003, [NAN] * dim, 1), (9004, [INF] + [0.0] * (dim - 1), None), (9005, [None] + [1.0] * (dim - 1), 2), (-1, [0.5] * (dim + 4), 1)]


def fit_for_use(rows, dim):
    return [(i, [float(x) for x in v], c) for i, v, c in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]


def brute_codes(rows, parts=4, entries=256, rounds=4):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[floor(1024 * c) for c in v] for _, v, _ in rows], np.int64).reshape(len(rows), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for k in range(rounds + 1):
        d = [((x[:, p, None] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
        at = [e.argmin(axis=1) for e in d]
        if k < rounds:
            for p in range(parts):
                for e in set(at[p].tolist()):
                    mine = x[at[p] == e, p]
                    books[p][e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    error = sum(e.min(axis=1) for e in d)
    labels = {}
    for (_, _, c), e in zip(rows, error.tolist()):
        labels[c] = labels.get(c, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return sorted(((i, "".join(f"{at[p][r]:02x}" for p in range(parts)), int(error[r]), labels[c], digest) for r, (i, _, c) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("dim,n", [(8, 700), (16, 300), (4, 20)])
def test_codes_against_brute_force(spark, dim, n):
    rows = odd_vectors(dim, n)
    got = sorted((tuple(r) for r in laesa.coded(table(spark, rows)).collect()), key=repr)
    assert got == brute_codes(fit_for_use(rows, dim))


def test_codes_do_not_depend_on_partitions(spark):
    rows = odd_vectors(8, 400)
    assert sorted(laesa.coded(table(spark, rows, 1)).collect(), key=repr) == sorted(laesa.coded(table(spark, rows, 9)).collect(), key=repr)


def test_pivots_prune_and_never_change_the_nearest():
    rng = np.random.default_rng(5)
    book = rng.integers(-800, 800, (256, 4))
    book[7] = book[3]  # a tie
    x = np.concatenate((book[rng.integers(0, 256, 500)] + rng.integers(-30, 30, (500, 4)), book[:10], book[3:4]))
    pivots = laesa.choose_pivots(book)
    assert len({tuple(p) for p in pivots.tolist()}) == laesa.PIVOTS
    held = np.sqrt(laesa._squares(x, pivots).astype(float)).astype("<f4")
    index, best, done = laesa.nearest_entries(x, held, book, pivots)
    d = laesa._squares(x, book)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert done < d.size / 4


def test_codes_of_odd_tables(spark):
    assert laesa.coded(table(spark, [])).count() == 0
    assert laesa.coded(table(spark, [(1, None, 1), (2, [], 2)])).count() == 0
    (one,) = laesa.coded(table(spark, [(4, [0.25, 0.0, -0.0001, 1.0], None)])).collect()
    assert (one.vec_id, one.code, one.error, one.label_error) == (4, "00000000", 0, 0)
    assert one.codebooks_sha256 == hashlib.sha256(b"256,0,-1,1024").hexdigest()
    same = laesa.coded(table(spark, [(k, [1.0, 2.0, 3.0, 4.0], 1) for k in range(300)]))
    assert {r.code for r in same.collect()} == {"00000000"}
    with pytest.raises(ValueError):
        laesa.coded(table(spark, [(1, [1.0] * 6, 1)]))
    with pytest.raises(Exception, match="exceeds"):
        laesa.coded(table(spark, [(1, [1e30] * 4, 1)])).collect()


def test_reconstruction(spark):
    codes, books = laesa.compress(table(spark, odd_vectors(8, 300)))
    near = laesa.reconstruct(codes, books).join(codes, "vec_id").where("vec_id = 5000").collect()
    wanted = dict((i, v) for i, v, _ in odd_vectors(8, 300) if v)[5000]
    assert ((np.floor(np.array(wanted) * 1024) - np.array(near[0].approx) * 1024) ** 2).sum() == pytest.approx(near[0].error)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(fps))]


def check_documents(docs, rows):
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    root, least = brute_components(fps), {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    wanted = sorted(((i, f"{f:016x}", least.get(r)) for (i, _, _), f, r in zip(rows, fps, root)), key=repr)
    assert sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr) == wanted


def test_near_duplicates_against_brute_force(odd_docs, odd_rows):
    check_documents(odd_docs, odd_rows)


def test_fingerprints_of_odd_texts(monkeypatch):
    rng = random.Random(2)
    texts = ["", " \n", "one", "Ünd ONE", "a\x0bb\x0cc d", "x" * 5000, prose(rng, 3000), "a b " * 700, "w " * 2 + "  end"]
    whole = [simhash.fingerprint(t.encode()) for t in texts]
    assert whole == [brute_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "PIECE", 7)
    monkeypatch.setattr(simhash, "COUNTED", 5)
    assert whole == [simhash.fingerprint(t.encode()) for t in texts]


def flipped(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def test_every_three_bits_meet_under_a_chain_key(spark):
    rng = random.Random(9)
    pairs = []
    for k in range(3000):
        a = rng.getrandbits(64)
        pairs.append((a, flipped(rng, a, k % 6)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(a), signed(b), (a ^ b).bit_count()) for a, b in pairs], "a long, b long, d int")
    keys = F.array_intersect(simhash.chain_keys(F.col("a")), simhash.chain_keys(F.col("b")))
    held = df.select("d", F.exists(keys, lambda k: simhash._within_chain(F.col("a"), F.col("b"), k)).alias("linked"))
    assert held.where((F.col("d") <= 3) != F.col("linked")).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_components_of_fingerprints(spark, monkeypatch, block):
    """Chains in which ends are far apart, dense clusters without a centre, bridges between clusters, and unrelated ones."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    fps = {0, (1 << 64) - 1, 1 << 63, 7}
    for _ in range(4):
        base = rng.getrandbits(64)
        fps |= {flipped(rng, base, rng.choice((2, 3, 4, 5))) for _ in range(60)}
        for _ in range(25):
            base = flipped(rng, base, rng.choice((1, 3, 3, 4)))
            fps.add(base)
    base, low = rng.getrandbits(64), rng.sample(range(40), 8)
    fps |= {base ^ sum(1 << b for k, b in enumerate(low) if m >> k & 1) for m in range(256) if m.bit_count() % 2}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    label = {r.node: r.component for r in simhash.near_components(spark.createDataFrame([(v, rng.randint(1, 3)) for v in signed], "fp long, copies long")).collect()}
    got, wanted = {}, {}
    for v, r in zip(signed, brute_components(fps)):
        got.setdefault(label.get(v, v), set()).add(v)
        wanted.setdefault(r, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_no_documents(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def brute_whitened(rows):
    x = [[floor(64 * c) + 1000000 for c in v] for _, v, _ in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    z = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    e, u = np.linalg.eigh(z.T @ z / n)
    return n, deviation, z, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("dim,n,scale", [(6, 200, 1.0), (40, 300, 1.0), (8, 100, 1e4), (12, 5, 1.0)])
def test_whitening_against_brute_force(spark, dim, n, scale):
    rows = [(i, v and [x if x is None else x * scale for x in v], c) for i, v, c in odd_vectors(dim, n)]
    kept = fit_for_use([(i, v and [x if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows], dim)
    count, deviation, z, e, u = brute_whitened(kept)
    got = whitening.whitened(table(spark, rows)).toPandas()
    k = min(32, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == count * k and set(got["n"]) == {count} and got["component"].max() == k
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    first = got[got["component"] == 1]
    assert sorted(first["deviation"].astype(int)) == sorted(deviation)
    ids = [i for i, _, _ in kept]
    for c in range(k):
        mine = got[got["component"] == c + 1]
        assert mine["explained"].iloc[0] == pytest.approx(e[c] / e.sum(), rel=1e-9)
        w = dict(zip(zip(mine["vec_id"].fillna(-7).astype(int), mine["deviation"]), mine["whitened"]))
        mine = np.array([w[(-7 if i is None else i, d)] for i, d in zip(ids, deviation)]) if scale == 1 else np.sort(mine["whitened"].to_numpy())
        wanted = z @ u[:, c] / np.sqrt(e[c])
        wanted = (wanted, -wanted) if scale == 1 else (np.sort(wanted), np.sort(-wanted))
        assert min(np.abs(mine - s).max() for s in wanted) < 1e-6


def test_eigen_of_a_hard_matrix():
    """Eigenvalues over many orders of size, some equal, some zero."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    e = np.concatenate((np.logspace(0, 8, 20), [5.0] * 4, [0.0] * 6))
    values, vectors = whitening.eigen((q * e) @ q.T)
    assert values == pytest.approx(np.sort(e)[::-1][: len(values)], rel=1e-6) and len(values) >= 24
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    order, factor = whitening.pivoted_cholesky(np.diag([1.0, 3.0, 2.0]))
    assert order.tolist() == [1, 2, 0] and (np.triu(factor, 1) == 0).all()


def test_whitening_of_odd_tables(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0], 1)] * 5)).count() == 0  # nothing varies
    line = whitening.whitened(table(spark, [(k, [k / 64, 2 * k / 64, 5.0], 1) for k in range(5)])).collect()
    assert sorted((r.vec_id, round(r.whitened, 9)) for r in line) == sorted((k, round((k - 2) / 2**0.5, 9)) for k in range(5)) or sorted((4 - r.vec_id, round(r.whitened, 9)) for r in line) == sorted((k, round((k - 2) / 2**0.5, 9)) for k in range(5))
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
    huge = whitening.whitened(table(spark, [(k, [k * 1e9, -1.0], 1) for k in range(3)])).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in huge) and any(r.deviation is None for r in huge)


def test_as_registered(spark):
    """The registered queries on the small tables, against brute force."""
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in registry.QUERIES["op11_laesa_codes"](spark, SMALL).collect()), key=repr) == brute_codes(rows)
    count, deviation, z, e, u = brute_whitened(rows)
    got = registry.QUERIES["op13_whitening"](spark, SMALL).toPandas().sort_values(["component", "vec_id"])
    assert dict(zip(got["vec_id"], got["deviation"])) == {i: d for (i, _, _), d in zip(rows, deviation)}
    order = np.argsort([i for i, _, _ in rows])
    for c in range(32):
        w = got["whitened"].to_numpy()[c * count : (c + 1) * count]
        wanted = (z @ u[:, c] / np.sqrt(e[c]))[order]
        assert min(np.abs(w - wanted).max(), np.abs(w + wanted).max()) < 1e-6
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    fps = [(r.doc_id, r.text, None) for r in docs.collect()]
    check_documents(docs, fps)
    assert registry.QUERIES["op12_simhash"](spark, SMALL).columns == ["doc_id", "fingerprint", "component_id"]
