"""Deduplication, models, search, mixing and the pipeline: brute force, held-out accuracy, invariants."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from helixframe.llm import mixing, ngram_join, nn_descent, pitman_yor, quality_crf, repeat_groups, repeats
from helixframe.llm.components import components
from helixframe.llm.storage import documents
from llm.conftest import make_docs, prose


def words(t):
    return (t or "").encode().lower().split()


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes_of(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, (i, _, _) in enumerate(rows):
        if i is not None and (least[find(k)] is None or i < least[find(k)]):
            least[find(k)] = i
    return [(i, len(sets[k]), least[find(k)]) for k, (i, _, _) in enumerate(rows)]


def chain_rows():
    """Chains of near copies in which ends are not linked, stars, and texts at the threshold and just below."""
    rng = random.Random(8)
    rows = []
    for g in range(6):
        w = prose(rng, 60).split()
        for k in range(8):
            rows.append((1000 + 100 * g + k, " ".join(w), "a"))
            w = list(w)
            w[rng.randrange(len(w))] = f"x{g}{k}"
    base = prose(rng, 104).split()
    for k in range(60):
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"y{rng.randint(0, 40)}"
        rows.append((3000 + k, " ".join(w), "a"))
    return rows


def test_ngram_classes(spark, odd_docs, odd_rows, no_docs):
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(ngram_join.classes(odd_docs).collect()) == key(classes_of(odd_rows))
    rows = chain_rows()
    assert key(ngram_join.classes(make_docs(spark, rows)).collect()) == key(classes_of(rows))
    assert ngram_join.classes(no_docs).count() == 0


def test_blocks_and_common_shingles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    monkeypatch.setattr(ngram_join, "COMMON_DOCS", 6)
    rows = chain_rows()
    assert sorted(map(tuple, ngram_join.classes(make_docs(spark, rows)).collect())) == sorted(classes_of(rows))


def test_shingles_alike_in_half_their_bits_stay_apart(monkeypatch):
    """Hashes that differ in their upper halves only, many of them in one fragment: keys of a set stay distinct, and overlaps are exact."""
    texts = [t for _, t, _ in chain_rows()]
    real = ngram_join.shingle_sets
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda *a: ((h := real(*a))[0] & ~np.uint64(0xFFFFFFFF), h[1]))
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    told = lambda batches: pd.concat([b.to_pandas() for b in batches])
    cut = told(ngram_join._cut(5, 2, np.zeros(0, np.uint64))([batch]))
    shared = pd.concat([ngram_join._fragment(2)(g) for _, g in cut.groupby("frag")])
    active = pd.concat([ngram_join._activate(75, 2)(g) for _, g in shared.groupby("bucket")])
    keys = {s: np.concatenate([np.frombuffer(k, "<i8") for k in g.sort_values("part")["keys"]]) for s, g in active.groupby("sig")}
    assert len(keys) > 60 and all((np.diff(k) > 0).all() for k in keys.values())
    assert all(len(keys[s]) == g["shared"].iloc[0] for s, g in active.groupby("sig"))
    n = {s: g["n"].iloc[0] for s, g in active.groupby("sig")}
    got = sorted((int(n[a]), int(n[b]), len(np.intersect1d(keys[a], keys[b]))) for a in keys for b in keys if a < b)
    sets = {frozenset(shingles(t)) for t in texts}
    held = Counter(x for s in sets for x in s)
    sets = [s for s in sets if sum(held[x] > 1 for x in s) >= -(-75 * len(s) // 100)]
    want = Counter(tuple(sorted((len(a), len(b)))) + (len(a & b),) for k, a in enumerate(sets) for b in sets[:k])
    assert Counter(tuple(sorted(x[:2])) + x[2:] for x in got) == want


def test_one_document_of_each_class_stays(spark, odd_docs, odd_rows):
    kept = ngram_join.representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    want = Counter(c if n else i for i, n, c in set(classes_of(odd_rows)) if not n or i == c)
    assert ids == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got.get(x, x) == find(x) for x in parent)


def removed(rows, least):
    seen = Counter()
    texts = [(t or "").encode() for _, t, _ in rows]
    for b in texts:
        seen.update(b[i : i + least] for i in range(len(b) - least + 1))
    out = []
    for (i, _, _), b in zip(rows, texts):
        cover = bytearray(len(b))
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                cover[k : k + least] = b"\1" * least
        runs = sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))
        out.append((i, len(b), sum(cover), runs, sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest()))
    return sorted(out, key=repr)


def passages(rows, least):
    """Words within strings of `least` words that start at two places, and their runs; in the order of removed()."""
    texts = [(t or "").encode().lower().split() for _, t, _ in rows]
    where = Counter(tuple(b[i : i + least]) for b in texts for i in range(len(b) - least + 1))
    out = []
    for (i, t, _), b in zip(rows, texts):
        cover = [False] * len(b)
        for k in range(len(b) - least + 1):
            if where[tuple(b[k : k + least])] > 1:
                cover[k : k + least] = [True] * least
        out.append((i, len((t or "").encode()), sum(cover), sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))))
    return sorted(out, key=repr)


def by_both(frame):
    rows = sorted(map(tuple, frame.collect()), key=repr)
    return [r[:5] for r in rows], sorted(((r[0], r[1], r[5], r[6]) for r in rows), key=repr)


def test_removed_bytes(spark, odd_docs, odd_rows, no_docs):
    assert by_both(repeats.removed_bytes(odd_docs)) == (removed(odd_rows, 400), passages(odd_rows, 50))
    assert repeats.removed_bytes(no_docs).count() == 0
    cut = repeats.without_repeats(odd_docs, repeats.BYTES, repeats.PASSAGES)
    assert cut.columns == odd_docs.columns and cut.where("doc_id = 90").first().n_chars == len(odd_rows[-1][1])


#: Contexts of a gram that an array may hold, neighbours that others are held against, and rows of a run.
BOUNDS = [(0, 4096, 16, 4096), (1, 3, 16, 8), (2, 0, 1, 4), (3, 0, 3, 9), (4, 0, 2, 4096)]


def set_bounds(monkeypatch, contexts, nearby, rows):
    for name, value in (("ARRAY_CONTEXTS", contexts), ("NEARBY", nearby), ("RUN_ROWS", rows)):
        monkeypatch.setattr(repeats, name, value)


@pytest.mark.parametrize("seed, contexts, nearby, run_rows", BOUNDS)
def test_passages_of_words(spark, monkeypatch, seed, contexts, nearby, run_rows):
    """Strings of six words, whatever their case and white space."""
    set_bounds(monkeypatch, contexts, nearby, run_rows)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abÉ", k=rng.randint(1, 2)))
    parts = [[word() for _ in range(rng.randint(4, 14))] for _ in range(5)]
    join = lambda words: "".join((w.upper() if rng.random() < 0.2 and w.isascii() else w) + rng.choice([" ", "\n", "  "]) for w in words)
    rows = [(k, join([w for _ in range(rng.randint(0, 6)) for w in (rng.choice(parts) if rng.random() < 0.6 else [word() for _ in range(5)])]), "a") for k in range(25)]
    rows += [(100, "only here " * 20, "a"), (101, "a " * 40, "a"), (102, "a " * 7 + "z", "a"), (103, rows[3][1], "a"), (None, None, "a")]
    got = by_both(repeats.removed_bytes(make_docs(spark, rows), repeats.of_bytes(20), repeats.Rule(6, 3, words=True)))
    assert got == (removed(rows, 20), passages(rows, 6))


@pytest.mark.parametrize("seed, contexts, nearby, run_rows", BOUNDS)
def test_short_repeats(spark, monkeypatch, seed, contexts, nearby, run_rows):
    set_bounds(monkeypatch, contexts, nearby, run_rows)
    rng = random.Random(seed)
    parts = ["".join(rng.choices("abé", k=rng.randint(5, 60))) for _ in range(5)]
    rows = [(k, "".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choices("abc", k=9)) for _ in range(rng.randint(0, 6))), "a") for k in range(25)]
    rows += [(100, "ab" * 60 + "c" * 50, "a"), (101, "x" + "ab" * 30, "a"), (102, "c" * 20, "a"), (103, "ba" * 9 + "b", "a")]
    assert by_both(repeats.removed_bytes(make_docs(spark, rows), repeats.of_bytes(20)))[0] == removed(rows, 20)


@pytest.mark.parametrize("block", [3, 1024])
def test_join_counts_and_gives_every_link(spark, no_docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(8)
    base, rows = [f"w{k}" for k in range(120)], []
    for i in range(24):  # near copies, of which some link and others only by way of a third
        t = list(base)
        for at in rng.sample(range(120), rng.randint(0, 3)):
            t[at] = f"x{i}"
        rows += [(i, " ".join(t), "a")] * (1 + i % 3 // 2)
    rows += [(100, None, "a"), (101, "", "a"), (None, prose(rng, 30), "b"), (103, "one two", "b"), (104, "ONE two", "b")]
    held = [shingles(t) for _, t, _ in rows]
    link = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    want = [(i, sum(link(held[a], held[b]) for b in range(len(rows)) if a != b)) for a, (i, _, _) in enumerate(rows)]
    docs = make_docs(spark, rows).repartition(3).cache()
    assert sorted(map(tuple, ngram_join.link_counts(docs).collect()), key=repr) == sorted(want, key=repr)
    kinds = {frozenset(h) for h in held if h}
    pairs = [tuple(r) for r in ngram_join.linked_sets(docs)[1].collect()]
    assert all(a < b for a, b in pairs) and len(set(pairs)) == len(pairs) == sum(link(a, b) for a in kinds for b in kinds if a != b) // 2
    assert ngram_join.link_counts(no_docs).count() == 0


def test_pitman_yor(spark, odd_docs, odd_rows, no_docs):
    rows = pitman_yor.scores(odd_docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, words(t) + [None]) for i, t, _ in odd_rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr) == want
    assert all(r.score < 0 for r in rows) and pitman_yor.scores(no_docs).count() == 0
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, pitman_yor.scores(odd_docs).collect()), key=repr)


def test_pitman_yor_beats_the_base_on_held_out_texts(spark):
    r = pitman_yor.scores(documents(spark, SMALL)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_pitman_yor_has_a_restaurant_for_rare_contexts(spark):
    n = 5000  # each context has 2 of some 30,000 tokens
    train, test = [i for i in range(20 * n) if zlib.crc32(str(i).encode()) % 5 != 1][: 2 * n], [i for i in range(20 * n) if zlib.crc32(str(i).encode()) % 5 == 1][:200]
    rows = [(i, f"c{k % n} d{k % n}", "a") for k, i in enumerate(train)]
    rows += [(i, f"c{k} d{k + k % 2}", "a") for k, i in enumerate(test)]  # every other one has a word that never follows
    docs = make_docs(spark, rows).repartition(3)
    for hot in (pitman_yor.HOT_TOKENS, 100):  # END is spread over all fragments
        got = {r.doc_id: r.score for r in pitman_yor.scores(docs, hot_tokens=hot).where("held_out").collect()}
        assert np.mean([got[i] for i in test[::2]]) > np.mean([got[i] for i in test[1::2]]) + 1


def test_pitman_yor_probabilities_sum_to_one(spark):
    known = [f"w{k}" for k in range(6)]
    rng = random.Random(3)
    rows = [(None, " ".join(rng.choices(known, range(1, 7), k=30)), "a") for _ in range(40)]
    ids = iter(i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 1)
    states = [*known, "new"]
    held = {t: next(ids) for t in ["", *states, *(f"{u} {v}" for u in states for v in states)]}
    docs = make_docs(spark, rows + [(i, t, "a") for t, i in held.items()]).repartition(2)
    for hot in (pitman_yor.HOT_TOKENS, 100):
        got = {r.doc_id: 10**r.score for r in pitman_yor.scores(docs, hot_tokens=hot).where("held_out").collect()}
        # transitions between words, each times the chance of its word to end a text and over that of the word before: the eigenvalues stay
        first = [got[held[""]], *(got[held[u]] for u in states)]
        rest = [[1.0, *(got[held[f"{u} {v}"]] / got[held[u]] for v in states)] for u in states]
        assert max(abs(np.linalg.eigvals(np.array([first, *rest])))) == pytest.approx(1, abs=1e-4)


def seatings(customers, opens, discount, tables=()):
    """Weight of every number of tables of dishes 0 and 1, over all ways to seat the customers one by one."""
    if not customers:
        return Counter({(sum(d == 0 for d, _ in tables), sum(d == 1 for d, _ in tables)): 1.0})
    dish, out = customers[0], Counter()
    k = sum(d == dish for d, _ in tables)
    ways = [(n - discount, (*tables[:i], (d, n + 1), *tables[i + 1 :])) for i, (d, n) in enumerate(tables) if d == dish]
    for weight, then in [*ways, (opens(dish, k, len(tables)), (*tables, (dish, 1)))]:
        for t, w in seatings(customers[1:], opens, discount, then).items():
            out[t] += weight * w
    return out


def test_gibbs_sweeps_reach_the_posterior_of_all_seatings():
    rng, chains, discount, strength, base = np.random.default_rng(2), 40_000, 0.6, 1.5, (0.3, 0.05)
    want = seatings((0, 0, 0, 1, 1, 1, 1), lambda dish, k, tables: (strength + discount * tables) * base[dish], discount)
    t = [np.ones(chains), np.ones(chains)]
    for _ in range(15):
        for dish, c in enumerate((3, 4)):
            t[dish] = pitman_yor.reseat(np.full(chains, c), pitman_yor.Others(strength + discount * t[1 - dish], base[dish]), discount, rng)
    got, total = Counter(zip(t[0].astype(int).tolist(), t[1].astype(int).tolist())), sum(want.values())
    assert set(got) <= set(want) and all(abs(got[x] / chains - w / total) < 0.01 for x, w in want.items())


@pytest.mark.parametrize("above, taken", [(0, 0.6), (1, 0.6), (7, 1.8)])
def test_reseating_draws_from_the_conditional_with_a_parent(above, taken):
    rng, chains, discount, strength, stay, base, total = np.random.default_rng(3), 40_000, 0.8, 2.0, 4, 0.2, 9.0
    want = seatings((0,) * 5, lambda _, k, tables: (strength + discount * (stay + tables)) * (max(above + k - taken, 0) + base) / (total + k), discount)
    each = lambda x: np.full(chains, float(x))
    got = Counter(pitman_yor.reseat(np.full(chains, 5), pitman_yor.Others(each(strength + discount * stay), base, each(above), each(taken), each(total)), discount, rng).tolist())
    assert all(abs(got[t] / chains - w / sum(want.values())) < 0.01 for (t, _), w in want.items())


def test_reseating_large_and_small_dishes():
    rng, c = np.random.default_rng(4), np.array([0, 1, 2, 255, 256, 5000, 1])
    opens = np.full(len(c), 3.0)
    t = np.mean([pitman_yor.reseat(c, pitman_yor.Others(opens, 0.2), 0.7, rng) for _ in range(300)], axis=0)
    assert t[0] == 0 and t[1] == t[6] == 1 and 1 < t[2] < 2 and t[2] < t[3] and (t <= c).all()
    assert len(pitman_yor.reseat(c[:0], pitman_yor.Others(opens[:0], 0.2), 0.7, rng)) == 0


@pytest.mark.parametrize("opens, base", [(3.0, 0.2), (40.0, 0.2), (500.0, 0.05), (2.0, 0.001)])
def test_seating_in_order_agrees_with_the_conditional(opens, base):
    rng, discount, c = np.random.default_rng(5), 0.7, np.full(20_000, 255)
    others = pitman_yor.Others(np.full(len(c), opens), base)
    whole, near = (pitman_yor.reseat(c, others, discount, rng, exact) for exact in (255, 64))
    assert near.mean() == pytest.approx(whole.mean(), rel=0.05) and near.std() == pytest.approx(whole.std(), rel=0.1, abs=0.05)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 512])
def test_pieces_change_no_marginal(piece):
    rng = np.random.default_rng(piece)
    for _ in range(10):
        off = np.concatenate(([0], np.cumsum(rng.integers(1, 40, 6))))
        score, transition = rng.normal(0, 3, off[-1]), rng.normal(0, 2, (2, 2))
        want, _, _ = quality_crf._Chains(off).marginals(score, transition)
        assert np.allclose(quality_crf.posterior(score.copy(), off, transition, piece), want, atol=1e-9)


def test_parts_of_lines_change_no_score():
    """Repeated words and lines are seen across the cuts, and neighbours' features too."""
    rng = np.random.default_rng(0)
    texts = [(f"line {k % 5}!! foo foo\n" * int(rng.integers(1, 30)) + "tail\n\n foo").encode() for k in range(10)] + [b""]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    x, size, lines = quality_crf.line_features(data, off)
    model = quality_crf.Model(x.mean(0), x.std(0) + 0.1, rng.normal(size=x.shape[1] + 1), rng.normal(size=(2, 2)), 1.0, 0.0)
    want = ((x - model.mean) / model.scale) @ model.weights[:-1] + model.weights[-1]
    for most in (1, 2, 3, 10, 100, 10_000):
        got, sizes, found = quality_crf.line_scores(model, data, off, most)
        assert np.array_equal(found, lines) and np.array_equal(sizes, size) and np.allclose(got, want, atol=1e-8)


def test_many_lines_in_bounded_memory():
    """A mebibyte of newlines; features of all lines at once would be over a gigabyte."""
    import tracemalloc

    x, _, _ = quality_crf.line_features(np.frombuffer(b"a b\nc", np.uint8), np.array([0, 5]))
    model = quality_crf.Model(x.mean(0), x.std(0) + 0.1, np.ones(x.shape[1] + 1), np.zeros((2, 2)), 1.0, 0.0)
    data = np.full(1 << 20, 10, np.uint8)
    tracemalloc.start()
    quality_crf.predict(model, data, np.array([0, len(data)]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6


def test_quality_on_held_out_documents(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_crf.train(docs, labels)
    scored = quality_crf.scores(docs, model).join(labels, "doc_id").where(quality_crf.fold() == 0).toPandas()
    assert ((scored.score >= 0.3) == (scored.quality == 1)).mean() > 0.95
    odd = quality_crf.scores(odd_docs, model).toPandas()
    assert len(odd) == odd_docs.count() and odd.score.between(0, 1).all()
    equal = odd[odd.doc_id.isin([1, 2])].score
    assert equal.nunique() == 1
    assert quality_crf.scores(no_docs, model).count() == 0 and quality_crf.train(no_docs, labels.limit(0)) == 0.5
    only = labels.where("quality = 1")
    assert quality_crf.train(docs, only) == 1.0
    assert quality_crf.accepted(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    off = np.array([0, 3, 4, 8])
    score, transition = rng.normal(size=8), rng.normal(size=(2, 2))
    got, pairs, z = quality_crf._Chains(off).marginals(score, transition)
    total_pairs, total = np.zeros((2, 2)), 0.0
    for a, b in zip(off[:-1], off[1:]):
        weights, good = 0.0, np.zeros(b - a)
        own = np.zeros((2, 2))
        for code in range(2 ** (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            w = np.exp(sum(score[a + k] * v for k, v in enumerate(y)) + sum(transition[p, q] for p, q in zip(y, y[1:])))
            weights += w
            good += w * np.array(y)
            for p, q in zip(y, y[1:]):
                own[p, q] += w
        assert np.allclose(got[a:b], good / weights)
        total_pairs += own / weights
        total += np.log(weights)
    assert np.allclose(pairs, total_pairs) and np.isclose(z, total)


def fill(sizes):
    """Targets by raising the level until all words are dealt."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    goal, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if goal[s] + share * weight[s] >= 3 * sizes[s]}
        if not full:
            for s in open_:
                goal[s] += share * weight[s]
            break
        for s in full:
            left -= 3 * sizes[s] - goal[s]
            goal[s] = 3.0 * sizes[s]
        open_ -= full
    return goal


def test_mixing(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = mixing.plan(odd_docs).collect()
    sizes = Counter()
    for _, t, s in odd_rows:
        sizes[s] += len(words(t))
    goal = fill(sizes)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len(words(t))) for i, t, _ in odd_rows)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(goal[s]) and r.taken <= 3 * r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - goal[s]) <= max(r["size"] for r in own) + 1e-6
    again = mixing.plan(odd_docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mixing.plan(no_docs).count() == 0
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_pivotal_keeps_expectations():
    rng = np.random.default_rng(3)
    p, size = np.array([0.2, 0.5, 0.7, 0.9, 0.35]), np.array([10.0, 3.0, 8.0, 1.0, 5.0])
    out = np.array([mixing.pivotal(p, size, rng.random(5)) for _ in range(6000)])
    assert np.allclose(out.mean(axis=0), p, atol=0.03) and np.allclose(out @ size, p @ size)
    assert (((out > 0) & (out < 1)).sum(axis=1) <= 1).all()


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    x[50:150] = x[49]
    rows = [(k, [float(v) for v in x[k]], 1) for k in range(400)]
    rows += [(0, rows[0][1], 1), (500, None, 1), (520, [0.0] * 8, 1), (540, [1.0, None] + [0.0] * 6, 1), (560, [float("nan")] * 8, 1), (580, [1.0], 1), (None, rows[3][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = nn_descent.nearest(df).toPandas().sort_values(["query_id", "rank"])
    assert sorted(got.query_id.unique()) == list(range(0, 400, 20)) and (got.groupby("query_id").size() == 20).all()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[q]
        want = sorted((k for k in range(400) if k != q), key=lambda k: (-s[k], k))[:20]
        assert np.allclose(g.score, s[g.vec_id]) and all(a >= b - 1e-12 for a, b in zip(g.score, g.score[1:]))
        hit += len(set(want) & set(g.vec_id))
        tied = g[np.isclose(g.score, s[49])].vec_id.tolist()
        assert tied == sorted(tied)
    assert hit >= 0.9 * 400
    assert nn_descent.nearest(df.limit(0)).count() == 0
    few = nn_descent.nearest(spark.createDataFrame([(20, [1.0, 0.0], 1), (1, [0.5, 1.0], 1)], "vec_id long, embedding array<double>, score int")).collect()
    assert [tuple(r) for r in few] == [(20, 1, 1, 0.5)]


def test_recall(spark):
    got = nn_descent.nearest(spark.read.parquet(f"{SMALL}/embeddings.parquet")).toPandas()
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    x, ids = np.array(e.embedding.tolist(), float), e.vec_id.to_numpy()
    hit = total = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -9
        hit += len(set(ids[np.argsort(-s)[:20]]) & set(g.vec_id))
        total += 20
    assert hit >= 0.9 * total


def test_pipeline(spark, tmp_path):
    docs = documents(spark, SMALL)
    seen = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SMALL)
        assert docs.columns == seen, name
        path = str(tmp_path / name.replace(" ", "_"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name.startswith("n-gram"):
            ids = [(r.doc_id, r.text, "") for r in docs.collect()]
            assert len(ids) < before and all(not n or i == c for i, n, c in classes_of(ids))
        if name.startswith("suffix"):
            assert docs.count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.where("start = 0").count() == docs.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, stage):
    assert stage(spark, no_docs, SMALL).count() == 0
    out = stage(spark, odd_docs, SMALL)
    assert out.count() > 0 and (stage is corpus_pipeline.power_of_two_packing or out.columns == odd_docs.columns)


def groups_of(rows, least):
    """Maximal repeats of `least` bytes and more by brute force: (text, its places), where runs are one place."""
    texts = [(t or "").encode() for _, t, _ in rows]
    classes = defaultdict(list)
    for k, b in enumerate(texts):
        last = {}
        for i in range(len(b) - least + 1):
            w = b[i : i + least]
            if i - last.get(w, -least) >= least:
                classes[w].append((k, i))
            last[w] = i
    found = {}

    def walk(members, depth):
        """Descends where all members go on alike, splits where they don't."""
        while len(members) > 1:
            befores = {texts[k][i - 1] if i else (k, i) for k, i in members}
            if len(befores) < 2:
                return
            onward = defaultdict(list)
            for k, i in members:
                onward[texts[k][i + depth] if i + depth < len(texts[k]) else (k, i)].append((k, i))
            if len(onward) > 1:
                k, i = members[0]
                found[texts[k][i : i + depth]] = [(rows[k][0], i) for k, i in members]
                for part in onward.values():
                    walk(part, depth + 1)
                return
            depth += 1

    for members in classes.values():
        walk(members, least)
    return found


@pytest.mark.parametrize("seed, contexts, class_chunks, most", [(0, 4096, 4096, 1 << 20), (1, 0, 4096, 8), (2, 3, 2, 1 << 20), (3, 0, 0, 16)])
def test_repeat_groups(spark, monkeypatch, no_docs, seed, contexts, class_chunks, most):
    for name, value in (("ARRAY_CONTEXTS", contexts), ("CLASS_CHUNKS", class_chunks), ("MOST_CHUNK", most)):
        monkeypatch.setattr(repeat_groups, name, value)
    rng = random.Random(seed)
    parts = ["".join(rng.choices("abé", k=rng.randint(5, 60))) for _ in range(4)]
    rows = [(k, "".join(rng.choice(parts) if rng.random() < 0.7 else "".join(rng.choices("abc", k=9)) for _ in range(rng.randint(0, 6))), "a") for k in range(20)]
    rows += [(100, "ab" * 30 + "c" * 50, "a"), (101, "x" + "ab" * 25, "a"), (102, "c" * 20, "a"), (103, rows[3][1], "a"), (104, rows[5][1], "a"), (104, rows[5][1], "a"), (None, None, "a"), (None, parts[0], "b")]
    got = defaultdict(list)
    texts = {}
    for r in repeat_groups.repeat_groups(make_docs(spark, rows).repartition(3), repeats.of_bytes(20)).collect():
        got[r.group].append((r.doc_id, r.start))
        text = next(t for i, t, _ in rows if i == r.doc_id and t).encode()[r.start : r.start + r.length]
        assert len(text) == r.length and texts.setdefault(r.group, (text, r.n)) == (text, r.n)
    key = lambda places: sorted(places, key=repr)
    want = {t: key(p) for t, p in groups_of(rows, 20).items()}
    assert len(want) > 10 and {t: key(got[g]) for g, (t, _) in texts.items()} == want and len(texts) == len(want)
    assert all(n == len(got[g]) for g, (_, n) in texts.items())
    assert repeat_groups.repeat_groups(no_docs).count() == 0


def test_quality_does_not_depend_on_partitions(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    model = quality_crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    one, many = (dict(quality_crf.scores(docs.repartition(n), model).select("doc_id", "score").collect()) for n in (1, 7))
    assert one == many


def test_hubs_meet_in_groups(spark, monkeypatch):
    """Groups of a few members at a time still find nearly all neighbours."""
    monkeypatch.setattr(nn_descent, "MEET", 24)
    test_recall(spark)
