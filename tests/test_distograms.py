"""Distances of long chains: tiles and cells against all pairs."""

import math
import random

import numpy as np
import pytest

from helixframe.operators import distograms, ordering

SCHEMA = "protein_id string, res_idx int, x double, y double, z double"


def chain_rows(name, numbers, gaps, seed, spread=30.0):
    rng = random.Random(seed)
    return [(name, r, *(None if r in gaps else round(rng.uniform(-spread, spread), 3) for _ in "xyz")) for r in numbers]


@pytest.fixture(scope="module")
def rows():
    found = chain_rows("long", range(-40, 300), {3, 64, 299}, 1) + chain_rows("short", range(1, 6), {2}, 2) + chain_rows("one", [7], set(), 3)
    found += chain_rows("sparse", [1, 2, 700, 5000, 5001], {700}, 4) + chain_rows("gap", [1], {1}, 5) + [("flat", r, 1.0, 1.0, 1.0) for r in range(70)]
    return found


def brute(rows):
    chains = {}
    for p, r, *v in rows:
        chains.setdefault(p, []).append((r, v))
    return {(p, i, j): None if None in (a[0], b[0]) else math.dist(a, b) for p, c in chains.items() for i, a in c for j, b in c if i < j}


@pytest.mark.parametrize("tile", [16, 256])
def test_pairs_by_tiles(spark, rows, tile):
    got = {(r.protein_id, r.i, r.j): r.d for r in distograms.distogram(spark.createDataFrame(rows, SCHEMA).repartition(5), tile=tile).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    assert all((want[k] is None) == (d is None) and (d is None or abs(d - want[k]) < 1e-9) for k, d in got.items())


@pytest.mark.parametrize("most", [0.0, 5.5, 20.0, 1e6])
def test_contacts_by_cells(spark, rows, most):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {k: d for k, d in brute(rows).items() if d is not None and d <= most}
    got = distograms.distogram(df, max_distance=most).collect()
    assert len(got) == len(want) and all(abs(r.d - want[r.protein_id, r.i, r.j]) < 1e-9 for r in got)
    assert distograms.distogram(df, max_distance=float("inf")).count() == sum(d is not None for d in brute(rows).values())


def test_contacts_at_the_edges_of_cells(spark):
    rows = [("p", k, k * 0.1, 0.0, 0.0) for k in range(200)]
    want = sum(b[2] - a[2] <= 0.1 for a in rows for b in rows if a[1] < b[1])
    assert distograms.contacts(spark.createDataFrame(rows, SCHEMA), 0.1).count() == want > 50


@pytest.mark.parametrize("tile", [16, 256])
def test_packed_tiles(spark, rows, tile):
    got = {}
    for r in distograms.tiled_distogram(spark.createDataFrame(rows, SCHEMA).repartition(5), tile).collect():
        assert len(r.d) == len(r.i) * len(r.j) <= tile * tile and r.tile_i <= r.tile_j
        for k, d in enumerate(r.d):
            got[r.protein_id, r.i[k // len(r.j)], r.j[k % len(r.j)]] = d
    want = brute(rows)
    assert {k for k in got if k[1] < k[2]} == set(want)
    for (p, i, j), d in got.items():
        w = 0.0 if i == j else want[p, min(i, j), max(i, j)]
        assert math.isnan(d) if w is None else abs(d - w) < 1e-4
    assert distograms.tiled_distogram(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_task_holds_a_tile(spark, rows):
    """Every group has at most two blocks of residues, and no join or window runs over the pairs of a chain."""
    tiles = distograms._tiles(spark.createDataFrame(rows, SCHEMA), 16).collect()
    assert max(max(len(t["rows"]), len(t["columns"])) for t in tiles) <= 16
    plan = distograms.distogram(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_histogram_of_a_long_chain(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.protein_id, r.bin): r.n for r in distograms.histogram(distograms.distogram(df, tile=32)).collect()}
    want = {}
    for p in {k[0] for k in brute(rows)}:
        d = [v for k, v in brute(rows).items() if k[0] == p and v is not None]
        counts, _ = np.histogram(d, 100, (min(d), max(d))) if d and max(d) > min(d) else ([len(d)], 0)
        want |= {(p, k): int(n) for k, n in enumerate(counts) if n}
    assert sum(got.values()) == sum(want.values()) and got.keys() == want.keys()


@pytest.mark.parametrize("ranges", [1, 3, 1000, None])
def test_ranks_in_any_number_of_ranges(spark, ranges):
    """Frequent keys, nulls and equal rows; what comes first is the same however many ranges there are."""
    rng = random.Random(6)
    rows = [(rng.choice((1, 1, 1, 2, 3, None)), rng.choice("ab"), k // 2) for k in range(500)] + [(1, "a", 0)] * 200
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    got = ordering.numbered(df, "a", "b", "c", ranges=ranges).collect()
    assert sorted(r["rank"] for r in got) == list(range(700))
    keys = [(r.a is not None, r.a or 0, r.b, r.c) for r in sorted(got, key=lambda r: r["rank"])]
    assert keys == sorted(keys)
    assert ordering.numbered(df.limit(0), "a", ranges=ranges).count() == 0


def test_residues_are_sent_once_for_each_stretch_of_their_chain(spark):
    """Tiles of a chain of 40 blocks are made of what came for its three stretches; the tiles are the same for any stretch."""
    df = spark.createDataFrame([("p", k, float(k), 0.0, 0.0) for k in range(40 * 8) if k // 8 != 11], SCHEMA)
    want = {(i, j) for i in range(40) for j in range(i, 40) if 11 not in (i, j)}
    for stretch in (1, 16, 64):
        tiles = distograms._tiles(df, 8, stretch)
        got = [(r.tile_i, r.tile_j, [c.res_idx for c in r.rows], [c.res_idx for c in r.columns]) for r in tiles.collect()]
        assert sorted(g[:2] for g in got) == sorted(want)
        assert all(g[2] == list(range(g[0] * 8, g[0] * 8 + 8)) and g[3] == list(range(g[1] * 8, g[1] * 8 + 8)) for g in got)


def test_contacts_send_few_copies(spark):
    """Pairs of residues spread over many cells meet once each, and one exchange serves both sides of the join."""
    rng = random.Random(9)
    rows = [("p", k, *(rng.uniform(-60, 60) for _ in "xyz")) for k in range(600)] + [("q", k, -0.5 * k, 1.0 * k, 0.0) for k in range(60)]
    found = distograms.contacts(spark.createDataFrame(rows, SCHEMA).repartition(5), 10.0)
    want = {k for k, d in brute(rows).items() if d is not None and d <= 10.0}
    got = [(r.protein_id, r.i, r.j) for r in found.collect()]
    assert len(got) == len(set(got)) == len(want) > 300 and set(got) == want
    generated = distograms.contacts(spark.createDataFrame(rows, SCHEMA), 10.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in generated and generated.count("explode") == 6
