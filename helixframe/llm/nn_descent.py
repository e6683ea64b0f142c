"""Approximate nearest neighbours by NN-descent.

Equal vectors are one node. A forest of random splits, fitted on a bounded sample, puts every node into one leaf per
tree; brute force within leaves starts the neighbour graph. Rounds of NN-descent follow: around every node its
neighbours in either direction meet (a join on the node, in groups of at most ``MEET``, drawn anew each round), and each pair that improves one of the two
lists is offered to it. Rounds end when less than ``SETTLED`` of the lists' entries are new, or after ``ROUNDS``. Queries are nodes, so they search greedily from their own neighbours: each round opens the best
nodes of the beam that aren't open yet, joins their neighbours, and scores those not seen before.

Nearness is the inner product. Vectors are lengthened by one component to equal norm, so that the graph is built
on angles; graph and search use 8-bit components, the last ranking original vectors in double precision.
A class of equal vectors keeps its smallest k + 1 ids, all that a ranking of k can use.

Defined cases: vectors null, empty, zero, with null or non-finite components, or not of the commonest dimension take no part,
nor do null ids; equal rows count once; ties go to smaller ids; fewer candidates than k are all returned;
an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import discard, materialize

DEGREE = 32
TREES, LEAF, LEAF_LINKS = 12, 512, 16
SAMPLE = 20_000
#: Rounds of NN-descent at most, and the share of new entries at which they end.
ROUNDS, SETTLED = 10, 0.02
MEET = 128
BEAM, OPEN, SEARCH_ROUNDS = 256, 64, 4


def _pack(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def usable(df: DataFrame) -> DataFrame:
    """id and vec (array<double>) of the rows that take part."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL").where(fine)
    top = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("vec") == (top["dim"] if top else 0)).distinct()


def classes(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """nodes (node, vec) and members (node, id): a node is a class of equal vectors under its least id.

    Members are the class's least `keep` ids, found within parts of a class first.
    """
    tagged = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    small = tagged.withColumn("r", F.row_number().over(Window.partitionBy("vec", "part").orderBy("id"))).where(F.col("r") <= keep)
    small = small.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= keep)
    small = small.withColumn("node", F.min("id").over(Window.partitionBy("vec")))
    small = materialize(small.select("node", "id", "vec"), "classes")
    return small.where("node = id").select("node", "vec").dropDuplicates(["node", "vec"]), small


def _forest(sample: np.ndarray, total: int, trees: int, leaf: int, seed: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Per tree: a direction for each level and a threshold for each place of it.

    Levels at which a place holds 50 of the sample have medians of their own; further ones, which larger tables need, share the sample's.
    """
    depth = fitted = 0
    while total / 2**depth > leaf:
        depth += 1
        fitted += len(sample) / 2**fitted >= 100
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        directions = rng.standard_normal((sample.shape[1], depth))
        place, cuts = np.zeros(len(sample), np.int64), []
        for k in range(depth):
            p = sample @ directions[:, k]
            if k < fitted:
                cut = np.array([np.median(p[place == j]) if (place == j).any() else 0.0 for j in range(2**k)])
                place = place * 2 + (p > cut[place])
            else:
                cut = np.array([np.median(p)])
            cuts.append(cut)
        out.append((directions, cuts))
    return out


def _codes(vec: np.ndarray, norm: float, top: float) -> np.ndarray:
    """8-bit components of the vectors lengthened to the norm."""
    extra = np.sqrt(np.maximum(norm**2 - (vec**2).sum(axis=1), 0))
    return np.rint(np.concatenate((vec, extra[:, None]), axis=1) * (127 / top)).astype(np.int8)


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int8).reshape(-1, dim).astype(np.float32)


def _best(candidates: DataFrame, degree: int) -> DataFrame:
    """The `degree` nearest of each node among (node, other, sim, fresh); an entry is fresh if all its candidates are."""
    once = candidates.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= degree)


def neighbour_graph(codes: DataFrame, forest, total: int, dim: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(node, other, sim, rank) of the nodes (node, code)."""

    def leaves(batches):
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist(), dim)
            node = batch.column(0)
            for t, (directions, cuts) in enumerate(forest):
                p, place = x @ directions, np.zeros(len(x), np.int64)
                for k, cut in enumerate(cuts):
                    place = place * 2 + (p[:, k] > (cut[place] if len(cut) > 1 or not k else cut[0]))
                yield pa.record_batch([pa.array(np.full(len(x), t), pa.int32()), pa.array(place), node, batch.column(1)], names=["tree", "leaf", "node", "code"])

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        x, node = _matrix(pdf["code"], dim), pdf["node"].to_numpy()
        k = min(LEAF_LINKS, len(node) - 1)
        parts = []
        for lo in range(0, len(node) if k else 0, 1024):
            s = x[lo : lo + 1024] @ x.T
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
            at = np.argpartition(-s, k - 1, axis=1)[:, :k]
            parts.append(pd.DataFrame({"node": np.repeat(node[lo : lo + 1024], k), "other": node[at].ravel(), "sim": np.take_along_axis(s, at, 1).ravel()}))
        return pd.concat(parts) if parts else pd.DataFrame({"node": [], "other": [], "sim": []}).astype({"node": "int64", "other": "int64", "sim": "float32"})

    flat = "node long, other long, sim float"
    dealt = codes.mapInArrow(leaves, "tree int, leaf long, node long, code binary")
    # splits beyond what the sample can tell are uneven: a leaf far too large is dealt out at random
    large = dealt.groupBy("tree", "leaf").agg(F.count("*").alias("size")).where(F.col("size") > 4 * LEAF)
    salt = F.pmod(F.xxhash64("node", "tree"), F.coalesce(F.ceil(F.col("size") / (2 * LEAF)), F.lit(1)))
    start = dealt.join(large, ["tree", "leaf"], "left").withColumn("salt", salt).groupBy("tree", "leaf", "salt").applyInPandas(lambda pdf: within(pdf), flat)
    fresh = lambda df, is_: df.withColumn("fresh", F.lit(is_))
    graph = materialize(_best(fresh(start, True), degree), "graph")

    def meet(batches):
        schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("sim", pa.float32())])
        for batch in batches:
            centre, group = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            member, bound = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            x = _matrix(batch.column(3).to_pylist(), dim)
            cut = np.flatnonzero(np.concatenate(([True], (centre[1:] != centre[:-1]) | (group[1:] != group[:-1]))))
            us, ws, ss = [], [], []
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(centre)]):
                for lo in range(a, b, 2 * MEET):
                    hi = min(lo + 2 * MEET, b)
                    s = x[lo:hi] @ x[lo:hi].T
                    i, j = np.nonzero(s > bound[lo:hi, None])
                    other = member[lo + i] != member[lo + j]
                    i, j = i[other], j[other]
                    us.append(member[lo + i])
                    ws.append(member[lo + j])
                    ss.append(s[i, j])
            if us:
                yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(ws)), pa.array(np.concatenate(ss), pa.float32())], schema=schema)

    for turn in range(rounds):
        pairs = graph.select(F.col("node").alias("centre"), F.col("other").alias("member")).unionByName(graph.select(F.col("other").alias("centre"), F.col("node").alias("member"))).distinct()
        bound = graph.groupBy("node").agg(F.when(F.count("*") >= degree, F.min("sim")).otherwise(F.lit(-1e30)).cast("float").alias("bound"))
        known = codes.join(bound, "node", "left").select(F.col("node").alias("member"), "code", F.coalesce("bound", F.lit(-1e30).cast("float")).alias("bound"))
        # members of a centre meet in groups dealt anew each round; one that very many lead to has several, which may lie in different tasks
        hubs = pairs.groupBy("centre").agg(F.ceil(F.count("*") / MEET).alias("groups")).where("groups > 1")
        group = F.pmod(F.xxhash64("member", F.lit(turn)), F.coalesce("groups", F.lit(1)))
        dealt = pairs.join(hubs, "centre", "left").select("centre", group.alias("group"), "member")
        met = dealt.join(known, "member").select("centre", "group", "member", "code", "bound").repartition("centre", "group").sortWithinPartitions("centre", "group", "member")
        offered = fresh(met.mapInArrow(meet, flat), True).unionByName(fresh(graph.select("node", "other", "sim"), False))
        last, graph = graph, materialize(_best(offered, degree), "graph")
        discard(last)
        new, entries = graph.agg(F.count_if("fresh"), F.count("*")).first()
        if new < SETTLED * entries:
            break
    return graph


STATE = "bucket long, query long, code binary, seen binary, ids binary, sims binary, open binary"


def greedy_search(queries: DataFrame, graph: DataFrame, codes: DataFrame, dim: int, total: int, n_queries: int, degree: int = DEGREE) -> DataFrame:
    """(query, node) for the nodes in the beam of each query (query, code, goal): queries are nodes too, and among their own results."""
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim")
    back = back.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))).where(F.col("rank") <= degree)
    around = materialize(graph.select("node", "other").unionByName(back.select("node", "other")).groupBy("node").agg(F.collect_set("other").alias("others")), "around")
    query_buckets, node_buckets = max(8, -(-n_queries // 256)), max(8, -(-total // 8192))
    names = [x.split()[0] for x in STATE.split(", ")]
    bucket = F.pmod(F.xxhash64("query"), F.lit(query_buckets))
    empty = F.lit(b"")
    state = queries.select(bucket.alias("bucket"), "query", "code", empty.alias("seen"), empty.alias("ids"), empty.alias("sims"), empty.alias("open"))
    state = materialize(state, "beam")
    # names of their own, for state is joined with what comes from it
    first = state.select((F.col("query") + 0).alias("query"), (F.col("query") + 0).alias("node"))

    def ask(held: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """Nodes not seen before, by their bucket."""
        near = dict(found.groupby("query")["others"].agg(lambda x: np.unique(np.concatenate(list(x))))) if len(found) else {}
        rows = []
        for q, code, seen in zip(held["query"], held["code"], held["seen"]):
            new = np.setdiff1d(near.get(q, np.zeros(0, np.int64)), np.frombuffer(seen, np.int64))
            part = (new * 2654435761 >> 5) % node_buckets
            for b in np.unique(part).tolist():
                rows.append((b, q, code, new[part == b].tobytes()))
        return pd.DataFrame(rows, columns=["part", "query", "code", "ids"])

    def answer(asked: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("node")
        ids, x = nodes["node"].to_numpy(), _matrix(nodes["code"], dim) if len(nodes) else None
        rows = []
        for q, code, wanted in zip(asked["query"], asked["code"], asked["ids"]):
            w = np.frombuffer(wanted, np.int64)
            # the query has no lengthening component: only the inner product counts
            v = np.frombuffer(code, np.int8).astype(np.float32)
            v[-1] = 0
            s = x[np.searchsorted(ids, w)] @ v
            rows.append((q, wanted, s.astype("<f4").tobytes()))
        return pd.DataFrame(rows, columns=["query", "ids", "sims"])

    def absorb(held: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        by = {q: g for q, g in answers.groupby("query")}
        rows = []
        for r in held[names].itertuples(index=False):
            ids, sims, opened, seen = np.frombuffer(r.ids, np.int64), np.frombuffer(r.sims, "<f4"), np.frombuffer(r.open, bool), np.frombuffer(r.seen, np.int64)
            # the best BEAM not open before have been opened in this round
            opened = opened.copy()
            opened[np.flatnonzero(~opened)[:OPEN]] = True
            if r.query in by:
                g = by[r.query]
                new = np.frombuffer(b"".join(g["ids"]), np.int64)
                seen = np.union1d(seen, new)
                ids, sims, opened = np.concatenate((ids, new)), np.concatenate((sims, np.frombuffer(b"".join(g["sims"]), "<f4"))), np.concatenate((opened, np.zeros(len(new), bool)))
                best = np.lexsort((ids, -sims))[:BEAM]
                ids, sims, opened = ids[best], sims[best], opened[best]
            rows.append((r.bucket, r.query, r.code, seen.tobytes(), ids.tobytes(), sims.tobytes(), opened.tobytes()))
        return pd.DataFrame(rows, columns=names)

    def to_open(batches):
        for batch in batches:
            qs, ns = [], []
            for q, ids, opened in zip(*(batch.column(i).to_pylist() for i in range(3))):
                top = np.frombuffer(ids, np.int64)[np.flatnonzero(~np.frombuffer(opened, bool))[:OPEN]]
                qs.append(np.full(len(top), q))
                ns.append(top)
            yield pa.record_batch([pa.array(np.concatenate(qs) if qs else [], pa.int64()), pa.array(np.concatenate(ns) if ns else [], pa.int64())], names=["query", "node"])

    nodes = codes.withColumn("part", F.pmod(F.shiftright(F.col("node") * F.lit(2654435761), 5), F.lit(node_buckets)))
    for turn in range(SEARCH_ROUNDS + 1):
        frontier = first if turn == 0 else state.select("query", "ids", "open").mapInArrow(to_open, "query long, node long")
        found = frontier.join(around, "node").select(bucket.alias("bucket"), "query", "others")
        if turn == 0:  # the query's own node is the first that it sees
            found = found.unionByName(first.select(bucket.alias("bucket"), "query", F.array("node").alias("others")))
        asked = state.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInPandas(ask, "part long, query long, code binary, ids binary")
        answers = asked.groupBy("part").cogroup(nodes.groupBy("part")).applyInPandas(answer, "query long, ids binary, sims binary")
        state = materialize(state.groupBy("bucket").cogroup(answers.withColumn("bucket", bucket).groupBy("bucket")).applyInPandas(absorb, STATE), "beam")

    def beam(batches):
        for batch in batches:
            ids = [np.frombuffer(x, np.int64)[:BEAM] for x in batch.column(1).to_pylist()]
            yield pa.record_batch([pa.array(np.repeat(batch.column(0).to_numpy(), [len(x) for x in ids])), pa.array(np.concatenate(ids) if ids else [], pa.int64())], names=["query", "node"])

    return state.select("query", "ids").mapInArrow(beam, "query long, node long")


def nearest(df: DataFrame, k: int = 20, every: int = 20, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id is divisible by `every`, among all other rows."""
    spark = df.sparkSession
    rows = usable(df)
    nodes, members = classes(rows, k + 1)
    stats = nodes.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)), F.max(F.array_max(F.transform("vec", F.abs))), F.max(F.size("vec"))).first()
    total = stats[0]
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm, dim = float(np.sqrt(stats[1])), stats[3] + 1
    spread = nodes.agg(F.max(F.sqrt(F.greatest(F.lit(norm**2) - F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x), F.lit(0.0))))).first()[0]
    top = max(float(stats[2]), float(spread), 1e-300)

    def encode(batches):
        for batch in batches:
            codes = _codes(_pack(batch.column(1), dim - 1), norm, top)
            yield pa.record_batch([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], names=["node", "code"])

    codes = materialize(nodes.mapInArrow(encode, "node long, code binary"), "codes")
    sample = codes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(SAMPLE).select("code").collect()
    forest = _forest(_matrix([bytes(r["code"]) for r in sample], dim).astype(float), total, TREES, LEAF, seed)
    graph = neighbour_graph(codes, forest, total, dim)
    asking = rows.where(F.col("id") % every == 0)
    owner = materialize(asking.join(nodes, "vec").select("id", "node"), "queries")
    starts = owner.select(F.col("node").alias("query")).distinct()
    n_queries = starts.count()
    found = greedy_search(starts.join(codes, F.col("query") == F.col("node")).select("query", "code"), graph, codes, dim, total, n_queries)
    # exact scores of the beam, then the members of its classes
    vectors = nodes.select("node", "vec")
    pairs = found.join(vectors, "node").join(vectors.select(F.col("node").alias("query"), F.col("vec").alias("query_vec")), "query")

    def score(batches):
        for batch in batches:
            a, b = _pack(batch.column(2), dim - 1), _pack(batch.column(3), dim - 1)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array((a * b).sum(axis=1))], names=["query", "node", "score"])

    scored = pairs.select("query", "node", "vec", "query_vec").mapInArrow(score, "query long, node long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    # a node stands under its least id, so the first k + 1 nodes hold the first k + 1 ids
    scored = scored.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    listed = scored.join(members.select("node", "id"), "node")
    listed = listed.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
    out = owner.select(F.col("id").alias("query_id"), F.col("node").alias("query")).join(listed.select("query", F.col("id").alias("vec_id"), "score"), "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
