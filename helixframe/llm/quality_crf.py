"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. What speaks for either are features of the line and of the lines before and after it (shares of
byte classes, repeated words and lines, marks at word ends, lengths); a transition weight ties neighbouring lines together.
Lines of a training document carry its label. Forward-backward gives each line's probability of being
good; their mean, weighted by the bytes of the lines, is the document's quality, and a logistic curve over
it, fitted on the same training documents, gives a score from 0 to 1.

Training uses at most ``max_docs`` labelled documents of ``max_bytes`` and ``max_lines`` together, those least by a hash of their ids.
Scoring is one pass over all texts; long texts go through it in parts of lines, with what a part needs of the one before.

Defined cases: null and empty texts are one empty line and get a score like any other; equal texts get equal scores;
without labels of both kinds every score is the share of label 1 (0.5 without any); an empty table gives no
rows; rows with null ids or labels aren't learned from; extra columns are dropped by ``scores`` and kept by ``accepted``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernels import U64, Words, byte_column, chunks, prefix_sums, window_hash

#: Bounds of what is learned from.
MAX_TRAINING_DOCS, MAX_TRAINING_BYTES, MAX_TRAINING_LINES = 2000, 32_000_000, 300_000
#: Lines whose features are held at a time.
PART_LINES = 16_384
THRESHOLD = 0.3

_KIND = np.full(256, 5, np.uint8)  # bytes beyond ASCII
_KIND[:128] = 4  # other signs
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[32, 9, 13]] = 3
_KIND[[46, 44, 59, 58, 39, 34, 63, 45, 40, 41]] = 6  # marks of ordinary prose
_KIND[124] = 7
_KIND[33] = 8
_KIND[10] = 9
N_KINDS = 9


class _Before(NamedTuple):
    """What the first text of a chunk needs of its earlier lines, where it is the rest of a document."""

    words: np.ndarray  # hashes of the last two
    lines: np.ndarray  # hashes of all, sorted


_ROOTED = [2, 4, 7, 8, 9, 10, 11, 12, 13]


def own_features(data: np.ndarray, off: np.ndarray, before: _Before | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Before]:
    """Features of every line by itself, its bytes, the line range of each text (every text has a line at least), and what its next lines need."""
    n_docs, n = len(off) - 1, len(data)
    nl = np.flatnonzero(data == 10)
    doc_of_nl = np.searchsorted(off, nl, "right") - 1
    lines = np.bincount(doc_of_nl, minlength=n_docs) + 1
    line_off = np.concatenate(([0], np.cumsum(lines)))
    total = int(line_off[-1])
    start, end = np.empty(total, np.int64), np.empty(total, np.int64)
    head, tail = np.zeros(total, bool), np.zeros(total, bool)
    head[line_off[:-1]], tail[line_off[1:] - 1] = True, True
    start[head], start[~head] = off[:-1], nl + 1
    end[tail], end[~tail] = off[1:], nl
    length = (end - start).astype(float)
    kind = _KIND[data]
    cum = np.zeros(n + 1, np.int64)

    def share(flags: np.ndarray) -> np.ndarray:
        np.cumsum(flags, out=cum[1:])
        return (cum[end] - cum[start]) / np.maximum(length, 1)

    cols = [share(kind == k) for k in range(N_KINDS)]
    w = Words(data, off)
    h = w.hashes()
    first_word = np.searchsorted(w.start, start)
    last_word = np.searchsorted(w.start, end)
    words = (last_word - first_word).astype(float)
    cw = np.zeros(len(h) + 1)

    def of_words(flags: np.ndarray) -> np.ndarray:
        np.cumsum(flags, out=cw[1:])
        return (cw[last_word] - cw[first_word]) / np.maximum(words, 1)

    def repeated(back: int) -> np.ndarray:
        """Words like that `back` before, in the same document."""
        out = np.zeros(len(h), bool)
        out[back:] = h[back:] == h[:-back]
        for k in range(back):
            at = w.doc_off[:-1] + k
            out[at[at < w.doc_off[1:]]] = False
        held = before.words if before is not None else np.zeros(0, U64)
        for k in range(min(back, int(w.doc_off[1]) if n_docs else 0)):
            if len(held) >= back - k:
                out[k] = h[k] == held[len(held) - back + k]
        return out

    last = kind[w.end - 1] if len(h) else np.zeros(0, np.uint8)
    capital = kind[w.start] == 1 if len(h) else np.zeros(0, bool)
    shout = capital & (kind[np.minimum(w.start + 1, max(n - 1, 0))] == 1) if len(h) else capital
    size = (w.end - w.start).astype(float)
    cols += [of_words(repeated(1)), of_words(repeated(2)), of_words((last == 4) | (last == 7)), of_words(last == 8), of_words(shout), of_words(capital)]
    cols += [of_words(size) / 10, of_words(size == 1), of_words(size > 20)]
    lh = window_hash(prefix_sums(w.low), start, end)
    doc = np.repeat(np.arange(n_docs), lines)
    order = np.lexsort((lh, doc))
    same = np.zeros(total, bool)
    same[order[1:]] = (lh[order[1:]] == lh[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    seen = before.lines if before is not None else np.zeros(0, U64)
    if len(seen):
        mine = lh[: line_off[1]]
        same[: line_off[1]] |= seen[np.minimum(np.searchsorted(seen, mine), len(seen) - 1)] == mine
    cols += [same & (length > 0), (length == 0).astype(float), np.log1p(length) / 8, np.log1p(words) / 6, (words <= 2).astype(float)]
    x = np.stack([np.asarray(c, float) for c in cols], axis=1)
    x = np.concatenate((x, np.sqrt(x[:, _ROOTED]), (x[:, _ROOTED] > 0)), axis=1)
    held = before.words if before is not None else np.zeros(0, U64)
    return x, end - start, line_off, _Before(np.concatenate((held, h))[-2:], np.union1d(seen, lh))


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with those of its neighbours, its bytes, and the line range of each text."""
    x, size, line_off, _ = own_features(data, off)
    head, tail = np.zeros(len(x), bool), np.zeros(len(x), bool)
    head[line_off[:-1]], tail[line_off[1:] - 1] = True, True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[~head] = x[np.flatnonzero(~head) - 1]
    after[~tail] = x[np.flatnonzero(~tail) + 1]
    return np.concatenate((x, before, after, head[:, None], tail[:, None]), axis=1), size, line_off


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the label good, with the bias last
    transition: np.ndarray  # 2 x 2, [before, now]
    slope: float
    intercept: float


class _Chains:
    """Documents side by side, longest first, so that step t touches the first active[t] of them."""

    def __init__(self, line_off: np.ndarray):
        n = np.diff(line_off)
        self.order = np.argsort(-n, kind="stable")
        self.first = line_off[:-1][self.order]
        self.n = n[self.order]
        steps = int(self.n[0]) if len(n) else 0
        self.active = np.searchsorted(-self.n, -np.arange(1, steps + 1), "right")

    def marginals(self, score: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of each line, expected transitions, log partition. score: of good against bad, per line."""
        emit = np.stack((np.zeros_like(score), score), axis=1)
        alpha, beta = np.zeros((len(score), 2)), np.zeros((len(score), 2))
        a = None
        for t, m in enumerate(self.active):
            at = self.first[:m] + t
            a = emit[at] if t == 0 else emit[at] + np.logaddexp(a[:m, :1] + transition[0], a[:m, 1:] + transition[1])
            alpha[at] = a
        z = np.logaddexp(*alpha[self.first + self.n - 1].T)
        pairs = np.zeros((2, 2))
        for t in range(len(self.active) - 2, -1, -1):
            m = self.active[t + 1]
            at = self.first[:m] + t
            onward = emit[at + 1] + beta[at + 1]
            edge = alpha[at][:, :, None] + transition + onward[:, None, :] - z[:m, None, None]
            pairs += np.exp(edge).sum(axis=0)
            beta[at] = np.stack((np.logaddexp(*(transition[0] + onward).T), np.logaddexp(*(transition[1] + onward).T)), axis=1)
        z_line = np.empty(len(score))
        for t, m in enumerate(self.active):
            z_line[self.first[:m] + t] = z[:m]
        return np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - z_line, 0)), pairs, float(z.sum())


def _quality(good: np.ndarray, size: np.ndarray, line_off: np.ndarray) -> np.ndarray:
    # every text has a line; summed for each by itself, so that it doesn't matter what stands before it
    weight = size + 1.0
    q = np.add.reduceat(good * weight, line_off[:-1]) / np.add.reduceat(weight, line_off[:-1])
    return np.clip(q, 1e-6, 1 - 1e-6)


def fit(texts: list[bytes], labels: np.ndarray, steps: int = 100, l2: float = 1e-3) -> Model:
    """Maximises the conditional likelihood of the line labels with Adam; documents count alike."""
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    x, size, line_off = line_features(np.frombuffer(b"".join(texts), np.uint8), off)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    # in place, as this runs on the driver: the same values as copies would have
    x -= mean
    x /= scale
    wide = np.ones((len(x), x.shape[1] + 1), np.float32)
    wide[:, :-1] = x
    x = wide
    del wide
    lines = np.diff(line_off)
    y = np.repeat(labels, lines).astype(float)
    chains = _Chains(line_off)
    observed = np.array([[((lines - 1) * (1 - labels)).sum(), 0], [0, ((lines - 1) * labels).sum()]], float)
    total = float(len(y))
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, pairs, _ = chains.marginals((x @ theta[:-4].astype(np.float32)).astype(float), theta[-4:].reshape(2, 2))
        g = np.concatenate((x.T @ (y - good).astype(np.float32), (observed - pairs).ravel())) / total - l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.08 * (1 - 0.9 * step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    good, _, _ = chains.marginals((x @ theta[:-4].astype(np.float32)).astype(float), theta[-4:].reshape(2, 2))
    q = _quality(good, size, line_off)
    slope, intercept = _logistic(np.log(q / (1 - q)), labels)
    return Model(mean, scale, theta[:-4], theta[-4:].reshape(2, 2), slope, intercept)


def _logistic(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A curve over s by Newton steps, with smoothed labels so that separable data stay finite."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * s * s).sum() + 1e-6, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-6]])
        d = np.linalg.solve(h, [((t - p) * s).sum() - 1e-6 * a, (t - p).sum()])
        d *= min(1, 2 / max(np.abs(d).max(), 1e-12))
        a, b = a + d[0], b + d[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _parts(data: np.ndarray, off: np.ndarray, most: int):
    """Ranges of texts with at most `most` lines together, as (data, offsets, whether it goes on from the part before, whether it goes on); a text with more is cut at lines."""
    nl = np.flatnonzero(data == 10).astype(np.int32 if len(data) < 2**31 else np.int64)
    lines = np.diff(np.searchsorted(nl, off)) + 1
    d = 0
    while d < len(lines):
        if lines[d] > most:
            a, b = np.searchsorted(nl, off[d : d + 2])
            cuts = nl[a + most - 1 : b : most].astype(np.int64)  # newlines that end a part
            edges = np.concatenate(([off[d] - 1], cuts, [off[d + 1]]))
            for k, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                yield data[x + 1 : y], np.array([0, y - x - 1]), k > 0, k < len(edges) - 2
            d += 1
        else:
            e = d + int(np.searchsorted(np.cumsum(lines[d:]), most, "right"))
            yield data[off[d] : off[e]], off[d : e + 1] - off[d], False, False
            d = e


def line_scores(model: Model, data: np.ndarray, off: np.ndarray, most: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line how much speaks for good, its bytes, and the line range of each text; features of `most` lines are held at a time."""
    weights = model.weights[:-1] / model.scale
    bias = model.weights[-1] - float(model.mean @ weights)
    n = (len(weights) - 2) // 3
    scores, sizes, lines, before = [], [], [], None
    pending = 0.0  # what a part's last line gives the next part's first
    for d, o, goes_on, more in _parts(data, off, most or PART_LINES):
        x, size, line_off, held = own_features(d, o, before if goes_on else None)
        before = held if more else None
        score = x @ weights[:n] + bias
        to_next, to_last = x @ weights[n : 2 * n], x @ weights[2 * n : 3 * n]
        head, tail = np.zeros(len(x), bool), np.zeros(len(x), bool)
        head[line_off[:-1]], tail[line_off[1:] - 1] = True, True
        score[~head] += to_next[np.flatnonzero(~head) - 1]
        score[~tail] += to_last[np.flatnonzero(~tail) + 1]
        if goes_on:
            scores[-1][-1] += to_last[0]
            score[0] += pending
            head[0] = False
        if more:
            pending, tail[-1] = float(to_next[-1]), False
        score += weights[-2] * head + weights[-1] * tail
        scores.append(score)
        sizes.append(size.astype(np.int32))
        counts = np.diff(line_off)
        if goes_on:
            lines[-1] += int(counts[0])
        else:
            lines += counts.tolist()
    return np.concatenate(scores), np.concatenate(sizes), np.concatenate(([0], np.cumsum(lines)))


def _and(a, b):
    return np.logaddexp(a, b)


def posterior(score: np.ndarray, line_off: np.ndarray, transition: np.ndarray, piece: int = 512) -> np.ndarray:
    """P(good) of each line by forward-backward, in place of score.

    Documents are cut into pieces of so many lines, and all pieces are stepped through side by side. What a piece does to the
    odds before and after it is a 2 x 2 matrix; these are chained along each document first, so the cut changes nothing.
    """
    t = transition
    sizes = np.diff(line_off)
    per_doc = -(-sizes // piece)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    begin = line_off[:-1][doc] + number * piece
    n = np.minimum(line_off[1:][doc] - begin, piece)
    order = np.argsort(-n, kind="stable")
    begin, n, doc, number = begin[order], n[order], doc[order], number[order]
    active = np.searchsorted(-n, -np.arange(1, (int(n[0]) if len(n) else 0) + 1), "right")
    a_before = np.full(len(n), np.nan)  # odds of the line before a piece; none at a document's start
    o_after = np.full(len(n), np.nan)  # odds of the line after it, with what follows; none at its end
    if len(per_doc) and per_doc.max() > 1:
        k = np.full((len(n), 2, 2), -np.inf)
        k[:, 0, 0], k[:, 1, 1] = 0, score[begin]
        for step, m in enumerate(active[1:], 1):
            s = score[begin[:m] + step]
            a, b = k[:m, :, 0].copy(), k[:m, :, 1].copy()
            k[:m, :, 0] = _and(a + t[0, 0], b + t[1, 0])
            k[:m, :, 1] = _and(a + t[0, 1], b + t[1, 1]) + s[:, None]
        chain = np.lexsort((number, doc))
        chain = chain[per_doc[doc[chain]] > 1]
        for i, j in zip(chain[:-1].tolist(), chain[1:].tolist()):
            if doc[i] == doc[j]:
                v = np.zeros(2) if number[i] == 0 else _and(t[0], t[1] + a_before[i])
                a_before[j] = np.diff(_and(k[i, 0] + v[0], k[i, 1] + v[1]))[0]
        for j, i in zip(chain[:-1][::-1].tolist(), chain[1:][::-1].tolist()):
            if doc[i] == doc[j]:
                v = np.zeros(2) if np.isnan(o_after[i]) else _and(t[:, 0], t[:, 1] + o_after[i])
                o_after[j] = np.diff(_and(k[i, :, 0] + v[0], k[i, :, 1] + v[1]))[0]
    onward = lambda a: _and(t[0, 1], t[1, 1] + a) - _and(t[0, 0], t[1, 0] + a)
    back = lambda o: _and(t[1, 0], t[1, 1] + o) - _and(t[0, 0], t[0, 1] + o)
    forward = np.empty(len(score))
    a = np.where(np.isnan(a_before), 0.0, onward(np.nan_to_num(a_before)))
    for step, m in enumerate(active):
        at = begin[:m] + step
        a = (a[:m] if step == 0 else onward(a[:m])) + score[at]
        forward[at] = a
    b = np.where(np.isnan(o_after), 0.0, back(np.nan_to_num(o_after)))
    for step in range(len(active) - 1, -1, -1):
        m = active[step]
        at = begin[:m] + step
        inner = active[step + 1] if step + 1 < len(active) else 0
        if inner:
            b[:inner] = back(score[at[:inner] + 1] + b[:inner])
        forward[at] += b[:m]
    np.clip(forward, -700, 700, out=forward)
    return 1 / (1 + np.exp(-forward))


def predict(model: Model, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    score, size, line_off = line_scores(model, data, off)
    q = _quality(posterior(score, line_off, model.transition), size, line_off)
    # rounded, so that a text's score doesn't depend on what shares its chunk
    return np.round(1 / (1 + np.exp(-np.clip(model.slope * np.log(q / (1 - q)) + model.intercept, -30, 30))), 9)


def fold(doc_id="doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS, max_bytes: int = MAX_TRAINING_BYTES, max_lines: int = MAX_TRAINING_LINES) -> Model | float:
    """A model of labelled documents outside fold 0, or the share of label 1 where only one kind exists.

    Whole documents in the order of a hash of their ids, one row per id, while they fit the bounds.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold() != 0)
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()
    quality = {r["doc_id"]: int(r["quality"]) for r in chosen}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.where(F.col("doc_id").isin(list(quality))) if quality else docs.limit(0)
    # first the sizes, a row per id, to tell which whole texts fit
    measured = some.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes"), F.regexp_count(text, F.lit("\n")).alias("lines"))).alias("m")).select("doc_id", "m.*")
    taken, n_bytes, n_lines = {}, 0, 0
    for r in sorted(measured.collect(), key=lambda r: list(quality).index(r["doc_id"])):
        if n_bytes + r["bytes"] <= max_bytes and n_lines + r["lines"] < max_lines:
            taken[r["doc_id"]] = r["hash"]
            n_bytes, n_lines = n_bytes + r["bytes"], n_lines + r["lines"] + 1
    picked = some.where(F.col("doc_id").isin(list(taken))).select("doc_id", text.cast("binary").alias("text"), F.xxhash64(text).alias("hash")) if taken else None
    picked = picked.join(F.broadcast(docs.sparkSession.createDataFrame(list(taken.items()), "doc_id long, hash long")), ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "text") if taken else None
    rows = sorted(picked.collect(), key=lambda r: r["doc_id"]) if taken else []
    y = np.array([quality[r["doc_id"]] for r in rows])
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return fit([bytes(r["text"]) for r in rows], y)


def scores(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id and score of each document."""

    def run(batches):
        for batch in batches:
            data, off = byte_column(batch, "text")
            out = np.full(len(batch), model if isinstance(model, float) else 0.0)
            if not isinstance(model, float):
                for lo, hi in chunks(off):
                    out[lo:hi] = predict(model, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            yield pa.record_batch([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(out)], names=[*batch.schema.names[:-1], "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = train(docs, labels, max_docs)

    def run(batches):
        for batch in batches:
            data, off = byte_column(batch, "text")
            keep = np.ones(len(batch), bool)
            for lo, hi in chunks(off):
                keep[lo:hi] = model >= threshold if isinstance(model, float) else predict(model, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
