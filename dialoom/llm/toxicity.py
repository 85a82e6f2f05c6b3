"""Toxicity scores by non-negative positive-unlabelled (nnPU) learning.

Positives are documents confirmed toxic; everything else is unlabelled text, drawn without looking at labels.
With prior p of the positive class, the risk of a scorer g is

    p * R_pos(g, +) + max(0, R_unl(g, -) - p * R_pos(g, -)),

R being mean logistic losses. When the second term falls below zero, the step is taken against it instead,
which keeps the model from explaining the unlabelled positives away. The threshold stands where the same estimate of
the share of wrong verdicts is least, so documents confirmed clean take no part but in the prior. Features say whether a byte n-gram of a
word (with the space before it) occurs, or how densely; those that positives have significantly more often are kept. The
model is linear, trained with numpy's Adam steps over the whole sample, and each distinct word of a batch is
looked up once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import wordhash
from dialoom.llm.shared import held_out


@dataclass(frozen=True)
class Plan:
    sizes: tuple[int, ...] = (4, 5, 6)
    #: Most confirmed toxic and most unlabelled documents, drawn by a hash of id and text; whole texts are learned.
    positives: int = 1500
    unlabelled: int = 3500
    features: int = 1024
    #: Least log-likelihood ratio (G) of a feature, and the least number and share of different positives that have it.
    least_g: float = 24.0
    least_positives: int = 4
    least_share: float = 0.01
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-4
    #: Prior when there are labels of one class only.
    prior: float = 0.1
    threshold: float = 0.7


@dataclass
class Model:
    grams: list[np.ndarray]  # by n-gram size: sorted n-grams
    place: list[np.ndarray]  # and the features' numbers by n-gram and level, -1 if there is none
    weight: np.ndarray
    bias: float

    def features(self, texts: pa.Array, sizes):
        """(rows, feature numbers), by n-gram size."""
        for k, rows, codes in _present(texts, sizes, self.grams):
            at = self.place[k][codes.astype(np.int64)]
            yield rows[at >= 0], at[at >= 0]


def _grams(w: wordhash.Words, one: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of the words with the numbers in ``one``: index into ``one``, and code."""
    length = w.end[one] - w.start[one] + 1  # with the space before
    n = np.maximum(length - size + 1, 0)
    of = np.repeat(np.arange(len(one)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = w.start[one][of] + at - 1
    code = np.where(at == 0, 0x20, w.data[np.maximum(first, 0)] if len(w.data) else 0).astype(np.uint64)
    for k in range(1, size):
        code = (code << np.uint64(8)) | w.data[first + k]
    return of, code


def _present(texts: pa.Array, sizes, select=None):
    """(size number, rows, codes): the features of each text, by n-gram size.

    A code is 8 times the n-gram plus a level: 0 if it occurs, 1 if twice or more, 2 to 4 if at least one in
    120, 40 or 15 words has it. ``select`` has the n-grams wanted, by size; n-grams are then their numbers.
    """
    w = wordhash.words(texts)
    _, one, of = np.unique(w.hash, return_index=True, return_inverse=True)
    words = np.diff(w.rows)
    row = np.repeat(np.arange(len(words)), words)
    pairs, times = np.unique(row * np.int64(max(1, len(one))) + of, return_counts=True)
    prow, pword = pairs // max(1, len(one)), pairs % max(1, len(one))
    for k, size in enumerate(sizes):
        word, code = _grams(w, one, size)
        if select is not None:
            if not len(select[k]):
                continue
            at = np.minimum(np.searchsorted(select[k], code), len(select[k]) - 1)
            hit = select[k][at] == code
            word, code = word[hit], at[hit].astype(np.uint64)
        n = np.bincount(word, minlength=len(one))
        begin = np.cumsum(n) - n
        m = n[pword]
        rows = np.repeat(prow, m)
        if not len(rows):
            continue
        codes = code[np.repeat(begin[pword], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
        count = np.repeat(times, m)
        order = np.lexsort((codes, rows))
        rows, codes, count = rows[order], codes[order], count[order]
        new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])]))
        count = np.add.reduceat(count, new)
        rows, codes = rows[new], codes[new] << np.uint64(3)
        levels = [np.ones(len(rows), bool), count >= 2, *(count * d >= words[rows] for d in (120, 40, 15))]
        yield k, np.concatenate([rows[x] for x in levels]), np.concatenate([codes[x] | np.uint64(v) for v, x in enumerate(levels)])


def _batches(texts: list[str], most: int = 1 << 18):
    """Texts, some of about as many characters together (or one longer one), with the number of the first."""
    i = 0
    while i < len(texts):
        j, size = i + 1, len(texts[i])
        while j < len(texts) and size + len(texts[j]) <= most:
            size, j = size + len(texts[j]), j + 1
        yield i, pa.array(texts[i:j], pa.large_string())
        i = j


def _document_counts(texts: list[str], sizes) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size, the n-grams and in how many texts each is."""
    parts: list[list] = [[] for _ in sizes]
    for _, some in _batches(texts):
        for k, _, codes in _present(some, sizes):
            parts[k].append(np.unique(codes, return_counts=True))
    out = []
    for p in parts:
        codes = np.concatenate([c for c, _ in p]) if p else np.zeros(0, np.uint64)
        n = np.concatenate([c for _, c in p]) if p else np.zeros(0, np.int64)
        u, of = np.unique(codes, return_inverse=True)
        out.append((u, np.bincount(of, n, len(u)).astype(np.int64)))
    return out


def _g(a, n, b, m):
    """Log-likelihood ratio of a of n against b of m having a feature, 0 where the first share isn't larger."""
    part = lambda x, t: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / t), 0.0)
    e = (a + b) / (n + m)
    with np.errstate(all="ignore"):
        g = 2 * (part(a, n * e) + part(n - a, n * (1 - e)) + part(b, m * e) + part(m - b, m * (1 - e)))
    return np.where(a * m > b * n, g, 0.0)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the estimated logistic risk, of positives and of negatives (before it is kept from falling
    below zero), from the logits of positives and of unlabelled texts."""
    return prior * np.logaddexp(0, -gp).mean(), np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()


def slopes(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What the step follows, by each logit: the slope of the risk, or against that of its second term where that is below zero."""
    up, down_p, down_u = -(1 - _sigmoid(gp)), _sigmoid(gp), _sigmoid(gu)
    sp, su = (prior * (up - down_p), down_u) if risk(gp, gu, prior)[1] >= 0 else (prior * down_p, -down_u)
    return sp / len(gp), su / len(gu)


def fit(positive: list[str], unlabelled: list[str], prior: float, plan: Plan = Plan()) -> Model:
    empty = [np.zeros(0, np.uint64) for _ in plan.sizes]
    if not positive or not unlabelled:
        return Model(empty, empty, np.zeros(0), float(np.log(prior / (1 - prior))))
    found = []  # (-g, size number, code)
    # features are chosen among different texts, else what many copies of one have would look telling
    some_p, some_u = sorted(set(positive)), sorted(set(unlabelled))
    least = max(plan.least_positives, plan.least_share * len(some_p))
    often = [(c[n >= least], n[n >= least]) for c, n in _document_counts(some_p, plan.sizes)]
    grams = [np.unique(c >> np.uint64(3)) for c, _ in often]
    others = [np.zeros(8 * len(g), np.int64) for g in grams]
    for _, some in _batches(some_u):  # of unlabelled texts only these n-grams are counted
        for k, _, at in _present(some, plan.sizes, grams):
            others[k] += np.bincount(at.astype(np.int64), minlength=len(others[k]))
    for k, (codes, a) in enumerate(often):
        b = others[k][8 * np.searchsorted(grams[k], codes >> np.uint64(3)) + (codes & np.uint64(7)).astype(np.int64)]
        g = _g(a.astype(float), len(some_p), b.astype(float), len(some_u))
        keep = g >= plan.least_g
        found += list(zip((-g[keep]).tolist(), [k] * int(keep.sum()), codes[keep].tolist(), strict=True))
    del often, others
    found = sorted(found)[: plan.features]
    grams, place = [], []
    for k in range(len(plan.sizes)):
        own = np.array([c for _, z, c in found if z == k], np.uint64)
        numbers = np.array([i for i, (_, z, _) in enumerate(found) if z == k], np.int64)
        grams.append(np.unique(own >> np.uint64(3)))
        at = np.full(8 * len(grams[-1]), -1, np.int64)
        at[8 * np.searchsorted(grams[-1], own >> np.uint64(3)) + (own & np.uint64(7)).astype(np.int64)] = numbers
        place.append(at)
    model = Model(grams, place, np.zeros(len(found)), 0.0)
    xs = [_matrix(model, t, plan) for t in (positive, unlabelled)]
    w, b = np.zeros(len(found), np.float32), np.float32(np.log(prior / (1 - prior)))
    m = v = np.zeros(len(found) + 1, np.float32)
    for t in range(1, plan.steps + 1):
        sp, su = (s.astype(np.float32) for s in slopes(*(x @ w + b for x in xs), prior))
        grad = np.append(xs[0].T @ sp + xs[1].T @ su + plan.decay * w, sp.sum() + su.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = plan.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    # the bias is set so that the threshold stands where it serves best
    limit = float(np.log(plan.threshold / (1 - plan.threshold)))
    model.weight, model.bias = w.astype(float), float(b) - (best_cut(*(x @ w + b for x in xs), prior) - limit)
    del xs
    wordhash.trim()
    return model


def best_cut(gp: np.ndarray, gu: np.ndarray, prior: float) -> float:
    """Where the estimated share of wrong verdicts is least, with the shares of positives missed and caught and of
    unlabelled texts called toxic:  prior * missed + max(0, called - prior * caught).

    Of cuts that are equally good, the middle of the logits they span is taken."""
    values = np.unique(np.concatenate([gp, gu]).astype(float))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    wrong = wrong_shares(gp, gu, prior, cuts)
    some = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    low, high = values[max(some[0] - 1, 0)], values[min(some[-1], len(values) - 1)]
    return float(low + high) / 2


def wrong_shares(gp: np.ndarray, gu: np.ndarray, prior: float, cuts: np.ndarray) -> np.ndarray:
    caught = 1 - np.searchsorted(np.sort(gp), cuts) / len(gp)
    called = 1 - np.searchsorted(np.sort(gu), cuts) / len(gu)
    return prior * (1 - caught) + np.maximum(0, called - prior * caught)


def _matrix(model: Model, texts: list[str], plan: Plan) -> np.ndarray:
    x = np.zeros((len(texts), len(model.weight)), np.float32)
    for i, some in _batches(texts):
        for rows, at in model.features(some, plan.sizes):
            x[i + rows, at] = 1
    return x


def logits(model: Model, texts: pa.Array, plan: Plan) -> np.ndarray:
    out = np.full(len(texts), model.bias)
    for rows, at in model.features(texts, plan.sizes):
        out += np.bincount(rows, model.weight[at], len(texts))
    return out


def _run(model: Model, plan: Plan):
    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                score = 1 / (1 + np.exp(-np.clip(logits(model, part.column("text"), plan), -50, 50)))
                bad = (score >= plan.threshold).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(bad)], names=["doc_id", "score", "predicted"])

    return run


def train(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> Model:
    """Fit to ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; held-out rows, null ids and null labels
    take no part, and of an id's labels toxic wins. What comes to the driver is bounded by the plan's numbers of documents
    (an id that is given to several documents counts for up to two). The prior is the share of labels that are toxic."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = own.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("bad")).first()
    prior = total["bad"] / total["n"] if total["n"] and 0 < total["bad"] < total["n"] else plan.prior
    texts = docs.where(F.col("text").isNotNull() & ~held_out()).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    keys = own.where("toxic = 1").select("doc_id")
    # the ids are drawn first, so that labels are joined to few texts
    def of(keys: DataFrame, most: int) -> list[str]:
        some = keys.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        return [r["text"] for r in texts.join(F.broadcast(some), "doc_id").orderBy("h").limit(2 * most).select("text").collect()]

    positive = of(keys, plan.positives)
    n = texts.count()
    share = min(1.0, 1.1 * plan.unlabelled / n) if n else 1.0
    drawn = texts.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("h")).limit(plan.unlabelled)
    return fit(positive, [r["text"] for r in drawn.select("text").collect()], prior, plan)


def score(docs: DataFrame, model: Model, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts have the score of a text without any feature. Repeated ids are scored each.
    """
    return docs.select("doc_id", "text").mapInArrow(_run(model, plan), "doc_id long, score double, predicted int")


def keep(docs: DataFrame, model: Model, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs``, all columns kept, that aren't scored toxic. Null and empty texts have no feature and the
    score that goes with that; repeated rows are judged alike, and a null doc_id doesn't matter."""

    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                score = 1 / (1 + np.exp(-np.clip(logits(model, part.column("text"), plan), -50, 50)))
                yield part.filter(pa.array(score < plan.threshold))

    return docs.mapInArrow(run, docs.schema)
