"""Language identification by prediction by partial matching (PPM).

For each language, a tree of byte contexts of up to ``order`` bytes is counted over a bounded sample of its
documents and then frozen. A word, with the space before and after it, is coded byte by byte: in the longest
known context a byte seen there costs -log2(c / (t + d)), with c its count, t the context's total and d its
number of distinct bytes; otherwise an escape costs -log2(d / (t + d)) and the next shorter context is tried,
down to a uniform code over 256 bytes. Contexts don't reach over white space, so equal words cost the same
and each distinct word of a batch is scored once. The language with the shortest code wins.

Trees of all languages are kept as one sorted table for each order, holding for a context and byte the final
code length in every language, and for a context its escape costs. Many languages are learned and scored in blocks,
each with tables of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.llm import wordhash
from dialoom.llm.shared import held_out

UNKNOWN = "und"


@dataclass(frozen=True)
class Plan:
    #: Longest context in bytes; at most 6.
    order: int = 4
    #: Most training documents for each language, drawn by a hash of id and text; of each the whole text is learned.
    sample: int = 600
    #: Languages of a block, whose samples are on the driver at once; all are learned.
    languages: int = 64
    #: Bits, times the root of the number of words, by which a code must be shorter for the odds to double: the
    #: difference of two codes varies with the root of the length, so the score says as much of long texts as of short ones.
    temper: float = 3.0
#: Bytes of training texts that are counted at a time.
_COUNTED = 1 << 20


def _stream(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in a row, a space before each and one at the end; positions that are coded; known bytes before each."""
    size = end - start + 1  # with the space after
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.full(off[-1] + 1, 0x20, np.uint8)
    at = np.arange(off[-1]) - np.repeat(off[:-1], size)
    body = at < np.repeat(size - 1, size)
    out[1:][body] = data[np.repeat(start, size)[body] + at[body]]
    return out, off, at + 1


class Model:
    """Frozen trees of all languages."""

    def __init__(self, order: int, langs: list[str]):
        self.order, self.langs = order, langs
        self.grams: list[np.ndarray] = []  # by order: sorted codes of context and byte
        self.cost: list[np.ndarray] = []  # bits, a column for each language
        self.contexts: list[np.ndarray] = []
        self.escape: list[np.ndarray] = []

    @classmethod
    def fit(cls, texts: dict[str, list[str]], order: int) -> Model:
        m = cls(order, sorted(texts))
        counts = [m._counted(texts[lang]) for lang in m.langs]  # by language, by order
        uniform = np.full((1, len(m.langs)), 8.0, np.float32)
        for o in range(order + 1):
            grams = np.unique(np.concatenate([c[o][0] for c in counts])) if counts else np.zeros(0, np.uint64)
            contexts = np.unique(grams >> np.uint64(8))
            cost = np.zeros((len(grams), len(m.langs)), np.float32)
            escape = np.zeros((len(contexts), len(m.langs)), np.float32)
            for k, c in enumerate(counts):
                codes, n = c[o]
                if not len(codes):
                    continue
                ctx = np.searchsorted(contexts, codes >> np.uint64(8))
                total = np.bincount(ctx, n, len(contexts))
                kinds = np.bincount(ctx, minlength=len(contexts))
                seen = kinds > 0
                escape[seen, k] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                at = np.searchsorted(grams, codes)
                cost[at, k] = -np.log2(n / (total[ctx] + kinds[ctx]))
            lower = m._bits(grams & np.uint64((1 << 8 * o) - 1), o - 1) if o else np.broadcast_to(uniform, cost.shape)
            missing = cost == 0
            cost[missing] = (lower + escape[np.searchsorted(contexts, grams >> np.uint64(8))])[missing]
            m.grams.append(grams)
            m.cost.append(cost)
            m.contexts.append(contexts)
            m.escape.append(escape)
        return m

    def _counted(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order, the bytes in their contexts and how often they are, over whole texts, some texts at a time."""
        total = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(self.order + 1)]
        i = 0
        while i < len(texts):
            j, size = i + 1, len(texts[i])
            while j < len(texts) and size + len(texts[j]) <= _COUNTED:
                size, j = size + len(texts[j]), j + 1
            w = wordhash.words(pa.array(texts[i:j], pa.large_string()))
            buf, _, known = _stream(w.data, w.start, w.end)
            for o in range(self.order + 1):
                codes, n = np.unique(self._codes(buf, o)[known >= o], return_counts=True)
                both, of = np.unique(np.concatenate([total[o][0], codes]), return_inverse=True)
                total[o] = (both, np.bincount(of, np.concatenate([total[o][1], n]), len(both)).astype(np.int64))
            i = j
        return total

    @staticmethod
    def _codes(buf: np.ndarray, o: int) -> np.ndarray:
        """For each coded byte, it and the o bytes before it as one number."""
        n = len(buf) - 1
        code = np.zeros(n, np.uint64)
        for k in range(o, -1, -1):
            part = np.zeros(n, np.uint64)
            if k == 0:
                part[:] = buf[1:]
            elif k <= n:
                part[k - 1 :] = buf[: n + 1 - k]
            code = (code << np.uint64(8)) | part
        return code

    def _bits(self, codes: np.ndarray, o: int) -> np.ndarray:
        """Code lengths of bytes in contexts of o bytes, a column for each language."""
        out = np.full((len(codes), len(self.langs)), 8.0, np.float32)
        todo, more = np.arange(len(codes)), np.zeros((len(codes), len(self.langs)), np.float32)
        while o >= 0 and len(todo):
            g = self.grams[o]
            if len(g):
                at = np.minimum(np.searchsorted(g, codes), len(g) - 1)
                hit = g[at] == codes
                out[todo[hit]] = self.cost[o][at[hit]] + more[hit]
                todo, codes, more = todo[~hit], codes[~hit], more[~hit]
                ctx = codes >> np.uint64(8)
                c = self.contexts[o]
                at = np.minimum(np.searchsorted(c, ctx), len(c) - 1)
                known = c[at] == ctx
                more[known] += self.escape[o][at[known]]
            codes = codes & np.uint64((1 << 8 * o) - 1)
            o -= 1
        out[todo] = 8.0 + more
        return out

    def word_bits(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Exact code lengths of words, a column for each language."""
        out = np.zeros((len(start), len(self.langs)), np.float64)
        step = max(1, (1 << 18) // max(1, int((end - start).mean()) + 1)) if len(start) else 1
        for i in range(0, len(start), step):
            buf, off, known = _stream(data, start[i : i + step], end[i : i + step])
            bits = np.empty((len(known), len(self.langs)), np.float32)
            depth = np.minimum(known, self.order)
            for o in range(1, self.order + 1):
                own = np.flatnonzero(depth == o)
                if len(own):
                    bits[own] = self._bits(self._codes(buf, o)[own], o)
            out[i : i + step] = np.add.reduceat(bits.astype(np.float64), off[:-1], axis=0)
        return out

    def text_bits(self, texts: pa.Array) -> tuple[np.ndarray, wordhash.Words]:
        """Code lengths of whole texts in bits, a column for each language."""
        w = wordhash.words(texts)
        _, one, of = np.unique(w.hash, return_index=True, return_inverse=True)
        bits = self.word_bits(w.data, w.start[one], w.end[one])
        out = np.empty((len(w.rows) - 1, len(self.langs)))
        for k in range(len(self.langs)):  # one language at a time, so that a long text's words are held once
            sums = np.concatenate([[0.0], np.cumsum(bits[of, k])])
            out[:, k] = sums[w.rows[1:]] - sums[w.rows[:-1]]
        return out, w


class Blocks(Model):
    """Models of several blocks of languages, asked one after another."""

    def __init__(self, models: list[Model]):
        super().__init__(models[0].order, [lang for m in models for lang in m.langs])
        self.models = models

    def text_bits(self, texts: pa.Array) -> tuple[np.ndarray, wordhash.Words]:
        found = [m.text_bits(texts) for m in self.models]
        return np.hstack([bits for bits, _ in found]), found[0][1]


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _lettered(texts: pa.Array, w: wordhash.Words) -> np.ndarray:
    """Whether a text has a letter of any script."""
    sums = np.concatenate([[0], np.cumsum(_LETTER[w.data])])
    found = sums[w.bytes[1:]] > sums[w.bytes[:-1]]
    for i in np.flatnonzero(~found):
        t = texts[int(i)].as_py()
        found[i] = t is not None and any(c.isalpha() for c in t)
    return found


def _predict(model: Model, plan: Plan):
    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                texts = part.column("text")
                bits, w = model.text_bits(texts)
                known = _lettered(texts, w) & (len(model.langs) > 0)
                best = bits.argmin(axis=1) if len(model.langs) else np.zeros(len(bits), int)
                least = bits.min(axis=1, keepdims=True) if len(model.langs) else bits
                scale = plan.temper * np.sqrt(np.maximum(1, np.diff(w.rows)))[:, None]
                score = 1 / np.exp2(-np.minimum((bits - least) / scale, 1000.0)).sum(axis=1) if len(model.langs) else np.zeros(len(bits))
                names = [model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                per = np.where(known, least.ravel() / np.maximum(1, np.diff(w.bytes)), 0.0) if len(model.langs) else np.zeros(len(bits))
                cols = [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(per)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names), *cols], names=[*part.schema.names, "lang_pred", "score", "bits_per_byte"])

    return run


def train(docs: DataFrame, plan: Plan = Plan()) -> Model:
    """Fit to the rows of ``docs(doc_id, text, lang)`` whose lang isn't null and that aren't held out.

    At most ``sample`` documents of each language are drawn, those with the least hash of id and text, and learned whole,
    for ``languages`` of them at a time: that is the bound of the rows on the driver. Repeated rows are drawn together,
    empty texts teach nothing, and a language with empty texts only is never predicted.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts = [(r["lang"], r["count"]) for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    models = [_fit(rows, dict(counts[i : i + plan.languages]), plan) for i in range(0, len(counts), plan.languages)]
    if not models:
        return Model.fit({}, plan.order)
    return models[0] if len(models) == 1 else Blocks(models)


def _fit(rows: DataFrame, counts: dict[str, int], plan: Plan) -> Model:
    """The model of one block of languages, given with their numbers of documents."""
    share = lambda n: min(1 << 30, int((1 << 30) * (1.2 * plan.sample + 50) / n))  # noqa: E731  somewhat more than are taken
    most = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, share(n))))[F.col("lang")]
    drawn = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))).where(F.col("lang").isin(list(counts)) & (F.col("h") < most))
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    texts: dict[str, list[str]] = {lang: [] for lang in counts}
    for r in drawn.withColumn("i", F.row_number().over(w)).where(F.col("i") <= plan.sample).select("lang", "text").toLocalIterator():
        texts[r["lang"]].append(r["text"])
    return Model.fit({lang: t for lang, t in texts.items() if t}, plan.order)


def predict(docs: DataFrame, model: Model, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, lang_pred, score (0 to 1), bits_per_byte.

    Null text and text without a letter are ``und`` with score 0, and so is everything if nothing was learned.
    """
    return docs.select("doc_id", "text").mapInArrow(_predict(model, plan), "doc_id long, text string, lang_pred string, score double, bits_per_byte double").drop("text")


def keep(docs: DataFrame, model: Model, plan: Plan = Plan(), least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose language is found with a score of at least ``least``.

    Null and empty texts and those without a letter go, as they have no language; repeated rows are judged alike, and a
    null doc_id is no reason to go. If nothing was learned, all go.
    """
    predict_batch = _predict(model, plan)

    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                slim = part.select(["doc_id", "text"])
                found = next(predict_batch([slim]), None) if slim.num_rows else None
                if found is not None:
                    good = np.array([x != UNKNOWN for x in found.column("lang_pred").to_pylist()], bool)
                    yield part.filter(pa.array(good & (found.column("score").to_numpy() >= least)))

    return docs.mapInArrow(run, docs.schema)
