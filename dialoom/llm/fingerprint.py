"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the k smallest distinct 64-bit shingle hashes, ascending. Sketches of parts merge into the
sketch of the whole (``merge``), and estimate how many distinct shingles there are (``distinct``), the
resemblance of two documents and the containment of one in another. With fewer than k shingles a sketch is
the whole set and every answer is exact. A text without words has the empty sketch; two empty sketches
resemble each other fully, an empty and another not at all.

As text, a sketch is the base64 of its hashes as little-endian 64-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.exact import cuts_below
from dialoom.llm import wordhash
from dialoom.llm.shared import partitions

LEAST_ID = -(1 << 63)


@dataclass(frozen=True)
class Plan:
    #: Hashes kept; the standard error of a resemblance r is about sqrt(r * (1 - r) / k).
    k: int = 128
    #: Words of a shingle.
    size: int = 5


def sketches(texts: pa.Array, plan: Plan) -> list[np.ndarray]:
    """The sketch of each text; null counts as empty."""
    w = wordhash.words(texts)
    s, off = wordhash.shingles(w, plan.size)
    out = []
    for i in range(len(off) - 1):
        x = s[off[i] : off[i + 1]]
        if len(x) > 4 * plan.k:  # the k least distinct values are nearly always among the 2 k least
            least = np.unique(np.partition(x, 2 * plan.k)[: 2 * plan.k])
            x = least if len(least) >= plan.k else np.unique(x)
        else:
            x = np.unique(x)
        out.append(x[: plan.k])
    return out


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode("ascii")


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(sketch: np.ndarray, k: int) -> float:
    """Estimated number of distinct shingles."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * 2.0**64 / float(sketch[k - 1])


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated Jaccard similarity."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], "right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    if len(a) < k and len(b) < k:
        return float(np.isin(a, b).sum()) / len(a)
    return min(1.0, r * distinct(merge(a, b, k), k) / distinct(a, k))


def edited(text: str, following: str) -> str:
    """The text with its last third (floor) of code points replaced by the first as many of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n] if n else text


def _run(plan: Plan):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_distinct", "in_next"]

    def some(ids: list, texts: list[str], after: str) -> pa.RecordBatch:
        """Rows of one bucket; ``after`` follows the last."""
        changed = [edited(t, u) for t, u in zip(texts, [*texts[1:], after], strict=True)]
        own = sketches(pa.array([*texts, after], pa.large_string()), plan)
        new = sketches(pa.array(changed, pa.large_string()), plan)
        k = plan.k
        cols = [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([encode(x) for x in own[:-1]], pa.string()),
            pa.array([encode(x) for x in new], pa.string()),
            pa.array([resemblance(x, y, k) for x, y in zip(own, new, strict=False)], pa.float64()),
            pa.array([resemblance(x, y, k) for x, y in zip(own, own[1:], strict=False)], pa.float64()),
            pa.array([distinct(x, k) for x in own[:-1]], pa.float64()),
            pa.array([containment(x, y, k) for x, y in zip(own, own[1:], strict=False)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]):
        held: tuple | None = None  # the last row, whose follower isn't known yet
        for batch in batches:
            for part in wordhash.parts(batch, "text", 4 << 20):
                bucket, guest, ids = (part.column(c).to_pylist() for c in ("bucket", "guest", "doc_id"))
                texts = part.column("text").to_pylist()
                if held is not None:
                    for x, v in zip((bucket, guest, ids, texts), held, strict=True):
                        x.insert(0, v)
                i = 0
                for j in range(1, len(ids)):
                    # a row is done once its follower is known; a guest is only a follower
                    if guest[j] or bucket[j] != bucket[i]:
                        if not guest[i] and bucket[j] == bucket[i]:
                            yield some(ids[i:j], texts[i:j], texts[j])
                        i = j
                if i + 1 < len(ids) and not guest[i]:
                    yield some(ids[i : len(ids) - 1], texts[i : len(ids) - 1], texts[-1])
                held = (bucket[-1], guest[-1], ids[-1], texts[-1])

    return run


def fingerprints(spark: SparkSession, docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Fingerprints of each row of ``docs(doc_id, text)`` and of its edited text.

    The following document is the next in descending doc_id (null last; equal ids by text), after the last
    the first. Each text is shuffled once: ids are cut into ranges, and the first document of each range goes
    to the range before as well. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_distinct (estimated distinct shingles) and in_next (estimated containment in the
    following document). An empty table gives no rows; other columns of ``docs`` are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("k"))
    n = partitions(spark)
    marks = [i / n for i in range(1, n)]
    cuts = sorted({int(x) for x in docs.stat.approxQuantile("k", marks, 0.2 / n)}) if marks else []  # n - 1 values at most
    # bucket 0 has the largest ids; a row's bucket is the number of cuts above its id
    bucket = F.lit(len(cuts)) - cuts_below(cuts, F.col("k"))
    keyed = docs.withColumn("bucket", bucket.cast("int"))
    tops = sorted((r["bucket"], r["top"]) for r in keyed.groupBy("bucket").agg(F.max("k").alias("top")).collect())  # a row for each bucket
    own = keyed.withColumn("guest", F.lit(False))
    if tops:
        before = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}  # of each first id, the range before
        place = F.create_map(*(F.lit(x) for top, b in before.items() for x in (top, b)))[F.col("k")]
        guests = keyed.where(F.col("k").isin(list(before))).withColumn("bucket", place.cast("int")).withColumn("guest", F.lit(True))
        own = own.unionByName(guests)
    dealt = own.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "guest", F.desc("k"), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_distinct double, in_next double"
    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(_run(plan), schema)


def _merge_sorted(k: int, column: str, kind: str):
    """One sketch of each key from rows in the order of keys."""

    def run(batches):
        key, sketch = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([encode(sketch)])], names=[column, "fingerprint"])

        for batch in batches:
            for x, text in zip(batch.column(column).to_pylist(), batch.column("fingerprint").to_pylist(), strict=True):
                if sketch is not None and x != key:
                    yield out()
                    sketch = None
                key, sketch = x, decode(text) if sketch is None else merge(sketch, decode(text), k)
        if sketch is not None:
            yield out()

    return run


def merged(rows: DataFrame, by: str, plan: Plan = Plan()) -> DataFrame:
    """The fingerprint of all texts of each value of a string column, merged from those of ``rows(by, fingerprint)``: by, fingerprint.

    Each task merges what it has of a value before the shuffle, so a value with a large share of all rows sends one
    sketch a task. Null is a value like others; rows without a fingerprint are passed over.
    """
    some = rows.where("fingerprint IS NOT NULL").select(F.col(by).cast("string").alias(by), "fingerprint")
    run = _merge_sorted(plan.k, by, "string")
    schema = f"`{by}` string, fingerprint string"
    return some.sortWithinPartitions(by).mapInArrow(run, schema).repartition(partitions(rows.sparkSession), by).sortWithinPartitions(by).mapInArrow(run, schema)
