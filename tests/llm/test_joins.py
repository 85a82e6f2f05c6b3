import re

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, prose

from dialoom.llm import fingerprint, links, ngram_join, wordhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = [x.translate(LOWER) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(rows, rule):
    sets = [shingle_set(t, rule.size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and rows[i][0] is not None and rows[j][0] is not None and rule.den * len(a & b) >= rule.num * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least[root(i)] if d is not None else None, links[i] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def chain(n, words, step):
    """Texts of which neighbours are near and the ends are not."""
    w = prose(77, words).split()
    out = []
    for k in range(n):
        out.append(" ".join([*(f"c{k}x{i}" for i in range(step * k)), *w[step * k :]]))
    return out


@pytest.mark.parametrize("rule", [ngram_join.Rule(3, 90, 100), ngram_join.Rule(1, 50, 100, heavy=4)])
def test_join_equals_brute_force(spark, rule):
    docs = documents(spark)
    more = [(1000 + i, t) for i, t in enumerate(chain(8, 120, 3))] + [(2000 + i, prose(i % 5, 40 + i)) for i in range(30)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((tuple(r) for r in ngram_join.join(spark, docs, rule).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == brute_components([tuple(r) for r in docs.collect()], rule)


def test_join_of_long_lists_uses_blocks(spark, monkeypatch):
    """Many unlinked texts with a common passage: lists of several blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    common = prose(3, 60)
    rows = [(i, common + " " + prose(500 + i, 12 + i % 9)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rule = ngram_join.Rule(2, 85, 100)
    got = sorted((tuple(r) for r in ngram_join.join(spark, docs, rule).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == brute_components(rows, rule)


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(spark, empty).count() == 0
    assert ngram_join.representatives(spark, empty).count() == 0


def test_representatives_keep_one_of_each_group(spark):
    docs = documents(spark)
    kept = ngram_join.representatives(spark, docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and 20 <= i < 30) == [20]
    assert ids.count(39) == 1 and ids.count(None) == 1 and {30, 31, 32, 33, 36, 37} <= set(ids) and 34 not in ids


def test_words_and_shingles():
    w = wordhash.words(pa.array(["The  Cat", "the cat\n", None, "", " ", "cat the", "x"]))
    assert w.rows.tolist() == [0, 2, 4, 4, 4, 4, 6, 7]
    assert w.hash[0] == w.hash[2] == w.hash[5] and w.hash[1] == w.hash[3] == w.hash[4]
    s, off = wordhash.shingles(w, 3)
    assert off.tolist() == [0, 1, 2, 2, 2, 2, 3, 4] and s[0] == s[1] != s[2]


def test_hashes_are_of_the_bytes_alone(monkeypatch):
    texts = pa.array([*(prose(i, 50) for i in range(20)), "a" * 63, "a" * 64, "a" * 65, "b" * 500])
    whole = wordhash.words(texts).hash
    monkeypatch.setattr(wordhash, "CHUNK", 7)
    w = wordhash.words(texts)
    assert (w.hash == whole).all()
    by = {}
    for h, x, y in zip(w.hash.tolist(), w.start, w.end):
        assert by.setdefault(h, bytes(w.data[x:y])) == bytes(w.data[x:y])
    alone = [wordhash.words(pa.array([t.decode()])).hash[0] for t in by.values()]
    assert alone == list(by)


def thue_morse(letters, n):
    """Two words of 2**n letters on which polynomials modulo 2**64 of any odd base agree."""
    x, y = letters
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_words_of_one_polynomial_have_their_own_hashes(spark):
    x, y = thue_morse("ab", 10)
    assert len(set(wordhash.words(pa.array([f"{x} {y}"])).hash.tolist())) == 2
    docs = spark.createDataFrame([(1, x), (2, y), (3, x)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(spark, docs, ngram_join.Rule(3, 90, 100)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(spark, docs).collect()}
    assert own[1] == own[3] != own[2]


def test_sketches_merge_and_estimate():
    plan = fingerprint.Plan()
    a, b = prose(1, 3000), prose(1, 2000) + " " + prose(9, 1500)
    sa, sb = fingerprint.sketches(pa.array([a, b]), plan)
    x, y = shingle_set(a, 5), shingle_set(b, 5)
    j = len(x & y) / len(x | y)
    assert abs(fingerprint.resemblance(sa, sb, plan.k) - j) < 0.15
    assert abs(fingerprint.distinct(sa, plan.k) / len(x) - 1) < 0.3
    assert abs(fingerprint.containment(sa, sb, plan.k) - len(x & y) / len(x)) < 0.2
    left, right = a.split()[:1500], a.split()[1496:]
    parts = fingerprint.sketches(pa.array([" ".join(left), " ".join(right)]), plan)
    assert (fingerprint.merge(*parts, plan.k) == sa).all()
    assert (fingerprint.decode(fingerprint.encode(sa)) == sa).all()
    none = np.zeros(0, np.uint64)
    assert fingerprint.resemblance(none, none, 4) == 1 and fingerprint.resemblance(none, sa, 4) == 0


@pytest.mark.parametrize("parts", ["1", "7"])
def test_fingerprints_equal_brute_force(spark, parts):
    import hashlib

    docs = documents(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]): r for r in fingerprint.fingerprints(spark, docs).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    rows.sort(key=lambda r: (-(r[0] if r[0] is not None else fingerprint.LEAST_ID), r[1]))
    by_text = {}
    for (i, t), (_, u) in zip(rows, [*rows[1:], rows[0]]):
        e = fingerprint.edited(t, u)
        r = got[i, len(t), hashlib.sha256(e.encode()).hexdigest()]
        a, b, c = fingerprint.sketches(pa.array([t, e, u]), fingerprint.Plan())
        assert r["fingerprint"] == fingerprint.encode(a) and r["edited_fingerprint"] == fingerprint.encode(b)
        assert r["near_edited"] == fingerprint.resemblance(a, b, 128) and r["near_next"] == fingerprint.resemblance(a, c, 128)
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    assert fingerprint.fingerprints(spark, docs.limit(0)).count() == 0


def test_edited_text():
    assert fingerprint.edited("abcdefgh", "XYZ") == "abcdefXY" and fingerprint.edited("abcdefghi", "X") == "abcdefX"
    assert fingerprint.edited("ab", "XYZ") == "ab" and fingerprint.edited("", "X") == ""


def test_fingerprints_of_groups_are_merged(spark):
    docs = documents(spark)
    rows = fingerprint.fingerprints(spark, docs).join(docs.select("doc_id", "source").where("doc_id IS NOT NULL").distinct(), "doc_id")
    own = rows.collect()
    got = {r["source"]: r["fingerprint"] for r in fingerprint.merged(rows, "source").collect()}
    for source in {r["source"] for r in own}:
        every = np.unique(np.concatenate([fingerprint.decode(r["fingerprint"]) for r in own if r["source"] == source]))
        assert got[source] == fingerprint.encode(every[:128])
    assert len(got) == len({r["source"] for r in own})


def test_links_of_many_near_copies_equal_brute_force(spark, monkeypatch, members=7, elements=400):
    """Random edits of one text: some pairs link by their slack, some by common edits, some only through others."""
    import random

    monkeypatch.setattr(links, "MEMBERS", members)
    monkeypatch.setattr(links, "ELEMENTS", elements)
    monkeypatch.setattr(links, "COLUMNS", 7)
    r = random.Random(members)
    rows = []
    for base in range(2):
        w = prose(base, 110).split()
        for i in range(30):
            x = list(w)
            for _ in range(r.randint(0, 4)):
                x[r.choice([5, 6, 40, 41, 42, r.randrange(110)])] = r.choice(["new", "newer", f"n{i}"])
            rows += [(1000 * base + 10 * i + k, " ".join(x)) for k in range(r.choice([1, 1, 2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rule = ngram_join.Rule(3, 90, 100)
    got = sorted((tuple(x) for x in ngram_join.join(spark, docs, rule).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    want = brute_components(rows, rule)
    assert got == want and len({x[3] for x in want}) > 5
