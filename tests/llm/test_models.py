import json
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import WORDS, documents, prose
from pyspark.sql import functions as F

from dialoom.llm import decontam, langid, toolcalls, toxicity, urlfilter
from dialoom.llm.shared import components, held_out, Scratch


def test_held_out_is_by_crc(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (7, 7)]
    got = {r["id"]: r["comp"] for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long"), "c").collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(30)) and got[300] == got[299] == 299


def ppm_bits(text, texts, order):
    counts = {}

    def words(s):
        return re.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in s.encode()))

    for s in texts:
        for w in words(s):
            z = b" " + w + b" "
            for i in range(1, len(z)):
                for o in range(min(order, i) + 1):
                    c = counts.setdefault(z[i - o : i], {})
                    c[z[i]] = c.get(z[i], 0) + 1
    total = 0.0
    for w in words(text):
        z = b" " + w + b" "
        for i in range(1, len(z)):
            for o in range(min(order, i), -1, -1):
                c = counts.get(z[i - o : i])
                if c is None:
                    continue
                t, d = sum(c.values()), len(c)
                if z[i] in c:
                    total -= math.log2(c[z[i]] / (t + d))
                    break
                total -= math.log2(d / (t + d))
            else:
                total += 8
    return total


@pytest.mark.parametrize("order", [1, 3, 5])
def test_code_lengths_are_exact(order):
    texts = {"en": [prose(1, 200)], "xx": ["zzz qqq éé zq " * 5, prose(2, 10)], "yy": ["a"]}
    m = langid.Model.fit(texts, order)
    for t in ["Hello thé wörld zzz", "", prose(3, 50), "é", "\x00\x01 zzzzzzzz"]:
        got = m.text_bits(pa.array([t]))[0][0]
        assert np.allclose(got, [ppm_bits(t, texts[lang], order) for lang in m.langs], rtol=1e-4)


def test_languages_are_found(spark):
    other = lambda i: prose(i, 40)[::-1]
    rows = [(i, prose(i, 40), "en", "a") for i in range(60)] + [(100 + i, other(i), "rev", "a") for i in range(60)] + [(300, prose(7, 30), None, None)]
    docs = documents(spark, rows + [(400, None, "en", "a"), (401, "", "en", "a"), (402, "123 !!", "en", "a"), (403, "ß", "en", "a")])
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert len(got) == len(rows) + 4
    assert all(got[i]["lang_pred"] == "en" and got[100 + i]["lang_pred"] == "rev" for i in range(60)) and got[300]["lang_pred"] == "en"
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (400, 401, 402)) and got[403]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0
    kept = langid.keep(docs, langid.train(docs))
    assert kept.columns == docs.columns and kept.count() >= len(rows) and not kept.where("doc_id in (400, 401, 402)").count()


def toxic_rows(n=400):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = prose(i, 60).split()
        if bad:
            for _ in range(r.randint(2, 5)):
                words.insert(r.randrange(len(words)), r.choice(["Vilewort", "grumkin,", "spatfold"]) + r.choice(["", "s"]))
        rows.append((i, " ".join(words), "en", "a"))
        if i % 2 == 0:
            labels.append((i, int(bad), 1))
    return rows, labels


def test_toxicity_is_learned_from_positives_and_unlabelled(spark):
    rows, labels = toxic_rows()
    docs = documents(spark, rows + [(900, None, None, None), (901, "", "en", "a"), (902, "grumkin " * 4000, "en", "a")])
    lab = spark.createDataFrame([*labels, (None, 1, 0), (5000, None, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, lab)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["predicted"] == int(i % 6 == 0) for i in held)
    assert got[900]["predicted"] == got[901]["predicted"] == 0 and got[902]["predicted"] == 1
    kept = toxicity.keep(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in got if not got[i]["predicted"])


def test_toxicity_without_labels(spark):
    docs = documents(spark)
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_every_language_is_learned(spark):
    letters = {f"l{k:02d}": "abcdefghijklmnopqrstuvwxyz"[3 * k : 3 * k + 3] for k in range(7)}
    r = random.Random(4)
    rows = [(100 * k + i, " ".join("".join(r.choice(abc) for _ in range(5)) for _ in range(30)), lang, "a") for k, (lang, abc) in enumerate(letters.items()) for i in range(12 + k)]
    docs = documents(spark, rows)
    whole, blocks = (langid.train(docs, langid.Plan(languages=n)) for n in (64, 3))
    assert sorted(blocks.langs) == sorted(letters)
    want = {i: lang for i, _, lang, _ in rows}
    for model in (whole, blocks):
        assert {x["doc_id"]: x["lang_pred"] for x in langid.predict(docs, model).collect()} == want
    assert langid.keep(docs, blocks).count() == len(rows)


def levenshtein_in(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def test_myers_equals_dynamic_programming():
    r = random.Random(1)
    for _ in range(300):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 12)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 30)))
        assert decontam.myers(decontam.masks(p), len(p), t) == levenshtein_in(p, t)


def test_leaks_equal_brute_force(spark):
    r = random.Random(2)
    items = [(i, prose(900 + i, 12 + i)) for i in range(8)] + [(50, "short"), (51, None), (52, ""), (53, prose(900, 12)), (0, prose(900, 12))]
    rows = []
    for i in range(40):
        text = prose(i, 40).split()
        item = list(items[i % 8][1])
        for _ in range(i % 6):
            k = r.randrange(len(item))
            item[k : k + 1] = r.choice(["", "q", item[k] + "z"])
        text.insert(r.randrange(40), "".join(item).upper().replace(" ", " \n "))
        rows.append((i, " ".join(text), "en", "a"))
    docs = documents(spark, rows + [(90, None, "en", "a"), (91, "", "en", "a"), (92, prose(92, 30), "en", "a")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = decontam.Plan(block_chars=300)  # several blocks
    got = sorted((x["doc_id"], x["item_id"], x["distance"]) for x in decontam.matches(docs, bench, plan).collect())
    want = set()
    for i, t, *_ in rows:
        for k, p in items:
            p = decontam.normal(p)
            if len(p) >= plan.least:
                d, _ = levenshtein_in(p, decontam.normal(t))
                if d <= int(len(p) * plan.rate):
                    want.add((i, k, d))
    assert got == sorted(want) and len(got) > 20
    clean = decontam.clean(docs, bench, plan)
    assert clean.columns == docs.columns
    assert sorted(x["doc_id"] for x in clean.collect()) == sorted({x["doc_id"] for x in docs.collect()} - {w[0] for w in want})
    assert decontam.matches(docs, bench.limit(0)).count() == 0 and decontam.matches(docs.limit(0), bench).count() == 0


def test_short_items_are_found_between_word_boundaries(spark):
    bench = spark.createDataFrame([(1, "Paris"), (2, "capital of France?"), (3, "42"), (4, "東京"), (None, "an item without an id")], "item_id long, text string")
    texts = ["it is PARIS.", "parisian", "the capital off france? yes", "the capitals of frances?", "4 42, 5", "142 421", "私は東京に", "here is an item  without an ID too", "nothing", "", None, "x Parisian Paris"]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["start"], r["end"], r["budget"]) for r in decontam.matches(docs, bench).collect())
    assert got == [(0, 1, 0, 6, 11, 0), (2, 2, 1, 4, 23, 1), (4, 3, 0, 2, 4, 0), (6, 4, 0, 2, 4, 0), (11, 1, 0, 11, 16, 0)]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [1, 3, 5, 8, 9, 10]


def test_short_items_equal_brute_force():
    r = random.Random(5)
    plan = decontam.Plan()
    for _ in range(150):
        text = decontam.normal("".join(r.choice("ab ,") for _ in range(60)))
        items = [(i, x) for i in range(6) if (x := decontam.normal("".join(r.choice("ab ,") for _ in range(r.randint(1, 20)))))]
        at = r.randrange(20)
        items.append((9, decontam.normal(text[at : at + 8] + "b" + text[at + 9 : at + 18])))
        got = {k: d for k, d, _, _ in decontam.Matcher(items, plan).find(text)}
        ends = [p for p in range(len(text) + 1) if decontam.boundary(text, p)]
        want = {}
        for k, (_, item) in enumerate(items):
            budget = int(len(item) * plan.rate)
            near = [decontam.distance(item, text[a:b]) for a in ends for b in ends if a < b and abs(b - a - len(item)) <= budget]
            if near and min(near) <= budget:
                want[k] = min(near)
        assert got == want


def python_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def python_rule(host, path):
    fit = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name)) if fit else None


def test_urls_equal_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "https://A.EXAMPLE.com/en/7x", "http://example.com/en/8?x=/en/7", "x://com/en/", "ftp://xcom/en/", "http://b.net/de/9"]
    urls += ["http://example.net/de/81#f", "http://É.ORG/es/", "http://org?/es/", "a://b://c.com/en/", "http://m.example.com/en/\n7", "http://q.org/es/1?a=1&b=2", "http://x.net/fr/?"]
    urls += [f"http://{s}.example.{t}/{p}/{i}{q}" for i in range(30) for s in ("m", "blog") for t in ("com", "net", "org") for p in ("en", "de", "es") for q in ("", "?a=1")]
    rows = [(i, u, "<html>", 1.0, "z") for i, u in enumerate(urls)] + [(0, None, "", 0.0, ""), (None, "http://q.com/en/", "", 0.0, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, score double, host string")
    got = urlfilter.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        url = urls[r["page_id"]] if r["page_id"] is not None else "http://q.com/en/"
        host, path = python_host_path(url)
        rule = python_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name), url
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")
        assert 0 <= r["score"] <= 1
    empty = spark.createDataFrame([], pages.schema)
    assert urlfilter.judge(empty).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages.where("url is null")).collect()} == {"allow"}


def test_trees_learn_and_their_sql_agrees(spark):
    r = np.random.default_rng(0)
    x = r.integers(0, 50, (600, len(urlfilter.FEATURES))).astype(float)
    y = ((x[:, 0] > 20) ^ (x[:, 3] > 30)).astype(float)
    start, trees = urlfilter.boost(x, y, urlfilter.Plan())

    def walk(t, row):
        while isinstance(t, tuple):
            t = t[2] if row[t[0]] <= t[1] else t[3]
        return t

    odds = np.array([start + sum(walk(t, row) for t in trees) for row in x])
    assert ((odds > 0) == (y == 1)).mean() > 0.97
    df = spark.createDataFrame([tuple(map(float, row)) for row in x[:50]], [*urlfilter.FEATURES])
    sql = " + ".join([f"{start!r}D", *(f"({urlfilter.tree_sql(t)})" for t in trees)])
    assert np.allclose([v[0] for v in df.selectExpr(sql).collect()], odds[:50])


SCHEMAS = {
    "add": {"a": toolcalls.Parameter("number"), "b": toolcalls.Parameter("number"), "note": toolcalls.Parameter("string", False)},
    "all": {"xs": toolcalls.Parameter("array"), "o": toolcalls.Parameter("object", False), "f": toolcalls.Parameter("boolean", False)},
}


def python_errors(name, arguments):
    kinds = {"string": (str,), "number": (int, float), "integer": (int,), "boolean": (bool,), "array": (list,), "object": (dict,)}
    if name not in SCHEMAS:
        return "unknown tool"
    try:
        a = json.loads(arguments)
    except (ValueError, TypeError):
        a = None
    if not isinstance(a, dict):
        return "arguments are no object"
    out = []
    for p, rule in sorted(SCHEMAS[name].items()):
        v = a.get(p)
        if v is None:
            out += [f"missing {p}"] * rule.required
        elif not isinstance(v, kinds[rule.type]) or isinstance(v, bool) != (rule.type == "boolean"):
            out.append(f"{p} is no {rule.type}")
    return "; ".join(out + [f"unknown {k}" for k in sorted(set(a) - set(SCHEMAS[name]))])


def test_calls_are_linked_ordered_and_validated(spark):
    calls = [
        (1, "x", None, "add", '{"b": 2, "a": 1.5}', 0),
        (1, "y", "x", "add", '{"a": "1", "z": 0, "c": 1}', 2),
        (1, "z", "y", "all", '{"xs": [1], "o": {"q": {"b": 1, "a": 2}}, "f": true}', 4),
        (1, "p", "q", "all", "[1]", 6),
        (1, "q", "p", "nope", "{}", 7),
        (1, "x", None, "add", "{}", 9),
        (2, "x", "gone", "add", None, 0),
        (2, "w", "x", "add", "not json", 1),
        (None, "x", None, "add", "{}", 0),
        (3, None, None, "add", "{}", 0),
        (4, "s", "s", "all", '{"xs": "é\\n/"}', 0),
    ]
    results = [(1, "x", 'said "é"\n', 1), (1, "z", None, 5), (2, "orphan", "r", 3), (2, "x", "b", 4), (2, "x", "a", 2), (None, "x", "r", 0)]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, after string, name string, arguments string, position long")
    r = spark.createDataFrame(results, "conv_id long, call_id string, content string, position long")
    found = toolcalls.link(spark, c, r, SCHEMAS).collect()
    assert sorted(((x["conv_id"], x["call_id"], x["n_calls"], x["n_results"]) for x in found if x["status"] == "unidentified"), key=str) == [(3, None, 1, 0), (None, "x", 0, 1), (None, "x", 1, 0)]
    rows = {(x["conv_id"], x["call_id"]): x for x in found if x["status"] != "unidentified"}
    assert set(rows) == {(1, "x"), (1, "y"), (1, "z"), (1, "p"), (1, "q"), (2, "x"), (2, "w"), (2, "orphan"), (4, "s")}
    assert [rows[1, k]["depth"] for k in "xyzpq"] == [0, 1, 2, None, None] and rows[4, "s"]["depth"] is None and rows[2, "w"]["depth"] == 1
    assert [rows[k]["status"] for k in ((1, "x"), (1, "y"), (1, "z"), (2, "orphan"))] == ["linked", "unanswered", "linked", "orphan"]
    assert rows[1, "x"]["n_calls"] == 2 and rows[2, "x"]["n_results"] == 2 and rows[2, "x"]["result_position"] == 2
    for conv, call, _, name, arguments, position in calls:
        if (conv, call) in rows and rows[conv, call]["call_position"] == position:
            assert rows[conv, call]["errors"] == python_errors(name, arguments), (name, arguments)
            assert rows[conv, call]["valid"] == (python_errors(name, arguments) == "")
    for x in rows.values():
        again = json.loads(x["canonical"])
        assert x["canonical"] == json.dumps(again, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(rows[1, "x"]["canonical"]) == {"call": {"arguments": {"a": 1.5, "b": 2}, "name": "add"}, "id": "x", "result": 'said "é"\n'}
    assert toolcalls.link(spark, c.limit(0), r.limit(0), SCHEMAS).count() == 0


def test_turns_become_calls(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(200)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", None), (2, 2, "assistant", ""), (2, 3, "assistant", "extra"), (None, 0, "user", "x"), (2, None, "user", "x"), (2, 1, "user", None)]
    turns = spark.createDataFrame([(*r, "j") for r in rows], "conv_id long, turn long, role string, text string, name string")
    calls, results, context = toolcalls.from_turns(turns)
    found = toolcalls.link(spark, calls, results, toolcalls.REPLY, context).collect()
    assert len(found) == 102 + 3 and sum(x["n_calls"] + x["n_results"] + (x["status"] == "context") for x in found) == len(rows)
    assert [x["canonical"] for x in found if x["status"] == "context"] == ['{"content":"s","position":0,"role":"system"}']
    got = {(x["conv_id"], x["call_id"]): x for x in found if x["status"] not in ("context", "unidentified")}
    assert [got[1, f"c{t}"]["depth"] for t in range(0, 200, 2)] == list(range(100))
    assert got[2, "c1"]["errors"] == "missing message" and got[2, "c1"]["n_calls"] == 2 and got[2, "c2"]["status"] == "orphan"
    assert len(got) == 102


def test_words_list_is_used():
    assert len(WORDS) == len(set(WORDS))


def python_depths(after):
    """Longest chains before each call, None on a cycle or after one."""
    known = {}

    def of(k, on):
        if k in known:
            return known[k]
        if k in on:
            return None
        ups = [u for u in after[k] if u in after]
        ds = [of(u, on | {k}) for u in ups]
        d = None if any(x is None for x in ds) else max((x + 1 for x in ds), default=0)
        if d is not None or not on:
            known[k] = d
        return d

    return {k: of(k, frozenset()) for k in after}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_calls_with_several_dependencies_are_in_topological_order(spark, seed):
    r = random.Random(seed)
    rows, want = [], {}
    for conv in range(6):
        after = {}
        for i in range(25):
            ups = r.sample([f"k{j}" for j in range(i)], min(i, r.choice([0, 1, 1, 1, 2, 3])))
            after[f"k{i}"] = [*ups, *(["gone"] if r.random() < 0.1 else [])]
        if conv % 2:  # a cycle, and what stands after it
            after["k5"] = [*after["k5"], "k9"]
            after["k9"] = [*after["k9"], "k5"]
        want |= {(conv, k): d for k, d in python_depths(after).items()}
        rows += [(conv, k, a or None, "add", "{}", i) for i, (k, a) in enumerate(after.items())]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>, name string, arguments string, position long")
    results = spark.createDataFrame([], "conv_id long, call_id string, content string, position long")
    got = {(x["conv_id"], x["call_id"]): x["depth"] for x in toolcalls.link(spark, calls, results, SCHEMAS).collect()}
    assert got == want and None in want.values()


def test_a_large_cycle_ends(spark):
    n = 40
    rows = [(1, f"c{i}", f"c{(i + 1) % n}", "add", "{}", i) for i in range(n)] + [(1, "after", "c3", "add", "{}", 99), (1, "free", None, "add", "{}", 100)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, after string, name string, arguments string, position long")
    results = spark.createDataFrame([], "conv_id long, call_id string, content string, position long")
    got = {x["call_id"]: x["depth"] for x in toolcalls.link(spark, calls, results, SCHEMAS).collect()}
    assert got.pop("free") == 0 and set(got.values()) == {None}


def test_rules_by_join_equal_rules_one_by_one(spark):
    r = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "", "org"]
    rules = tuple(urlfilter.Rule(r.choice(["block", "allow"]), r.choice(hosts), "/" + "".join(r.choice("ab/") for _ in range(r.randint(0, 6)))) for _ in range(600))
    urls = [f"http://{r.choice(['', 'q.', 'b.'])}{r.choice(hosts)}/{''.join(r.choice('ab/') for _ in range(r.randint(0, 9)))}" for _ in range(300)] + [None, "", "http://com.", "no", "http://xcom/a"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    order = urlfilter._best_first(rules)
    want = {}
    for i, u in enumerate(urls):
        host, path = python_host_path(u)
        fit = next((x for x in order if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)), None)
        want[i] = (fit and fit.name, fit and fit.verdict)
    for most in (10, 1000):
        got = {x["page_id"]: (x["rule"], x["verdict"]) for x in urlfilter.judge(pages, rules, urlfilter.Plan(rules=most)).collect()}
        assert {i: x if x[0] else (None, None) for i, x in got.items()} == want
        assert all(v in ("allow", "block") for _, v in got.values())


def test_a_label_is_not_told_by_itself(spark):
    """Each suffix has one labelled URL, so its statistics must say nothing of that URL's label."""
    rows = [(i, f"http://h.s{i}/{'b' if i % 2 else 'a'}") for i in range(200)]
    rules = tuple(urlfilter.Rule("block" if i % 2 else "allow", f"s{i}", "/") for i in range(0, 150))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {x["page_id"]: x["score"] for x in urlfilter.judge(pages, rules, urlfilter.Plan(suffixes=1000)).collect()}
    assert max(got[i] for i in range(150)) < 0.9 and min(got[i] for i in range(150)) > 0.1


def test_every_suffix_has_its_statistics(spark):
    """URLs that no rule fits are told by their suffix alone, however many suffixes there are."""
    rows = [(i, f"http://h{i % 7}.s{i % 300}/{i % 2100 // 300}") for i in range(6300)] + [(9000, "no"), (9001, None), (None, "http://x.s1/")]
    rules = tuple(urlfilter.Rule("block" if i % 3 else "allow", f"s{i}", f"/{k}") for i in range(300) for k in range(6))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    want = None
    for most in (1000, 256, 2, 0):
        got = sorted((str(r["page_id"]), r["rule"], r["verdict"], round(r["score"], 9)) for r in urlfilter.judge(pages, rules, urlfilter.Plan(suffixes=most)).collect())
        assert len(got) == len(rows) and (want is None or got == want)
        want = got
    verdicts = {i: v for i, rule, v, _ in got if rule is None and i.isdigit() and int(i) < 9000}
    assert len(verdicts) == 900 and all(v == ("block" if int(i) % 300 % 3 else "allow") for i, v in verdicts.items())


def test_copies_of_a_labelled_url_are_drawn_one_by_one(spark):
    rows = spark.range(60_000).select(F.col("id").alias("page_id"), F.lit("http://a.com/en/").alias("url"))
    pages = rows.union(spark.createDataFrame([(70_000, "http://a.com/x")], "page_id long, url string"))
    assert urlfilter.judge(pages).where("rule is null").first()["verdict"] == "block"


def test_languages_are_learned_from_whole_texts(spark):
    """What tells the languages apart stands after 20,000 characters that they share."""
    head = prose(1, 5000)
    rows = [(i, head + " " + " ".join(f"{'qzx' if i % 2 else 'wvk'}{j % 7}" for j in range(300)), "odd" if i % 2 else "even", "a") for i in range(12)]
    rows += [(100, "qzx3 qzx1 qzx5", None, "a"), (101, "wvk2 wvk6", None, "a")]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.train(docs)).collect()}
    assert len(head) > 20_000 and got[100] == "odd" and got[101] == "even"


def test_seventy_languages(spark):
    r = random.Random(6)
    abc = "abcdefghijklmnopqrstuvwxyz0123456789"
    words = {f"l{k:02d}": ["".join(r.choice(abc) for _ in range(6)) for _ in range(12)] for k in range(70)}
    rows = [(100 * k + i, " ".join(r.choice(ws) for _ in range(30)), lang, "a") for k, (lang, ws) in enumerate(words.items()) for i in range(6)]
    docs = documents(spark, rows)
    got = {x["doc_id"]: x["lang_pred"] for x in langid.predict(docs, langid.train(docs)).collect()}
    assert got == {i: lang for i, _, lang, _ in rows}


def test_the_draw_does_not_depend_on_partitions(spark):
    rows = [(i, prose(i, 20), "en", "a") for i in range(80)] * 2
    plan = langid.Plan(sample=20)
    models = [langid.train(documents(spark, rows).repartition(n), plan) for n in (1, 5)]
    assert all((a == b).all() for x in ("grams", "cost") for a, b in zip(getattr(models[0], x), getattr(models[1], x)))


def test_toxic_words_late_in_long_texts_are_learned(spark):
    rows, labels = [], []
    for i in range(160):
        bad = i % 4 == 0
        rows.append((i, prose(i, 2500) + (" vilewort grumkin spatfold" * 3 if bad else ""), "en", "a"))
        labels.append((i, int(bad)))
    docs = documents(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert min(len(t) for _, t, *_ in rows) > 12_000
    assert {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["predicted"]} == {i for i in range(160) if i % 4 == 0}


def test_risk_and_slopes_equal_their_definitions():
    r = np.random.default_rng(2)
    for shift in (0.0, 3.0, -6.0):  # the last brings the second term below zero
        gp, gu, prior = r.normal(1 + shift, 2, 40), r.normal(shift, 1, 90), 0.4
        loss = lambda z: math.log1p(math.exp(-z))
        first = prior * sum(loss(g) for g in gp) / 40
        second = sum(loss(-g) for g in gu) / 90 - prior * sum(loss(-g) for g in gp) / 40
        assert np.allclose(toxicity.risk(gp, gu, prior), (first, second))
        whole = lambda p, u: sum(toxicity.risk(p, u, prior)) if second >= 0 else -toxicity.risk(p, u, prior)[1]
        sp, su = toxicity.slopes(gp, gu, prior)
        for k in (0, 7):
            e = np.eye(1, 40, k)[0] * 1e-6
            assert abs((whole(gp + e, gu) - whole(gp - e, gu)) / 2e-6 - sp[k]) < 1e-6
            e = np.eye(1, 90, k)[0] * 1e-6
            assert abs((whole(gp, gu + e) - whole(gp, gu - e)) / 2e-6 - su[k]) < 1e-6


def test_the_cut_is_among_those_of_least_estimated_error():
    r = np.random.default_rng(5)
    for _ in range(20):
        gp, gu, prior = r.normal(1, 1, 30).round(1), r.normal(0, 1.5, 50).round(1), 0.3
        wrong = lambda c: prior * (gp < c).mean() + max(0, (gu >= c).mean() - prior * (gp >= c).mean())
        cuts = np.arange(-8, 8, 0.05)
        assert np.allclose(toxicity.wrong_shares(gp, gu, prior, cuts), [wrong(c) for c in cuts])
        best = min(map(wrong, cuts))
        assert wrong(toxicity.best_cut(gp, gu, prior)) <= best + 3 * math.sqrt(prior * (1 - prior) / 50)
    assert abs(toxicity.best_cut(np.full(20, 4.0), np.concatenate([np.full(90, -2.0), np.full(10, 4.0)]), 0.1) - 1) < 1e-9


def test_the_threshold_stands_where_the_estimate_is_least():
    """Only cuts between 0.5 and 2.6 catch all positives and no clean text; those above miss a few."""
    caught = np.linspace(4.3, 8.6, 44)
    assert abs(toxicity.best_cut(np.append(caught, 2.6), np.concatenate([np.full(212, 0.5), caught]), 0.35) - 1.55) < 1e-9


def test_toxic_features_equal_a_plain_count():
    texts = ["Vile wort vile", "", "a vile", prose(3, 40)]
    for k, rows, codes in toxicity._present(pa.array(texts), (4,)):
        got = {}
        for row, code in zip(rows.tolist(), codes.tolist()):
            got.setdefault((row, int(code >> 3).to_bytes(4, "big")), set()).add(code & 7)
        want = {}
        for i, t in enumerate(texts):
            ws = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in t.split()]
            n = {}
            for w in ws:
                z = (" " + w).encode()
                for j in range(len(z) - 3):
                    n[z[j : j + 4]] = n.get(z[j : j + 4], 0) + 1
            for g, c in n.items():
                want[i, g] = {0} | ({1} if c >= 2 else set()) | {v for v, d in ((2, 120), (3, 40), (4, 15)) if c * d >= len(ws)}
        assert got == want


def test_very_long_texts_and_repeated_documents(spark):
    long = prose(5, 40_000)
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (2, "x" * 300_000, "en", "a"), (3, None, None, None)]
    docs = documents(spark, rows)
    found = langid.predict(docs, langid.train(docs)).collect()
    assert [r["lang_pred"] for r in sorted(found, key=lambda r: r["doc_id"])] == ["en", "en", "en", "und"]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    assert len(toxicity.score(docs, toxicity.train(docs, labels)).collect()) == 4
    bench = spark.createDataFrame([(1, prose(5, 40_000)[100_000:100_300])], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.matches(docs, bench).collect()] == [1, 1]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [2, 3]
    pages = spark.createDataFrame([(1, "http://a.com/en/" + "x" * 100_000), (1, "http://a.com/en/" + "x" * 100_000)], "page_id long, url string")
    assert [r["rule"] for r in urlfilter.judge(pages).collect()] == ["com/en/"] * 2
