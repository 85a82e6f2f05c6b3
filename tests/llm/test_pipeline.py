import re
import string

import duckdb
import pytest
from cases import documents, prose

import corpus_pipeline
from dialoom.llm import decontam, langid, ngram_join, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    bench = prose(77, 40)
    rows = [(i, prose(i, 50), "en", "a") for i in range(60)]
    rows += [(100 + k, prose(3, 50) + f" tail{k}", "en", "a") for k in range(3)]
    rows += [(200, prose(8, 30) + " " + bench + " " + prose(9, 10), "en", "a"), (201, "vilewort " * 30 + prose(1, 20), "en", "a")]
    rows += [(300 + i, "Vileworts grumkin " + prose(400 + i, 30), "en", "a") for i in range(40)]
    rows += [(400, None, "en", "a"), (401, "...", "en", "a"), (402, prose(5, 3000), "en", "a")]
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(300 + i, 1, 0) for i in range(40)] + [(i, 0, 1) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_equal_their_operators(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "packing"]
    kept = []
    for _, f in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, f(spark, docs, folder)
        docs = docs.cache()
        assert docs.columns == before.columns
        kept.append({r["doc_id"] for r in docs.collect()})
        if len(kept) == 1:
            scored = toxicity.score(before, toxicity.train(before, labels)).collect()
            assert kept[0] == {r["doc_id"] for r in scored if not r["predicted"]}
        elif len(kept) == 2:
            found = langid.predict(before, langid.train(before)).collect()
            assert kept[1] == {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
        elif len(kept) == 3:
            found = ngram_join.join(spark, before).collect()
            assert kept[2] == {r["doc_id"] for r in found if r["component_id"] == r["doc_id"]}
        else:
            assert kept[3] == kept[2] - {r["doc_id"] for r in decontam.matches(before, bench).collect()}
    assert not kept[0] & set(range(300, 340)) and 201 not in kept[0] and set(range(60)) <= kept[0]
    assert not kept[1] & {400, 401}
    assert kept[2] & {3, 100, 101, 102} == {3} and 200 in kept[2] and 200 not in kept[3]
    assert set(range(60)) <= kept[3]
    packed = corpus_pipeline.packing_stage(spark, docs, folder)
    assert {r["doc_id"] for r in packed.collect()} == kept[3]


def test_run_packs_what_the_stages_keep(spark, folder):
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(range(60)) <= got and 402 in got and not got & {100, 200, 201, 300, 400, 401}


def _shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c in string.ascii_uppercase else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_near_duplicate_stage_equals_plain_python(spark, folder):
    docs = documents(spark)
    rows = [(r["doc_id"], _shingles(r["text"])) for r in docs.collect() if r["doc_id"] is not None]
    group = {d: d for d, _ in rows}
    while True:
        before = dict(group)
        for a, x in rows:
            for b, y in rows:
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    group[a] = min(group[a], group[b])
        if group == before:
            break
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, folder).collect()]
    want = [d for d, least in group.items() if d == least]
    assert sorted(d for d in got if d is not None) == sorted(want) and got.count(None) == 1


def test_decontamination_stage_equals_plain_python(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    cut = item[:60] + "#" + item[61:]  # one edit
    texts = {1: item, 2: "before " + item.upper() + " after", 3: cut, 4: item[: len(item) // 2], 5: None, 6: "", 7: prose(78, 3000), 8: prose(78, 3000) + " " + item}
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()] + [(1, item, "en", "a"), (None, item, "en", "a"), (None, "free", "en", "a")])
    got = corpus_pipeline.decontamination_stage(spark, docs, folder)
    held = {i for i, t in texts.items() if item in (t or "").lower().replace("#", item[60])}
    assert held == {1, 2, 3, 8}
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([*(set(texts) - held), None], key=str)


def test_stages_stand_empty_tables(spark, folder, tmp_path):
    sf = str(tmp_path)
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{sf}/{name}.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.toxicity_stage(spark, docs, sf).where("doc_id < 60").count() == 60
    assert corpus_pipeline.decontamination_stage(spark, docs, sf).count() == docs.count()


def test_stages_judge_repeated_rows_alike(spark, folder, tmp_path):
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.union(docs).write.parquet(f"{sf}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, sf).where("piece = 0").collect()]
    assert len(got) == len(set(got)) and set(range(60)) <= set(got) and not set(got) & {100, 200, 201, 300, 400, 401}


def test_queries_cover_all_operators():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_sql_twins(spark):
    db = duckdb.connect()
    for t in ("conversations", "documents"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got = queries.QUERIES[name](spark, SF)
        want = db.sql(sql)
        cols = sorted(got.columns)
        assert sorted(want.columns) == cols
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted(db.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall(), key=str)
