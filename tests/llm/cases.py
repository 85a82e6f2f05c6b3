"""Small documents with the cases every operator must stand."""

import random

WORDS = "the of and sea river stone cloud amber quick table under seven garden violet market signal paper engine".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice("abcdefgh") if r.random() < 0.5 else "") for _ in range(words))


def documents(spark, rows=None):
    """doc_id, text, lang, source, n_chars and columns whose names clash with the operators' own."""
    if rows is None:
        base = prose(1, 80)
        w = base.split()
        rows = [(i, prose(100 + i, 30 + 7 * i), "en", "a") for i in range(12)]
        rows += [(20, base, "en", "a"), (21, base, "en", "b"), (22, base.upper(), "fr", "a")]
        rows += [(23 + k, " ".join([*w[:40], f"new{k}", *w[41:]]), "en", None) for k in range(4)]
        rows += [(30, None, "en", "a"), (31, "", None, "a"), (32, " \n\t", "en", "a"), (33, "one", "en", "a"), (34, "One", "en", "a")]
        rows += [(35, "two words", "en", "a"), (36, "x" * 5000, "en", "a"), (37, prose(5, 6000), "en", "a"), (38, "1234 !!! ….", "en", "a")]
        rows += [(39, "日本語 テキスト 😀  ß", "ja", "b"), (39, "日本語 テキスト 😀  ß", "ja", "b"), (None, base, "en", "a")]
    rows = [(i, t, lang, s, len(t or ""), 1, "x", 0.5) for i, t, lang, s in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int, token string, score double").repartition(3)
