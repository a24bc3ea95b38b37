from pyspark.sql import functions as F

from siltline.llm import quality_rules
from tests.llm import brute

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def verdicts(docs):
    found = quality_rules.assess(docs, ["doc_id"]).select("doc_id", "quality.*").collect()
    return {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found}


def test_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    assert verdicts(docs) == brute.verdicts(rows)


def test_edge_cases(spark):
    line = "the quick brown fox of an old house and its garden is in a small town"
    rows = [
        (1, None, "en"), (2, "", None), (3, " \n\t ", "xx"), (4, f"{line} one\n{line} two\n{line} one", "en"),
        (5, "a b c d e f g h a b c d e f g h i", "en"), (6, "w " * 20000, "en"), (7, line * 30, None),
        (8, "é è ê 漢字 😀 " * 40, "fr"), (9, "### $$$ *** " * 60, "en"), (10, "AB! CD!! " * 80, "de"),
        (11, "same same\nsame same\n\n\nsame same\r\nsame same", "en"), (None, line, "en"),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, _text string, n_words int")
    assert verdicts(docs) == brute.verdicts(rows)
    kept = quality_rules.keep_good(docs.union(docs))
    assert kept.columns == docs.columns
    want = sorted(d for d, v in brute.verdicts(rows).items() if v[-1] and d is not None)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want * 2)


def test_unlike_characters_are_rejected_and_clean_text_is_kept(spark):
    clean = [(i, " ".join(f"the {chr(97 + i % 26)}word of text{'s' * (k % 5)} and" for k in range(40)) + ".", "en") for i in range(40)]
    clean = [(i, t.replace("aword", f"word{'xyz'[i % 3]}"), lang) for i, t, lang in clean]
    varied = [(i, " ".join(f"{w}{k if k % 7 == 0 else ''}" for k, w in enumerate(t.split())), lang) for i, t, lang in clean]
    junk = [(100 + i, " ".join(f"#{k}$%|<>*&#$" for k in range(80)), "en") for i in range(3)]
    got = verdicts(spark.createDataFrame(varied + junk, "doc_id long, text string, lang string"))
    assert got == brute.verdicts(varied + junk)
    assert not any(got[100 + i][-1] for i in range(3))
    assert all(v[-1] for d, v in got.items() if d < 100 and not v[-2])


def test_reference_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality_rules.assess(docs, ["doc_id"]).count() == 0 and quality_rules.references(docs).count() == 0
    same = spark.createDataFrame([(1, [3, 1], [3, 1]), (2, [1, 0], [0, 1]), (3, [0, 0], [1, 1])], "k int, a array<long>, b array<long>")
    for name in ("a", "b"):
        same = quality_rules._with_total(same, name)
    got = {r.k: r.d for r in same.select("k", quality_rules.distance("a", "b").alias("d")).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: None}
    assert "Python" not in quality_rules.assess(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
