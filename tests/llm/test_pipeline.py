from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_operators import null_id_groups


def test_stages_equal_plain_versions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        made = spark.read.parquet(path)
        rows = sorted((r.doc_id, r.text) for r in made.collect())
        if number < 4:
            assert made.columns == docs.columns
        if name == "quality_rules":
            assert 0 < len(rows) < len(before) and set(rows) <= set(before)
        elif name == "near_duplicates":
            heads = {r[2] for r in brute.near_duplicates(before, 5)}
            assert rows == sorted(r for r in before if r[0] in heads)
        elif name == "suffix_dedup":
            wanted = dict(brute.without_passages(before, 255, 51, 400))
            assert {d: t.encode() for d, t in rows}.keys() == wanted.keys()
            # A character that a cut would split is kept whole.
            assert all(0 <= len(t.encode()) - len(wanted[d]) <= 12 for d, t in rows)
        elif name == "decontamination":
            clean = {r[0] for r in brute.contamination(before, items) if not r[2]}
            assert rows == sorted(r for r in before if r[0] in clean)
        else:
            assert rows == sorted(before) and made.filter(~F.col("round_trip")).count() == 0
        docs = made


def test_pipeline_on_odd_documents(spark, sf, tmp_path):
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (None, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(odd, schema).withColumn("kept", F.lit(1)).withColumn("row", F.lit(2))
    blank, both = (None, ""), [(1, None), (None, "")]
    wanted = {
        "quality_rules": [],
        "near_duplicates": both,
        "suffix_dedup": [(1, ""), blank, blank],
        "decontamination": [*both, blank],
        "bpe": [*both, blank],
    }
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        made = stage(spark, docs, sf).collect()
        assert sorted(((r.doc_id, r.text) for r in made), key=str) == sorted(wanted[name], key=str)
        if name == "bpe":
            assert [(r.n_tokens, bytes(r.ids), r.round_trip) for r in made] == [(0, b"", True)] * 3
        else:
            assert all(r.kept == 1 and r.row == 2 for r in made)


def test_a_passage_of_fifty_one_words_is_cut_from_unlike_documents(spark, sf):
    word = lambda seed, n: " ".join(f"{'abcdefgh'[(i * seed) % 8]}{(i * i * seed) % 97:03d}" for i in range(n))
    passage, short = word(3, 51), word(5, 40)
    docs = [(i, f"{word(7 + i, 60)} {passage} {word(20 + i, 30)}", "en", "s", 0) for i in range(2)]
    docs += [(2 + i, f"{word(40 + i, 60)} {short} {word(50 + i, 30)}", "en", "s", 0) for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    made = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, df, sf).collect()}
    assert all(passage[2:-2] not in made[i] and len(made[i]) >= len(docs[i][1]) - len(passage) - 12 for i in range(2))
    assert all(made[i] == docs[i][1] for i in (2, 3))


def test_decontamination_keeps_clean_rows_of_a_contaminated_id(spark, sf):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    passage = next(t for i, t in items if i is not None and len((t or "").split()) > 20)
    bad, clean = f"before {passage} after", "nothing of any benchmark is in this text"
    docs = [
        (None, bad), (None, clean), (None, clean), (None, None), (None, ""),
        (7, clean), (7, bad), (7, f"{clean} at all"), (8, bad), (9, None),
    ]
    wanted = [d for d in docs if d[1] != bad]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_hit", F.lit(1))
    made = corpus_pipeline.decontaminate(spark, df, sf)
    assert made.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in made.collect()), key=str) == sorted(wanted, key=str)


def test_near_duplicate_stage_judges_rows_without_id(spark, sf):
    groups = null_id_groups()
    docs = [d for g in groups for d in g] + [(None, None), (None, None), (5, " "), (5, " ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(1))
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df, sf).collect()]
    assert [sum(r in g for r in rows) for g in groups] == [1] * len(groups)
    assert len(rows) == len(groups) + 2 and rows.count((None, None)) == rows.count((5, " ")) == 1
