"""The stages on given and on odd documents, against brute force where there is one."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from siftload.llm import pseudonyms, queries
from siftload.llm.common import table
from siftload.sources.staging import staged
from tests.llm.test_decontaminate import brute as windows_in
from tests.llm.test_jaccard_join import brute as components

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_query_is_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(key.split("_")[0].removeprefix("op")) for key in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding and decoding",
    ]


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gets and gives on the given documents."""
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, FOLDER))
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_stay_until_the_end(steps):
    for _, before, after in steps[:-1]:
        assert before.columns == after.columns == COLUMNS
    assert steps[-1][2].columns == ["doc_id", "lang", "source", "ids", "n_pieces", "round_trip"]


def test_filters_keep_rows_as_they_are(steps):
    for _, before, after in steps[:3]:
        old, new = rows_of(before), rows_of(after)
        assert 0 < len(new) <= len(old) and all(old[i] == r for i, r in new.items())


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    lower = [(r["doc_id"], re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])) for r in before.collect()]
    assert set(rows_of(after)) == {d for d, _, c in components(lower, 5, 80) if d == c}


def test_contaminated_documents_go(spark, steps):
    _, before, after = steps[2]
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    clean = {r["doc_id"] for r in before.collect() if not windows_in(r["text"], items, 10)[4]}
    assert set(rows_of(after)) == clean


def test_no_personal_data_is_left(steps):
    _, before, after = steps[3]
    old, new = rows_of(before), rows_of(after)
    assert set(old) == set(new)
    for i, r in new.items():
        assert r["n_chars"] == len(r["text"])
        for pattern in (pseudonyms.EMAIL, pseudonyms.PHONE, r"(?<![0-9])[0-9]{16}(?![0-9])"):
            for value in re.findall(pattern, old[i]["text"]):
                assert value not in r["text"]


def test_pieces_give_the_text_back(steps):
    _, before, after = steps[4]
    assert after.count() == before.count() and after.where("NOT round_trip").count() == 0


def test_odd_documents(spark):
    rows = [
        (1, "plain words that stand in no other text at all", "en", "s", 46), (1, "plain words that stand in no other text at all", "en", "s", 46),
        (1, "another text under the same id", "en", "s", 30), (None, "plain words that stand in no other text at all", None, None, None), (None, None, None, None, None),
        (2, "", "en", "s", 0), (3, "", "en", "s", 0), (4, None, "en", "s", 0), (5, "call +1 (017) 555-7713 now", "en", "s", 26),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", F.lit("x").alias("n_shingles"), F.lit(0).alias("contaminated"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, FOLDER))
    got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    phone = next(t for i, t in got if i == 5)
    assert "555-7713" not in phone
    assert [g for g in got if g[0] != 5] == sorted(
        [(1, rows[0][1]), (1, rows[2][1]), (None, None), (2, ""), (3, ""), (4, None)], key=str
    )
    assert corpus_pipeline.pieces(spark, docs, FOLDER).count() == len(got)
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0
