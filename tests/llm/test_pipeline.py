"""The corpus pipeline and the registered queries on small tables."""

from __future__ import annotations

import collections

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
import public_tokenizers

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
NAMES = [f"op{k}_" for k in range(1, 14)]


def test_every_operator_is_registered_once():
    own = [q for q in __spark_entry__.queries() if q.startswith("op") and q.split("_")[0][2:].isdigit()]
    assert sorted(q.split("_")[0] + "_" for q in own) == sorted(NAMES)
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()


@pytest.mark.parametrize("prefix", ["op4_", "op7_", "op10_", "op11_", "op13_"])
def test_queries_match_their_sql(spark, prefix):
    name = next(q for q in __spark_entry__.queries() if q.startswith(prefix))
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(__spark_entry__.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).itertuples(index=False, name=None))) for d in (got, want)]
    assert len(rows[0]) == len(rows[1])
    if prefix != "op10_":  # nullable columns have other Python types on either side
        assert rows[0] == rows[1]
    else:
        assert got.sort_values("page_id")["payload_digest"].tolist() == want.sort_values("page_id")["payload_digest"].tolist()


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = docs.limit(3).withColumns({"doc_id": F.col("doc_id") + 9000, "text": F.lit("### $$$ |||")})
    copies = docs.limit(5).withColumn("doc_id", F.col("doc_id") + 8000)
    private = docs.limit(20).withColumns({"doc_id": F.col("doc_id") + 7000, "text": F.concat(F.col("doc_id").cast("string"), F.lit(" unlike "), F.reverse("text"), F.lit(" mail jo.smith@mail.example.org now"))})
    odd = spark.createDataFrame([(None, None, None, None, None), (9500, "", None, "", 0)], docs.schema)
    docs.unionByName(junk).unionByName(copies).unionByName(private).unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    steps, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        steps[name] = now
    ids = {name: [r["doc_id"] for r in df.select("doc_id").collect()] for name, df in steps.items()}
    quality, dedup, pii, mixed, encoded = ids.values()
    assert not {9000, 9001, 9002, 9500, None} & set(quality) and len(quality) > 0.7 * docs.count()
    assert not {i for i in dedup if 8000 <= i < 8005} and len(dedup) == len(set(dedup))
    assert sorted(pii) == sorted(dedup)
    assert steps["personal data"].filter("text like '%jo.smith@%'").count() == 0
    assert steps["simhash near-dedup"].filter("text like '%jo.smith@%'").count() > 0
    assert steps["personal data"].filter("n_chars <> length(text)").count() == 0
    assert max(collections.Counter(mixed).values()) == 2 and set(mixed) <= set(pii)
    assert sorted(encoded) == sorted(mixed)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in steps["byte-level BPE"].limit(50).collect():
        assert r["ids"] == theirs.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
