"""The corpus pipeline: each stage against brute force over its own input."""

import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline as P
from ledgerloom.llm import quality, queries, simhash, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The Parquet written by each stage, as the next one reads it."""
    folder, out = tmp_path_factory.mktemp("stages"), [f"{SF}/documents.parquet"]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, spark.read.parquet(out[-1]), SF).write.parquet(str(folder / str(k)))
        out.append(str(folder / str(k)))
    return out


def rows(spark, path):
    return spark.read.parquet(path).toPandas()


def test_stages_keep_the_columns_of_documents(spark, stages):
    first = spark.read.parquet(stages[0]).columns
    assert all(spark.read.parquet(p).columns == first for p in stages[1:-1])
    assert [n for n, _ in P.STAGES] == ["toxicity", "quality", "near_duplicates", "mix", "tokenize"]


def test_toxic_documents_go(spark, stages):
    docs = spark.read.parquet(stages[0])
    score = toxicity.Scorer(toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    want = [i for i, t in zip(*(rows(spark, stages[0])[c] for c in ("doc_id", "text")), strict=True) if score(t.encode())[0] < toxicity.REJECT]
    assert sorted(rows(spark, stages[1]).doc_id) == sorted(want)


def test_poor_documents_go(spark, stages):
    docs = spark.read.parquet(stages[1])
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [i for i, t in zip(*(rows(spark, stages[1])[c] for c in ("doc_id", "text")), strict=True) if quality.judge(t, model)[-1]]
    assert sorted(rows(spark, stages[2]).doc_id) == sorted(want)


def test_one_of_each_group_stays(spark, stages):
    before, after = rows(spark, stages[2]), rows(spark, stages[3])
    sets = [set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in before.text]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [y if r == x else r for r in root]
    groups = {}
    for i, r in zip(before.doc_id, root, strict=True):
        groups.setdefault(r, []).append(i)
    assert sorted(after.doc_id) == sorted(min(g) for g in groups.values())


def test_mix_follows_the_schedule(spark, stages):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{stages[3]}/*.parquet'")
    want = {d: int(np.floor(t / s + 0.5)) for d, s, t in c.sql(f"SELECT doc_id, size, taken FROM ({queries.ORACLE_SQL['op4_fair_mix']}) WHERE taken > 0").fetchall()}
    got = rows(spark, stages[4]).doc_id.value_counts().to_dict()
    assert got == {d: n for d, n in want.items() if n}


def test_tokens_of_every_row(spark, stages):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary_path())
    before, after = rows(spark, stages[4]), rows(spark, stages[5])
    text = dict(zip(before.doc_id, before.text, strict=True))
    assert sorted(after.doc_id) == sorted(before.doc_id)
    assert all(list(r.ids) == t.encode(text[r.doc_id], add_special_tokens=False).ids for r in after.itertuples())


def test_run_gives_what_the_stages_give(spark, stages):
    a = sorted((r["doc_id"], r["ids"]) for r in P.run(spark, SF).collect())
    assert a == sorted((r["doc_id"], r["ids"]) for r in spark.read.parquet(stages[5]).collect())
