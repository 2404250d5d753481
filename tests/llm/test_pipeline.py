import random

import corpus_pipeline
from tests.llm.test_simhash import slow_first


def planted(rng, groups):
    """Long texts and copies of them with no, few or many words replaced."""
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(2000)}" for _ in range(rng.choice((60, 200, 500)))]
        for changes in (0, 0, 1, 2, 9, 40):
            copy = list(base)
            for at in rng.sample(range(len(base)), changes):
                copy[at] = f"new{rng.randrange(10 ** 6)}"
            rows.append(" ".join(copy))
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def run_on(spark, folder, docs, monkeypatch):
    """Rows before and after each stage of run()."""
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen = {}

    def kept(name, stage):
        def run(*args):
            out = stage(*args)
            seen[name] = args[1].collect(), out.collect()
            return out
        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [kept(*s) for s in corpus_pipeline.STAGES])
    return corpus_pipeline.run(spark, str(folder)).collect(), seen


def test_near_copies_against_all_pairs(spark, tmp_path, docs_of, monkeypatch):
    rows, seen = run_on(spark, tmp_path, docs_of(planted(random.Random(23), 15)), monkeypatch)
    before, after = ([(r["doc_id"], r["text"]) for r in part] for part in seen["simhash near-dedup"])
    assert sorted(after) == slow_first(before) and len(after) < len(before)
    assert {r["doc_id"] for r in rows} <= {doc for doc, _ in after}


def test_odd_rows_and_clashing_names(spark, tmp_path, odd_docs, odd_rows, monkeypatch):
    rows, seen = run_on(spark, tmp_path, odd_docs, monkeypatch)
    before, after = seen["simhash near-dedup"]
    assert len(before) == len(odd_rows) and len(after) < len(before)
    assert rows and set(odd_docs.columns) <= set(rows[0].asDict())
    assert all(0 <= r["shard"] < 24 for r in rows)


def test_no_documents(spark, tmp_path, no_docs, monkeypatch):
    assert run_on(spark, tmp_path, no_docs, monkeypatch)[0] == []
