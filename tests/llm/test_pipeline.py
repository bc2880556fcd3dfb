import cases
import corpus_pipeline
import pytest

from obligo.llm import registry, toxicity
from obligo.llm.common import prepare

NUMBERED = {f"op{n}_" for n in range(1, 14)}


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as entry_points

    assert {q[:q.index("_") + 1] for q in registry.QUERIES if q != "pipeline"} == NUMBERED
    assert registry.QUERIES.items() <= entry_points.queries().items()
    assert registry.SQL.items() <= entry_points.oracle_sql().items()


def test_the_package_is_sent_to_the_executors_once(spark):
    for _ in range(2):
        prepare(spark)
    sent = [x for x in spark.sparkContext._python_includes if x.startswith("obligo-")]
    assert len(sent) == 1


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    for k, docs in enumerate((cases.awkward(spark), cases.awkward(spark).limit(0))):
        folder = str(tmp_path / str(k))
        cases.labels(spark).write.parquet(f"{folder}/labels.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
                out.write.parquet(f"{folder}/{name}")
                docs = spark.read.parquet(f"{folder}/{name}")
        assert (out.count() > 0) == (k == 0)


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_every_stage_against_brute_force(spark, tmp_path):
    import test_exact_dedup
    import test_packing
    import test_simhash

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{cases.MIDDLE}/documents.parquet")

    def after(name, docs):
        stages[name](spark, docs, cases.MIDDLE).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == docs.columns
        return out, sorted((r.doc_id, r.text) for r in out.collect())

    toxic = {r.doc_id for r in toxicity.query(spark, cases.MIDDLE).collect() if r.predicted}
    clean, pairs = after("toxicity", docs)
    assert toxic and pairs == [x for x in cases.given(cases.MIDDLE) if x[0] not in toxic]

    left, rest = after("exact_dedup", clean)
    kept = {r[0] for r in test_exact_dedup.expected(pairs) if r[3]}
    assert rest == [x for x in pairs if x[0] in kept]

    apart, last = after("simhash_dedup", left)
    roots = {r[2] for r in test_simhash.expected(rest)}
    assert last == [x for x in rest if x[0] in roots]

    mixed, taken = after("mix_sources", apart)
    assert set(taken) <= set(last) and len(set(taken)) >= 0.9 * len(last)

    encoder = test_packing.Encoder.of_worker(test_packing.tokenizer_path())
    _, got = test_packing.verified(stages["pack"](spark, mixed, cases.MIDDLE))
    assert got == test_packing.brute_pieces(encoder, taken)
    _, run = test_packing.verified(corpus_pipeline.run(spark, cases.MIDDLE))
    assert run == got
