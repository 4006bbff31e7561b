import corpus_pipeline
import __spark_entry__ as entry_module
from locusweave.llm import queries

from .conftest import DATA, needs_data
from .test_decontamination import brute as contaminated
from .test_near_duplicates import brute as classes
from .test_packing import tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_everything_is_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    found = entry_module.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(entry_module.oracle_sql())


@needs_data
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.stored(stage(spark, docs, DATA))
        assert docs.columns == COLUMNS
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert after and set(after) <= set(before)
        if name in ("toxicity", "quality"):
            query = queries.QUERIES["op7_toxicity" if name == "toxicity" else "op10_quality"]
            if name == "toxicity":
                keep = {r.doc_id for r in query(spark, DATA).collect() if not r.predicted}
                assert {i for i, _ in after} == keep
        if name == "near_duplicates":
            assert sorted(i for i, _ in after) == sorted({c for _, c, _ in classes(before)})
        if name == "decontamination":
            bad = {r[0] for r in contaminated(before, benchmark) if r[4]}
            assert sorted(i for i, _ in after) == sorted(i for i, _ in before if i not in bad)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert sum(r.length for r in last) == sum(len(tokens.encode(t or "")) + 1 for _, t in after)
    assert sorted((tuple(r) for r in corpus_pipeline.run(spark, DATA).collect())) == sorted(map(tuple, last))
