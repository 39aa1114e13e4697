import pytest
from pyspark.errors import AnalysisException

import corpus_pipeline as c
from conftest import SF_SMALL
from llm import brute
from llm.test_op5_line_dedup import units
from strivelake.llm.common import scratch_scope, stage


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in c.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        texts.append({r.doc_id: r.text for r in rows})
        docs = spark.createDataFrame(rows, out.schema)
        assert name == "mixing" or out.columns == columns
    start, kept, cut, single, clean, mixed = texts
    assert all(not brute.base_quality(t)[5] for t in kept.values()) and len(kept) > 0.75 * len(start)
    assert set(cut) == set(kept)
    for d, t in cut.items():  # what is left of a text is a subsequence of its units
        left = iter(units(kept[d]))
        assert all(any(u == v for v in left) for u in units(t)) or t == kept[d]
    assert set(single) == {d for d, (_, root) in brute.near_components(cut.items()).items() if d == root}
    dirty = brute.decontaminated(single.items(), items)
    assert set(clean) == {d for d in single if not dirty[d][1]}
    assert 0 < len(mixed) <= len(clean) and all(mixed[d] == clean[d] for d in mixed)
    assert all(0 < r.taken <= 3 * r.size for r in rows)
    again = c.run(spark, SF_SMALL)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_staged_tables_go_with_their_scope(spark):
    with scratch_scope(spark):
        kept = stage(spark.range(5).toDF("n"), "scoped")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 5 and spark.read.parquet(path).count() == 5
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_empty_and_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, taken string"
    prose = "The old lighthouse stood on a cliff, and every evening its keeper climbed the narrow stairs. " * 2
    rows = [(1, None, None, None, 0, 1, "x"), (None, prose + "Null id.", "en", None, 1, 1, "x"), (3, "", "en", "s", 0, 1, "x"),
            (4, prose + "A different ending, told by someone else entirely.", "en", "s", 5, 1, None)]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for _, stage in c.STAGES:
            docs = stage(spark, docs, SF_SMALL)
        docs.collect()
