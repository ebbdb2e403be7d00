import corpus_pipeline
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.quality import fit, judge
from test_line_dedup import brute as brute_lines
from test_packing import check as check_packing
from test_packing import one_by_one
from test_simhash import brute_components, brute_fp


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_and_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    outs, d = [], docs
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, SMALL).cache()
        outs.append(d)
    assert all(o.columns == docs.columns for o in outs[:-1])
    quality, lines, near, clean, packed = outs

    scorer = fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = {r.doc_id for r in judge(docs, scorer).collect() if r.kept}
    assert {*rows_of(quality)} == kept and 100 < len(kept) < 200

    want = brute_lines(list(rows_of(quality).items()), 10)
    assert rows_of(lines) == {k: w[2] for k, w in want.items()}

    items = list(rows_of(lines).items())
    groups = brute_components([(k, brute_fp(t)) for k, t in items])
    assert rows_of(near) == {k: t for (k, t), g in zip(items, groups) if k == g}

    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = rows_of(near), rows_of(clean)
    assert {k for k, t in before.items() if any(b in t for b in bench)} == {*before} - {*after}
    assert all(before[k] == t for k, t in after.items())

    got = packed.collect()
    assert check_packing(got, list(after.items()), 2048) <= one_by_one([r.length for r in got], 2048)

    ran = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r[:5] for r in ran) == sorted(r[:5] for r in got)
    assert len({r.sequence_id for r in ran}) == len({r.sequence_id for r in got})


@pytest.mark.parametrize("rows", [True, False])
def test_odd_documents_pass_every_stage(spark, rows):
    text = " ".join(f"word{i % 7}{chr(97 + i % 26)}" for i in range(60))
    data = [(1, text, "en", "s", 1, "x"), (1, text, "en", "s", 1, "x"), (None, text + " more", None, None, None, None), (2, None, "de", "s", 0, "y"),
            (3, "", None, "s", 0, "z"), (4, "long text here " * 40_000, "en", "s", 7, None)]
    docs = spark.createDataFrame(data if rows else [], "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
    if rows:
        assert docs.select(F.count_distinct("doc_id")).first()[0] == 1   # ids 1 and NULL: near copies, the first stays
    else:
        assert docs.count() == 0
