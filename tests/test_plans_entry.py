"""Plan shape (no Python UDF in text work, pruning windows, no row joins in
splits) and the driver entry point."""

import __spark_entry__ as E
from tomewise.operators import dedup, ngrams, splits
from tomewise.plans import prepare as P

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_queries_have_no_python_udf(spark):
    q = E.queries()
    for name in ["clean_text", "normalised_text", "text_features", "remove_stopwords", "top_bigrams",
                 "polarity", "encode_ids", "clean_pages"]:
        plan = _plan(q[name](spark, SF001))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_dedup_and_topk_prune_before_shuffle(spark):
    d = dedup.dedup_keep_first(P.normalised(spark, SF001))
    d._jdf.queryExecution().executedPlan()
    opt = d._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt
    t = ngrams.top_ngrams(P.train_rows(spark, SF001), "review_text", 2, "rating", 10)
    assert "WindowGroupLimit" in t._jdf.queryExecution().optimizedPlan().toString()


def test_exact_group_split_never_joins_rows(spark):
    s = splits.group_split_exact(P.processed(spark, SF001))
    plan = _plan(s)
    assert "Join" not in plan and "Window" not in plan


def test_scan_prunes_columns(spark):
    q = E.queries()["rating_counts"](spark, SF001)
    plan = _plan(q)
    assert "ReadSchema: struct<n_chars:bigint>" in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["split", "rating", "n_rows", "share"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_scans_are_not_reshuffled(spark):
    from tomewise import fixtures
    for name in ("documents", "pages", "conversations", "events", "embeddings"):
        assert "Exchange" not in _plan(fixtures.table(spark, SF001, name))
    # a narrow aggregate combines before its only exchange
    assert _plan(E.queries()["rating_counts"](spark, SF001)).count("Exchange") == 1


def test_model_agreement_compares_in_place(spark):
    plan = _plan(E.queries()["model_agreement"](spark, SF001))
    assert plan.count("Exchange") == 1 and "Generate" not in plan  # the last sum only


def test_statistics_do_not_depend_on_a_switch(spark):
    import pathlib
    code = "".join(p.read_text() for p in pathlib.Path(E.__file__).parent.glob("tomewise/operators/*.py"))
    for name in ("percentile", "EXACT_DISTINCT_LIMIT", "driver_pick_limit", "MAX_RANK_WINDOW", "localCheckpoint"):
        assert name not in code


def test_evaluation_reads_the_scored_table_once(spark):
    q = E.queries()
    for name in ["model_comparison", "eval_by_split", "f1_per_class", "micro_metrics"]:
        plan = _plan(q[name](spark, SF001))
        assert plan.count("FileScan parquet") == 1 and "Union" not in plan, name
    # the confusion matrix reads its written cell table, never the rows again
    assert "FileScan parquet" not in _plan(q["confusion_matrix"](spark, SF001))
