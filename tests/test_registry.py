"""Every registered query against its SQL, and the plans that matter at scale."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registry
from checks.compare import connect, difference
from tests.conftest import SF_DIR

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = con.execute(ORACLES[name])
    want = [c[0] for c in answer.description], answer.fetchall()
    assert difference((df.columns, [tuple(r) for r in df.collect()]), want) is None


@pytest.mark.parametrize("name", ["scaled_train_test", "fit_lr", "model_curve"])
def test_model_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["feature_table", "training_set", "training_set_gap", "churn_label", "static_profile"])
def test_log_is_never_sorted_nor_crossed(spark, name):
    plan = executed(QUERIES[name](spark, SF_DIR))
    for node in ("SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert node not in plan


def test_plays_are_shuffled_once(spark):
    plan = executed(QUERIES["popular_song_share"](spark, SF_DIR))
    final = plan.split("\n+- == Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange \[userId#\d+, singer_song", final)) >= 1
    assert len(re.findall(r"ReusedExchange \[singer_song", final)) >= 1


def test_the_fold_of_plays_is_shuffled_once_and_expanded_after(spark):
    from staypath.plans.content import content_of, folded_song_plays, plays_fold, popular_share_of
    from staypath.operators.activity import activity
    from staypath.sources import star, tables
    events = activity(tables.staged(star.event_log(spark, SF_DIR)))
    fold = plays_fold(events, 2)
    both = content_of(fold).join(popular_share_of(folded_song_plays(fold)), "userId", "left")
    plan = executed(both).split("\n+- == Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange \[userId#\d+, artist", plan)) >= 1
    scans = [line for line in plan.splitlines() if "Scan parquet" in line or "FileScan" in line]
    assert len(scans) == 1, scans
    # what is expanded is the fold: the scan lies below an exchange below the Expand
    assert plan.index("Expand") < plan.index("Exchange hashpartitioning(userId", plan.index("Expand")) < plan.index("FileScan")


def test_narrow_query_reads_narrow_columns(spark):
    plan = QUERIES["auth_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["props:string"]


def test_registry_without_the_corpus_operators(tmp_path):
    root = Path(registry.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda folder, names: {n for n in names if n in (".git", "llm", "corpus_pipeline.py")})
    code = "import __spark_entry__ as r; print(len(r.queries()), 'feature_table' in r.queries(), [n for n in r.queries() if n.startswith('op') or n == 'pipeline'])"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    assert done.stdout.split(maxsplit=1)[1].strip() == "True []"
    # a pipeline without its operators is left out as well
    if (root / "corpus_pipeline.py").exists():
        shutil.copy(root / "corpus_pipeline.py", copy)
        assert subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True).stdout == done.stdout
