from trailmark import session


def test_checkpoint_dir_is_the_sessions(spark):
    path = session.checkpoint_dir(spark)
    assert path
    assert session.scratch_path(spark, "x").startswith(path)


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id * 2 AS v")
    m = session.materialize(df)
    assert sorted(r.v for r in m.collect()) == list(range(0, 20, 2))
    assert "Scan ExistingRDD" in m._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in m._jdf.queryExecution().optimizedPlan().toString()


def _python(code, tmp_path):
    import os
    import subprocess
    import sys
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(__file__))}
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)


def test_a_plain_local_session(tmp_path):
    done = _python("from trailmark.session import get_session, materialize\n"
                   "s = get_session('local[2]', 2)\n"
                   "assert s.conf.get('spark.sql.session.timeZone') == 'UTC'\n"
                   "assert s.conf.get('spark.ui.enabled') == 'false'\n"
                   "assert materialize(s.range(5)).count() == 5", tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]


def test_settings_of_the_caller_survive(tmp_path):
    done = _python("from pyspark.sql import SparkSession\n"
                   "b = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')\n"
                   "b = b.config('spark.sql.session.timeZone', 'America/New_York')\n"
                   "s = b.config('spark.sql.adaptive.skewJoin.enabled', 'false').getOrCreate()\n"
                   "from trailmark.session import get_session\n"
                   "t = get_session()\n"
                   "assert t is s and t.conf.get('spark.sql.session.timeZone') == 'America/New_York'\n"
                   "assert t.conf.get('spark.sql.adaptive.skewJoin.enabled') == 'false'", tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]


def test_local_cluster_is_no_single_process():
    assert session._is_local("local") and session._is_local("local[4]")
    assert not session._is_local("local-cluster[2,1,1024]") and not session._is_local("yarn")


def test_written_once_leaves_nothing(spark):
    with session.written_once(spark.range(7)) as df:
        path = df.inputFiles()[0].rpartition("/")[0]
        assert df.count() == 7 and session.path_exists(spark, path)
    assert not session.path_exists(spark, path)
