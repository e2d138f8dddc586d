from tests.conftest import SF_SMALL


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["rowkey", "click_count"]
    assert df.count() == 851
    qs, oq = E.queries(), E.oracle_sql()
    assert set(oq) <= set(qs)
    from tidemark.plans.registry import ORACLE, QUERIES
    assert set(QUERIES) <= set(qs) and set(QUERIES) - set(ORACLE) == {"random_code"}


def test_every_query_runs_small(spark):
    from tidemark.plans.registry import QUERIES
    for name, fn in QUERIES.items():
        df = fn(spark, SF_SMALL)
        assert df.count() >= 0, name


def test_scale_conf():
    from tidemark.session import scale_conf
    c = scale_conf(100 * 2 ** 40, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (256 << 20))
    assert scale_conf(1 << 30, 8000)["spark.sql.shuffle.partitions"] == "16000"
    assert c["spark.sql.adaptive.enabled"] == "true"


def test_shared_root_is_stable(spark):
    from tidemark.session import checkpoint_root, scratch_dir, shared_root
    base = shared_root(spark)
    assert checkpoint_root(spark).startswith(base + "/")
    assert scratch_dir(spark, "x").startswith(checkpoint_root(spark) + "/")
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        assert base.endswith(conf.rstrip("/"))


def test_entry_without_the_corpus_side(tmp_path):
    """A copy without the corpus folders still names every other query."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    from tidemark.plans.registry import ORACLE, QUERIES
    home = Path(__file__).parent.parent
    say = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    for keep_pipeline in (True, False):
        copy = tmp_path / f"copy{keep_pipeline}"
        shutil.copytree(home / "tidemark", copy / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if keep_pipeline else [])):
            shutil.copy(home / name, copy / name)
        got = subprocess.run([sys.executable, "-c", say], cwd=copy, capture_output=True, text=True, check=True).stdout
        names, sql = got.strip().split(" | ")
        assert names.split() == sorted(QUERIES) and sql.split() == sorted(ORACLE)
