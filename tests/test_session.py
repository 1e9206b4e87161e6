"""Session defaults and shared scratch locations."""

from tessera.session import SQL_DEFAULTS, ensure_checkpoint_dir, scratch_dir


def test_defaults_and_explicit_conf(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"        # explicit conf kept
    assert spark.conf.get("spark.sql.session.timeZone") == SQL_DEFAULTS["spark.sql.session.timeZone"]
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.sparkContext.getConf().get("spark.ui.enabled") == "false"


def test_scratch_is_under_the_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/")) and a != b


def test_a_cluster_needs_a_shared_folder():
    import pytest

    class Conf(dict):
        get = dict.get

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext, conf = Context, Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
