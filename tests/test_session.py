from candela.session import DEFAULT_CONF, checkpoint_dir, get_session


def test_get_session_reuses_and_keeps_explicit_settings(spark):
    same = get_session(conf={"spark.sql.adaptive.skewJoin.enabled": "false"})
    assert same is spark or same.sparkContext is spark.sparkContext
    assert same.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    same.conf.set("spark.sql.adaptive.skewJoin.enabled", DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"])
    assert same.conf.get("spark.sql.adaptive.enabled") == "true"


def test_checkpoint_dir_prefers_the_session_setting(spark, scratch):
    current = checkpoint_dir(spark)
    assert current
    # a fallback never replaces a folder that is already configured
    assert checkpoint_dir(spark, fallback="/nonexistent/elsewhere") == current
