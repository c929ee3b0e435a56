from ampere.session import SCALE_CONF, apply_scale_conf, ensure_checkpoint_dir


def test_scale_conf_keeps_cluster_values(spark):
    conf = spark.sparkContext.getConf()
    before = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        apply_scale_conf(spark)
        for key, value in SCALE_CONF.items():
            if conf.contains(key):          # set by the cluster / builder: untouched
                assert spark.conf.get(key) == conf.get(key)
            else:
                assert spark.conf.get(key) == value
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for key, value in before.items():
            if not conf.contains(key):
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def test_checkpoint_dir_is_shared_setting_or_set_once(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
