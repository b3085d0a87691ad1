"""Where scratch data goes."""

from tablesync.session import quote_ident, shared_root, sql_string


def test_shared_root_is_the_checkpoint_dir(spark):
    root = shared_root(spark)
    assert root == shared_root(spark)  # stable within a session
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == configured.rstrip("/")


def test_quoting():
    assert quote_ident("db.t`x") == "`db`.`t``x`"
    assert sql_string(r"o'b\\") == r"'o\'b\\\\'"
