"""Runs last: it drops what the session has staged."""

from tablecheck.session import drop_staged, pin


def test_staged_tables_can_be_dropped(spark):
    assert pin(spark.range(3)).count() == 3
    assert drop_staged(spark)
    assert pin(spark.range(4)).count() == 4
