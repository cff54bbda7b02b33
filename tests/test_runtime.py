"""Written tables and who drops them."""

import os

import pytest

from cohortweave.runtime import Scope, settle


def folder(table):
    return table._settled.removeprefix("file:")


def test_a_scope_drops_its_own_tables_only(spark):
    given = settle(spark.range(5))
    with Scope() as scope:
        assert settle(given) is given
        first, second = settle(spark.range(7)), settle(spark.range(9))
        scope.drop(first, given)
        assert not os.path.exists(folder(first)) and os.path.isdir(folder(given)) and second.count() == 9
    assert second.count() == 9
    scope.drop()
    assert not os.path.exists(folder(second)) and given.count() == 5


def test_a_failure_drops_everything(spark):
    with pytest.raises(KeyError), Scope():
        table = settle(spark.range(3))
        raise KeyError
    assert not os.path.exists(folder(table))


def test_what_an_inner_scope_leaves_goes_to_the_outer_one(spark):
    with Scope() as outer:
        with Scope() as inner:
            a, b, c = (settle(spark.range(n)) for n in (2, 3, 4))
            inner.drop(a)
        assert [t.count() for t in outer.tables] == [3, 4]
        outer.drop_but(c)
    assert not os.path.exists(folder(b)) and c.count() == 4
    outer.drop()
    outer.drop()
    assert not os.path.exists(folder(c))


def test_shuffles_end_with_the_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    counts = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    table = settle(counts.join(counts.withColumnRenamed("count", "n"), "k"))
    assert table.count() == 10 and settle(counts).count() == 10  # the unwritten plan can be run again
    assert spark.conf.get(key, None) == before
