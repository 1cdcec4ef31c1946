import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from pulse.session import cut, cut_result


def folder(df):
    return os.path.dirname(urlparse(df.inputFiles()[0]).path)


def test_intermediate_tables_go_when_the_result_is_written(spark):
    made = []

    def inner():
        made.append(cut(spark.range(10)))
        return made[-1].filter("id < 7")

    def outer():
        made.append(cut(spark.range(5)))
        made.append(cut_result(inner))
        return made[0].join(made[2], "id")

    kept = cut(spark.range(3))
    folders = []
    real = outer

    def watched():
        result = real()
        folders.extend(folder(m) for m in (made[0], made[2]))
        assert os.path.exists(folder(made[2]))
        return result

    result = cut_result(watched)
    assert sorted(r.id for r in result.collect()) == [0, 1, 2, 3, 4]
    assert not any(os.path.exists(f) for f in folders)
    assert os.path.exists(folder(result)) and kept.agg(F.count("*")).first()[0] == 3


def test_a_failure_closes_its_scope(spark):
    def broken():
        raise KeyError("x")

    with pytest.raises(KeyError):
        cut_result(broken)
    assert cut(spark.range(2)).count() == 2
