import re

import pytest

import duck
import __spark_entry__ as entry
from conftest import SF_SMALL
from tastemap.llm import registry


def test_every_operator_is_registered_once():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in registry.QUERIES) == list(range(1, len(registry.QUERIES) + 1))
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_duckdb(spark, name):
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").toArrow() for t in ("documents", "benchmark", "conversations", "embeddings")}
    df = registry.QUERIES[name](spark, SF_SMALL)
    want = duck.rows(registry.ORACLE[name], **tables)
    assert sorted(df.columns) == sorted(want[0])
    duck.same(df.collect(), want)
