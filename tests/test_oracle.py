"""Every registered query of the core against its SQL twin in DuckDB, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from quillstone.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(row):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in row)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_twin(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    result = duck.execute(registry.oracle_sql()[name])
    assert sorted(d[0] for d in result.description) == names
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert Counter(plain(r) for r in df.select(names).collect()) == Counter(plain(r) for r in want)
