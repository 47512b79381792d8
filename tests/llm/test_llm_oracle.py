"""Each query of the subpackage against its SQL over the whole small tables."""

import os

import pytest

from compare import duck, norm
from tidemark.llm import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = duck(SF).execute(catalog.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want
