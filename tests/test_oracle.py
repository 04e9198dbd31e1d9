"""Every registered query against its DuckDB statement."""

import pytest

from fixtures import catalog
from tests.compare import duck, same

from .conftest import SF01


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_query(key, frames, con):
    result = catalog.QUERIES[key](frames)
    if key in catalog.ORACLES:
        equal, message = same(result, con, catalog.ORACLES[key])
        assert equal, message
    else:
        assert result.count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_released_frames_leave_nothing_behind(spark):
    import os

    own = catalog.Frames(spark, SF01)
    catalog.QUERIES["src_csv_scan"](own).count()
    catalog.QUERIES["sink_partitioned_roundtrip"](own).count()
    folders = [s.root for s in own._stagings]
    assert folders and all(os.path.isdir(f) for f in folders)
    own.release()
    assert not any(os.path.exists(f) for f in folders)
