from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from bazaarlens.sources import sinks, snapshots
from bazaarlens.sources.marketplace import read_marketplace


def _counts(market) -> dict[str, int]:
    return {name: df.count() for name, df in market.items()}


def test_a_failure_after_any_step_leaves_one_whole_version(spark, tmp_path, market, monkeypatch):
    """Seven tables and the commit are eight writes; whichever fails, readers see the old version."""
    folder = str(tmp_path)
    sinks.refresh(market, folder)
    before = _counts(read_marketplace(spark, folder))
    new = replace(market, **{name: df.limit(1) for name, df in market.items()})
    write, left = DataFrameWriter.parquet, [0]

    def failing(self, path, *args, **options):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("no space left")
        return write(self, path, *args, **options)

    for step in range(8):
        left[0] = step
        with monkeypatch.context() as patch:
            patch.setattr(DataFrameWriter, "parquet", failing)
            with pytest.raises(OSError):
                sinks.refresh(new, folder)
        assert _counts(read_marketplace(spark, folder)) == before
    sinks.refresh(new, folder)
    assert set(_counts(read_marketplace(spark, folder)).values()) == {1}
    assert snapshots.commits(spark, folder).count() == 2


def test_readers_keep_their_version(spark, tmp_path, market):
    folder = str(tmp_path)
    first = sinks.refresh(market, folder)
    reader = read_marketplace(spark, folder)
    sinks.refresh(replace(market, orders=market.orders.limit(2)), folder)
    assert reader.orders.count() == 7 and read_marketplace(spark, folder, first).orders.count() == 7
    assert read_marketplace(spark, folder).orders.count() == 2


def test_old_versions_are_emptied(spark, tmp_path, market):
    folder = str(tmp_path)
    names = [sinks.refresh(market, folder) for _ in range(3)]
    assert snapshots.forget(spark, folder, keep=2) == names[:1]
    assert read_marketplace(spark, folder, names[0]).orders.count() == 0
    assert all(_counts(read_marketplace(spark, folder, n)) == _counts(market) for n in names[1:])
    with pytest.raises(ValueError):
        snapshots.forget(spark, folder, keep=0)


def test_two_writers_at_once(spark, tmp_path, market):
    """Both commit the same number: one of the two counts, for every reader."""
    folder = str(tmp_path)
    one, two = snapshots.Snapshot(spark, folder), snapshots.Snapshot(spark, folder)
    for snapshot, n in ((one, 1), (two, 2)):
        for name, df in market.items():
            snapshot.put(name, df.limit(n))
    last = snapshots.current
    snapshots.current = lambda *_: None
    try:
        one.commit(), two.commit()
    finally:
        snapshots.current = last
    assert snapshots.current(spark, folder)["version"] == max(one.version, two.version)
    assert len(set(_counts(read_marketplace(spark, folder)).values())) == 1


def test_a_folder_without_versions_is_read_as_it_is(spark, tmp_path, market):
    for name, df in market.items():
        df.write.parquet(f"{tmp_path}/{name}")
    assert snapshots.current(spark, str(tmp_path)) is None
    assert _counts(read_marketplace(spark, str(tmp_path))) == _counts(market)
