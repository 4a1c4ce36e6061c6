from __future__ import annotations

import pyarrow as pa
import pytest
from ticketmill.llm import common


def test_tidy_passes_batches_on_and_gives_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batches = [pa.record_batch({"x": [i]}) for i in range(3)]
    assert list(common.tidy(lambda rows: rows)(iter(batches))) == batches
    assert given == [1]

    def broken(rows):
        yield next(rows)
        raise ValueError

    with pytest.raises(ValueError):
        list(common.tidy(broken)(iter(batches)))
    assert given == [1, 1]


def test_give_back_runs():
    common.give_back()


def test_tidy_in_workers(spark):
    def twice(rows):
        for batch in rows:
            yield pa.RecordBatch.from_arrays([pa.array([2 * x for x in batch.column(0).to_pylist()], pa.int64())], names=["id"])

    assert spark.range(5).mapInArrow(common.tidy(twice), "id bigint").agg({"id": "sum"}).first()[0] == 20
