from __future__ import annotations

import pyarrow as pa

from linkharbor.llm import common


def test_batches_end_at_a_number_of_bytes(spark, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1 << 20)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    rows = spark.range(0, 300, 1, 1).selectExpr("id", "repeat('x', 200000) as text")
    found = common.small_batches(rows).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 300
    assert max(r["size"] for r in found) < (1 << 20) + 2 * 200_000
    monkeypatch.undo()
    common.small_batches(rows)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(common.BATCH_BYTES)
