"""The quality model where documents repeat an id."""

import numpy as np

from airway.llm import quality_model
from airway.sources.staging import session_work


def test_one_row_is_learned_from_for_each_id(spark, docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model, "fit", lambda rows, labels: seen.append((rows, labels)) or 0.5)
    ids = [i for i in range(40) if not quality_model.zlib.crc32(str(i).encode()) % 3 == 1][:10]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    docs = docs_of([(i, f"text of {i}") for i in ids] + [(ids[0], f"other text {n}") for n in range(50)] + [(ids[1], None)])
    for given in (docs, docs.orderBy("text", ascending=False)):
        quality_model.train(given, labels, "doc_id", "text", "quality", 8, session_work(spark))
        rows, found = seen[-1]
        assert len(rows) == len(found) == 8
    assert all(np.array_equal(a[0], b[0]) for a, b in zip(seen[0][0], seen[1][0], strict=True))
