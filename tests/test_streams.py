"""Last wins on streams: the batch's result in any order of arrival, and state that is dropped."""

import datetime as dt
import json
import os
import random

import pytest

from spanguard.operators.tables import keep_last
from spanguard.streaming import streams

SCHEMA = "unique_id long, line long, ts timestamp, verdict string, tags array<string>"


@pytest.fixture
def stateful(spark):
    before = {k: spark.conf.get(k, None) for k in streams.STATE_STORE}
    for k, v in streams.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_last_of_each_equals_the_batch(spark, tmp_path, stateful, seed):
    r, began = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = [(r.randint(0, 40), i, began + dt.timedelta(seconds=r.randint(0, 3000)), r.choice(["secure", "vulnerable", None]), ["a"] * r.randint(0, 2)) for i in range(400)]
    rows += [(41, 0, None, "x", None), (None, 1, began, "x", None)]
    r.shuffle(rows)
    files = [rows[i::5] for i in range(5)]
    # behind all of them, so that the watermark passes their times
    end = began + dt.timedelta(days=1)
    for k, part in enumerate([*files, [(1000, 0, end, "end", None)], [(1001, 0, end, "end", None)]]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{k}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/[0-9]")
    out = streams.last_of_each(stream, "unique_id", "ts", ["ts", "line"])
    q = out.writeStream.format("memory").queryName(f"last{seed}").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    batch = spark.createDataFrame([(i, (t, n), n, t, v, g) for i, n, t, v, g in rows if i is not None and t is not None], "unique_id long, place struct<ts:timestamp,line:long>, line long, ts timestamp, verdict string, tags array<string>")
    want = {tuple(map(str, (x.unique_id, x.line, x.ts, x.verdict, x.tags))) for x in keep_last(batch, "unique_id", "place").collect()}
    got = [tuple(map(str, (x.unique_id, x.line, x.ts, x.verdict, x.tags))) for x in spark.table(f"last{seed}").collect()]
    assert len(got) == len(want) and set(got) == want
    left = json.loads(json.dumps([p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), q.recentProgress) if p["stateOperators"]]))
    assert max(left) > 20 and left[-1] <= 8  # the two behind, with their timers
    assert os.path.exists(f"{tmp_path}/c")
