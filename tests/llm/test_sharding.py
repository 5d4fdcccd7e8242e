from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewarden.llm import sharding


def brute(key, weights):
    text = "\0null" if key is None else str(key)

    def cost(s):
        drawn = int(hashlib.md5(f"{text}/{s}".encode()).hexdigest()[:13], 16)
        return -math.log((drawn + 0.5) / 2.0**52) / weights[s], s

    return min(map(cost, range(len(weights))))[1]


@pytest.mark.parametrize("frame", ["awkward", "small"])
@pytest.mark.parametrize("per_bucket", [1, 50_000])
def test_law_sizes_and_slots(request, frame, per_bucket):
    docs = request.getfixturevalue(frame)
    got = sharding.shard_documents(docs, 24, rows_per_bucket=per_bucket).collect()
    want = Counter(
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()),
         brute(r.doc_id, [1.0] * 24), brute(r.doc_id, [1.0] * 25))
        for r in docs.select("doc_id", "text").collect()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_share_out(spark):
    keys = spark.range(20_000).select(
        sharding.rendezvous_shard(F.col("id"), [1.0, 2.0, 1.0]).alias("s")
    )
    n = {r.s: r["count"] for r in keys.groupBy("s").count().collect()}
    assert 0.47 < n[1] / 20_000 < 0.53 and 0.22 < n[0] / 20_000 < 0.28
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.lit(1), [1.0, 0.0])


def test_no_rows(no_rows):
    assert sharding.shard_documents(no_rows).count() == 0
