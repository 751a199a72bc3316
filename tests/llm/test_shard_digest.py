"""The digest of the shards is that of the operator's own output."""

from pyspark.sql import functions as F

from ranklight.llm import sharding


def test_the_digest_is_read_off_the_placed_documents(documents):
    placed = sharding.shard_documents(documents, 5, bucket_rows=10)
    found = sharding.shard_digest(documents, 5, bucket_rows=10)
    names = ["doc_id", "size", "text_crc32", "shard", "slot"]
    text = F.coalesce("text", F.lit(""))
    want = placed.select("doc_id", F.octet_length(text) + 1, F.crc32(text), "shard", "slot")
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(map(tuple, want.collect()))


def test_the_bytes_of_the_texts_bound_the_buckets(documents):
    orders = [
        sorted(map(tuple, sharding.shard_digest(documents, 5, bucket_bytes=b).select("doc_id", "shard", "slot").collect()))
        for b in (2000, 1 << 24)
    ]
    assert orders[0] != orders[1]
