"""Padding of frames and the codegen limit of the capture writer's job."""

from __future__ import annotations

from wirelake.session import small_methods
from wirelake.sources.capture_writer import pad_to_size


def test_padding_without_hex_text(spark):
    rows = [(bytearray(b"ab"), 4), (bytearray(b"abc"), 2), (bytearray(b""), 3), (None, 3), (bytearray(b"abc"), None)]
    padded = pad_to_size(spark.createDataFrame(rows, "data binary, packet_size int").coalesce(1))
    assert [None if r.data is None else bytes(r.data) for r in padded.collect()] == [b"ab\0\0", b"abc", b"\0\0\0", None, b"abc"]
    assert "unhex" not in padded._jdf.queryExecution().analyzed().toString()


def test_limit_is_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    try:
        with small_methods(spark):
            assert spark.conf.get(name) == "8000"
        assert spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, before)
