"""Protobuf payloads to JSON text, and descriptors that change while running."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@lru_cache(maxsize=8)
def _message_class(descriptor_bytes: bytes, message_name: str):
    """Message class from a serialized FileDescriptorSet."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    try:
        files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_bytes)
    except Exception as error:
        raise ValueError("not a descriptor set") from error
    pool = descriptor_pool.DescriptorPool()
    for file in files.file:
        pool.Add(file)
    try:
        descriptor = pool.FindMessageTypeByName(message_name)
    except KeyError:
        raise ValueError(f"no message type {message_name!r} in the descriptor set") from None
    return message_factory.GetMessageClass(descriptor)


def check_descriptor(descriptor_bytes: bytes, message_name: str) -> None:
    """Raise ValueError unless the descriptor set holds the message type."""
    if not descriptor_bytes:
        raise ValueError("a descriptor set is required")
    if not message_name:
        raise ValueError("a message name is required")
    _message_class(bytes(descriptor_bytes), message_name)


def decode_protobuf(df: DataFrame, descriptor_bytes: bytes | None = None,
                    message_name: str | None = None, mode: str = "json",
                    output: str = "decoded") -> DataFrame:
    """Add the payload as JSON text, NULL where it cannot be parsed.

    `mode="raw"` passes the bytes through. The descriptor set is small and
    travels with the task; parsing is row-local, so there is no shuffle.
    """
    if mode == "raw":
        return df.withColumn(output, F.col("value"))
    if mode != "json":
        raise ValueError(f"mode is raw or json, not {mode!r}")
    check_descriptor(descriptor_bytes, message_name)
    descriptor_bytes = bytes(descriptor_bytes)

    @F.pandas_udf("string")
    def to_json_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from google.protobuf import json_format
        from google.protobuf.message import DecodeError

        message_class = _message_class(descriptor_bytes, message_name)

        def render(raw):
            if raw is None:
                return None
            try:
                parsed = message_class.FromString(bytes(raw))
            except DecodeError:
                return None
            return json_format.MessageToJson(parsed, indent=None)

        for batch in batches:
            yield batch.map(render)

    return df.withColumn(output, to_json_text(F.col("value")))


class DescriptorRefresh:
    """Keeps the newest good descriptor set, asked for at micro-batch starts.

    `provider` returns descriptor bytes. The first call must succeed; later
    failures keep the previous version. Strategy `none` never asks again,
    `periodic` asks when `interval_s` has passed, `every_batch` asks each time.
    """

    def __init__(self, provider: Callable[[], bytes], message_name: str,
                 strategy: str = "periodic", interval_s: float = 300.0,
                 clock: Callable[[], float] = time.monotonic):
        if strategy not in ("none", "periodic", "every_batch"):
            raise ValueError(f"unknown refresh strategy {strategy!r}")
        self.provider, self.message_name = provider, message_name
        self.strategy, self.interval_s, self.clock = strategy, interval_s, clock
        self.current = self._fetch()
        self.fetched_at = clock()

    def _fetch(self) -> bytes:
        descriptor_bytes = bytes(self.provider())
        check_descriptor(descriptor_bytes, self.message_name)
        return descriptor_bytes

    def refresh(self) -> bytes:
        due = self.strategy == "every_batch" or (
            self.strategy == "periodic" and self.clock() - self.fetched_at >= self.interval_s)
        if due:
            try:
                self.current = self._fetch()
            except Exception as error:  # any provider failure keeps the old version
                log.warning("descriptor refresh failed, keeping the old version: %s", error)
            self.fetched_at = self.clock()
        return self.current

    def decode(self, df: DataFrame, output: str = "decoded") -> DataFrame:
        return decode_protobuf(df, self.refresh(), self.message_name, output=output)
