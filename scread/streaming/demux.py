"""Demultiplexing of read streams. It is stateless per pair: append mode, no watermark, no state store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sci import sci_demux


def stream_demux(reads: DataFrame, barcodes: DataFrame, samples: DataFrame) -> DataFrame:
    """The same columns as ``sci_demux`` for a streaming frame of reads; the sheets are static and broadcast."""
    return sci_demux(reads, barcodes, samples)
