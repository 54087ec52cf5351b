"""Structured Streaming: frame streams with state per capture, and event-time operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dedupe(frames: DataFrame, distance: int = 4, lookback: int = 30) -> DataFrame:
    """capture, frame_idx, phash, decision of a stream: 'duplicate' within ``distance`` bits of any of the last ``lookback`` kept hashes of the capture.

    State is those hashes. Rows of a micro-batch are taken by frame_idx; a row that
    comes in a later batch is later, whatever its index. Rows without a hash are kept.
    """

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(pdfs)).sort_values("frame_idx", kind="stable")
        out = []
        for h, null in zip(rows["phash"].fillna(0).astype("int64"), rows["phash"].isna()):
            if not null and any(((int(h) ^ s) & (2**64 - 1)).bit_count() <= distance for s in seen):
                out.append("duplicate")
                continue
            out.append("kept")
            if not null:
                seen = [*seen, int(h)][-lookback:]
        state.update((seen,))
        yield rows[["capture", "frame_idx", "phash"]].assign(decision=out)

    return frames.select("capture", "frame_idx", "phash").groupBy("capture").applyInPandasWithState(
        step, "capture string, frame_idx bigint, phash bigint, decision string", "seen array<bigint>", "append", GroupStateTimeout.NoTimeout
    )


def head_contact(frames: DataFrame, thresh: float, n: int = 10) -> DataFrame:
    """capture, frame_idx, area, intensity of a stream of grey frames against the median of the first n frames of the capture, which give no row.

    State is the frames of the head until it is full, then their median only.
    """
    import numpy as np

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        head, base = ([list(x) for x in state.get[0]], list(state.get[1])) if state.exists else ([], [])
        rows = pd.concat(list(pdfs)).sort_values("frame_idx", kind="stable")
        out = []
        for i, frame in zip(rows["frame_idx"], rows["frame"]):
            if not base:
                head.append([float(v) for v in frame])
                if len(head) == n:
                    base, head = [float(v) for v in np.median(np.array(head), axis=0)], []
                continue
            d = np.abs(np.asarray(frame, float) - base)
            hit = d > thresh
            out.append((key[0], int(i), int(hit.sum()), float(d[hit].mean()) if hit.any() else 0.0))
        state.update((head, base))
        yield pd.DataFrame(out, columns=["capture", "frame_idx", "area", "intensity"])

    return frames.select("capture", "frame_idx", "frame").groupBy("capture").applyInPandasWithState(
        step, "capture string, frame_idx bigint, area int, intensity double", "head array<array<double>>, base array<double>", "append", GroupStateTimeout.NoTimeout
    )


def windowed(events: DataFrame, at: str, by: list[str], value: Column, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """by..., start, end, n, total per tumbling (or sliding) window; rows later than ``late`` are dropped by the watermark."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    g = events.withWatermark(at, late).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def sessions(events: DataFrame, at: str, by: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """by..., start, end, n per session: rows at most ``gap`` apart."""
    g = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once(events: DataFrame, at: str, key: list[str], late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; the result is a parquet table at path, written exactly once per batch."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
