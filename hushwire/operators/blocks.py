"""Recordings as numbered blocks of samples, so that no task holds a long one.

Blocks are rows id, block (from 0) and channels (one array of samples for each channel); all but the last
of a recording hold `size` samples a channel.  What is carried between blocks is small: the length and peak
of a recording by aggregation, the spans of a recording, and as many samples of its neighbours as the
resampling filter is long.  All results are those of the whole recording, whatever the size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hushwire.functions.batches import parts, spread
from hushwire.operators import audio

BLOCK = "id long, block int, channels array<array<float>>"


def cut(recordings: DataFrame, size: int) -> DataFrame:
    """Blocks of recordings (id, channels) that are rows already; null and empty recordings have none."""
    length = F.size(F.get("channels", F.lit(0)))
    # null where there is nothing to cut, which has no rows: a filter would be moved below and make the channels twice
    numbers_ = F.when(length > 0, F.sequence(F.lit(0), F.floor((length - 1) / size).cast("int")))
    numbered = recordings.select("id", "channels", F.explode(numbers_).alias("block"))
    part = lambda c: F.slice(c, F.col("block") * size + 1, size)
    # two channels, as most have, need no function over arrays, which runs interpreted
    two = F.when(F.size("channels") == 2, F.array(part(F.col("channels")[0]), part(F.col("channels")[1]))).otherwise(F.transform("channels", part))
    return numbered.select(F.col("id").cast("long").alias("id"), "block", two.alias("channels"))


def totals(blocks: DataFrame) -> DataFrame:
    """id, n (samples a channel) and peak (1 where all is silent) of every recording."""
    every = F.flatten("channels")
    most = F.greatest(F.array_max(every), -F.array_min(every))
    own = blocks.select("id", F.size(F.get("channels", F.lit(0))).alias("n"), most.cast("double").alias("peak"))
    return own.groupBy("id").agg(F.sum("n").alias("n"), F.max("peak").alias("peak")).select("id", "n", F.coalesce(F.nullif("peak", F.lit(0.0)), F.lit(1.0)).alias("peak"))


def numbers(c: pa.Array) -> np.ndarray:
    """A column of numbers, null as 0."""
    return c.fill_null(0).to_numpy(zero_copy_only=False)


def placed(spans: DataFrame, lengths: DataFrame) -> DataFrame:
    """id, n, peak and spans (in order: start, end, channel) of every recording with spans.  Spans are rows id, ord,
    start, end, channel, or id and spans, an array of them in order."""
    if "spans" not in spans.columns:
        spans = spans.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ord", "start", "end", "channel"))).alias("spans"))
    return spans.join(lengths, "id").select("id", "n", "peak", "spans")


def mask(blocks: DataFrame, spans: DataFrame, size: int, rate: int = 48000, mode: str = "silence", both: bool = False, hertz: float = 1000.0, gain: float | None = None, fade_ms: float = 8.0, seed: int = 42) -> DataFrame:
    """`audio.mask` by blocks: blocks with the spans (of `placed`, in seconds) replaced.  The peak comes with the spans,
    which are few: each block is given all spans of its recording and keeps those that reach into it.  They meet by the
    id alone, so tables that are dealt out by it already stay where they are, and blocks go past one by one."""
    if mode not in audio.MODES:
        raise ValueError(f"unknown masking mode: {mode}")
    level, fade_samples = audio.GAIN[mode] if gain is None else gain, max(1, int(rate * fade_ms / 1000))

    def replaced(values: np.ndarray, start: np.ndarray, first: np.ndarray, channels: np.ndarray, begin: np.ndarray, lengths: np.ndarray, n: np.ndarray, peak: np.ndarray, spans: pa.Array) -> None:
        """Replace the spans of many blocks at once: the channels of block r, from first[r] on, begin at `start` in values
        and hold lengths[r] samples each, from sample begin[r] of the n[r] of its recording."""
        row, own = np.repeat(np.arange(len(n)), numbers(pc.list_value_length(spans))), spans.flatten()
        sample = lambda c, empty: np.clip(np.rint(own.field(c).cast(pa.float64()).fill_null(empty).to_numpy(zero_copy_only=False) * rate), 0, n[row]).astype(np.int64)
        a, b, channel = sample("start", 0.0), sample("end", np.inf), numbers(own.field("channel").fill_null(-1))
        lo, hi = np.maximum(a, begin[row]), np.minimum(b, (begin + lengths)[row])
        reach = np.flatnonzero(lo < hi)
        counts = np.bincount(row[reach], minlength=len(n))
        before = np.cumsum(counts) - counts
        # one span of each block at a time, so that a later one wins
        for turn in range(int(counts.max(initial=0))):
            r = np.flatnonzero(counts > turn)
            s = reach[before[r] + turn]
            new, long = audio.replacements(mode, a[s], b[s], lo[s], hi[s], rate, peak[r], hertz, level, fade_samples, seed), hi[s] - lo[s]
            every = both | (channel[s] < 0) | (channel[s] >= channels[r])
            for c in range(int(channels[r].max())):
                hit = (c < channels[r]) & (every | (channel[s] == c))
                at = start[first[r[hit]] + c] + (lo[s] - begin[r])[hit]
                values[spread(at, long[hit])] = new[np.repeat(hit, long)]

    arrow = to_arrow_schema(StructType.fromDDL(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in parts(whole)):
            held = b.column(2).flatten()
            channels = numbers(pc.list_value_length(b.column(2)))
            if (channels == 1).any():  # one channel is made two
                held = held.take(pa.array(np.repeat(np.arange(len(held)), np.repeat(np.where(channels == 1, 2, 1), channels))))
                channels = np.where(channels == 1, 2, channels)
            lengths = numbers(pc.list_value_length(held))
            values = np.array(held.flatten().to_numpy(zero_copy_only=False), np.float32)
            start, first = np.cumsum(lengths) - lengths, np.cumsum(channels) - channels
            own = np.append(lengths, 0)[first]  # samples a channel of each block
            replaced(values, start, first, channels, numbers(b.column(1)).astype(np.int64) * size, own, numbers(b.column(3)), numbers(b.column(4)), b.column(5))
            edges = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            out = pa.ListArray.from_arrays(edges(channels), pa.ListArray.from_arrays(edges(lengths), pa.array(values)))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([b.column(0), b.column(1), out], arrow, strict=True)], schema=arrow)

    met = blocks.join(placed(spans, totals(blocks)), "id", "left")
    return met.select("id", "block", "channels", "n", "peak", "spans").mapInArrow(run, BLOCK)


def resample(blocks: DataFrame, size: int, source: int, target: int) -> DataFrame:
    """`audio.resampled` by blocks: each gives the samples that begin within it, from its own and its neighbours'
    edges.  A block must be as long as the filter reaches."""
    up, down = audio.ratio(source, target)
    if up == down:
        return blocks
    taps = audio.low_pass(up, down)
    halo = len(taps) // (2 * up) + 2
    if size < halo:
        raise ValueError(f"blocks of {size} samples are shorter than the filter, which reaches {halo}")

    edge = lambda f: F.transform("channels", f)
    part = lambda step, order, c: F.struct((F.col("block") + step).cast("int").alias("block"), F.lit(order).alias("part"), c.alias("channels"))
    tail: Column = edge(lambda c: F.slice(c, F.greatest(F.lit(1), F.size(c) - halo + 1), halo))
    sent = blocks.select("id", F.explode(F.array(part(1, 0, tail), part(0, 1, F.col("channels")), part(-1, 2, edge(lambda c: F.slice(c, 1, halo))))).alias("p"))
    met = sent.groupBy("id", "p.block").agg(F.array_sort(F.collect_list(F.struct("p.part", "p.channels"))).alias("parts")).where(F.exists("parts", lambda p: p["part"] == 1))

    def one(block: int, parts) -> list[np.ndarray]:
        found = {p["part"]: [np.asarray(c, np.float32) for c in p["channels"]] for p in parts}
        start = block * size
        lo, hi = audio.outputs_before(start, up, down), audio.outputs_before(start + len(found[1][0]), up, down)
        out = []
        for k in range(len(found[1])):
            x = np.concatenate([found[p][k] for p in (0, 1, 2) if p in found])
            out.append(audio.resampled_part(x, start - (len(found[0][k]) if 0 in found else 0), lo, hi, up, down, taps))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "block": b["block"], "channels": [one(*r) for r in b[["block", "parts"]].itertuples(index=False)]})

    return met.select("id", "block", "parts").mapInPandas(run, BLOCK)
