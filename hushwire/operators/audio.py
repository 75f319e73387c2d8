"""Sample arithmetic on PCM arrays; whole recordings go through Arrow with NumPy."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushwire.functions.batches import lists, parts, spread


def sample_index(seconds: Column, rate: Column | int) -> Column:
    """Halves to even."""
    return F.bround(seconds * rate, 0).cast("long")


def clip(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def pcm16(x: Column) -> Column:
    """Clipped, scaled, cut toward zero."""
    return (clip(x) * 32767).cast("short")


def peak(samples: Column) -> Column:
    most = F.array_max(F.transform(samples, lambda v: F.abs(v)))
    return F.when(F.coalesce(most, F.lit(0.0)) == 0, 1.0).otherwise(most)


def silence(samples: Column, start: Column, stop: Column) -> Column:
    return F.transform(samples, lambda v, i: F.when((i >= start) & (i < stop), 0.0).otherwise(v))


def fade(n: Column, fade_samples: Column) -> Column:
    """Envelope of n samples that rises and falls linearly; flat for very short ones."""
    f = F.least(fade_samples, F.greatest(F.lit(1), F.floor(n / 2))).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when((f <= 1) | (n <= 2), 1.0).when(i < f, i / (f - 1)).when(i >= n - f, (n - 1 - i) / (f - 1)).otherwise(1.0),
    )


def beep(samples: Column, start: Column, stop: Column, rate: int, hertz: float = 1000.0, gain: float = 0.35, fade_ms: float = 8.0) -> Column:
    """A sine of gain times the peak within the span, faded in and out."""
    top = peak(samples) * gain
    n = F.least(stop, F.size(samples)) - start
    rise = fade(F.greatest(n, F.lit(1)), F.lit(max(1, int(rate * fade_ms / 1000))))
    wave = lambda i: top * F.sin(2 * math.pi * hertz * (i - start) / rate) * F.get(rise, i - start)
    return F.transform(samples, lambda v, i: F.when((i >= start) & (i < stop), wave(i)).otherwise(v))


def mono_mix(frames: Column) -> Column:
    return F.transform(frames, lambda f: F.aggregate(f, F.lit(0.0), lambda a, v: a + v) / F.size(f))


def one_channel(frames: Column, channel: Column) -> Column:
    return F.transform(frames, lambda f: F.get(f, channel))


def target_channels(channel: Column, n: int) -> Column:
    """The channels that a span masks: all for -1, null and channels that are not there."""
    every = F.array(*[F.lit(i) for i in range(n)])
    return F.when(channel.isNull() | (channel < 0) | (channel >= n), every).otherwise(F.array(channel))


def output_bitrate(source: Column, configured: Column, floor: int = 8) -> Column:
    """Kilobits: the input's own (halves to even) or the configured, at least max(8, floor)."""
    return F.greatest(F.lit(max(8, floor)), F.coalesce(F.bround(F.nullif(source, F.lit(0)) / 1000, 0).cast("int"), configured))


def low_pass(up: int, down: int, half: int = 10) -> np.ndarray:
    """A sinc cut at the lower of the two rates under a Kaiser window (beta 5), of gain `up`."""
    widest = max(up, down)
    at = np.arange(-half * widest, half * widest + 1)
    taps = np.sinc(at / widest) * np.kaiser(len(at), 5.0)
    return taps * (up / taps.sum())


def ratio(source: int, target: int) -> tuple[int, int]:
    g = math.gcd(source, target)
    return target // g, source // g


def outputs_before(n: int, up: int, down: int) -> int:
    """How many resampled samples begin before sample n of the source."""
    return -(-n * up // down)


def resampled_part(x: np.ndarray, first: int, lo: int, hi: int, up: int, down: int, taps: np.ndarray) -> np.ndarray:
    """Outputs lo..hi of a whole recording of which x is the part from sample `first`; beyond x all is taken
    as zero.  Each output phase is one short filter over the input, so zeros between samples are never made."""
    middle, out = len(taps) // 2, np.zeros(max(0, hi - lo))
    for k0 in range(lo, min(lo + up, hi)):
        place = np.arange(k0, hi, up) * down + middle  # in the upsampled signal, delayed by the filter
        full = np.convolve(x.astype(np.float64), taps[place[0] % up :: up])
        k = place // up - first
        out[k0 - lo :: up] = np.where((k >= 0) & (k < len(full)), full[np.clip(k, 0, len(full) - 1)], 0.0)
    return out.astype(np.float32)


def resampled(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """x at another rate: ceil(n * target / source) samples."""
    up, down = ratio(source, target)
    if up == down or not len(x):
        return x.astype(np.float32)
    return resampled_part(x, 0, 0, outputs_before(len(x), up, down), up, down, low_pass(up, down))


#: Outputs that are filtered at once.
OUTPUTS = 1 << 15


def resampled_rows(x: np.ndarray, lengths: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """`resampled` of many recordings that lie side by side in x, and their new lengths.  Between two of them
    stand as many zeros as the filter reaches, so all are filtered together; the filter is made once."""
    up, down = ratio(source, target)
    if up == down:
        return x.astype(np.float32), lengths
    taps = low_pass(up, down)
    middle, reach = len(taps) // 2, -(-len(taps) // up)
    phases = np.zeros((up, reach))
    for f in range(up):
        own = taps[f::up]
        phases[f, : len(own)] = own
    phases = phases[:, ::-1]
    gap = reach + 2
    first = np.cumsum(lengths + gap) - lengths
    wide = np.zeros(int(lengths.sum()) + gap * (len(lengths) + 1))
    wide[spread(first, lengths)] = x.astype(np.float32)
    windows = np.lib.stride_tricks.sliding_window_view(wide, reach)
    new = -(-lengths * up // down)
    place = spread(np.zeros(len(new), np.int64), new) * down + middle  # in the upsampled signal, delayed by the filter
    at, phase = np.repeat(first, new) + place // up - reach + 1, place % up
    out = np.empty(len(place), np.float32)
    for a in range(0, len(place), OUTPUTS):
        near, part = windows[at[a : a + OUTPUTS]], phase[a : a + OUTPUTS]
        out[a : a + OUTPUTS] = near @ phases[0] if up == 1 else np.einsum("ij,ij->i", near, phases[part])
    return out, new


def resample(recordings: DataFrame, source: int, target: int) -> DataFrame:
    """recordings (id, samples) at another rate; a null recording stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in parts(whole):
                samples = b.column(1)
                lengths = pc.list_value_length(samples).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                out, new = resampled_rows(samples.flatten().to_numpy(zero_copy_only=False), lengths, source, target)
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), lists(out, new, samples.is_null().to_numpy(zero_copy_only=False))], names=["id", "samples"])

    return recordings.select("id", "samples").mapInArrow(run, "id long, samples array<float>")


def envelope(n: int, fade_samples: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Places lo..hi of the envelope of `fade` over n samples."""
    f = min(fade_samples, max(1, n // 2))
    i = np.arange(lo, n if hi is None else hi)
    if f <= 1 or n <= 2:
        return np.ones(len(i))
    return np.minimum(1.0, np.minimum(i, n - 1 - i) / (f - 1))


def noise_at(lo: int, hi: int, seed: int) -> np.ndarray:
    """Normal noise of samples lo..hi of a recording: a function of place and seed, so any part of it can be
    made alone."""
    draw = np.random.Philox(key=seed)
    draw.advance(lo // 2)  # a step of the generator gives the four numbers of two samples
    u = draw.random_raw(4 * ((hi + 1) // 2 - lo // 2)).reshape(-1, 2)[lo % 2 :][: hi - lo]
    u = ((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    return np.sqrt(-2 * np.log(u[:, 0])) * np.cos(2 * np.pi * u[:, 1])


def noise(recordings: DataFrame, rate: int, gain: float = 0.03, fade_ms: float = 8.0, seed: int = 42) -> DataFrame:
    """recordings (id, samples, spans: array of start, end in seconds) with each span replaced by faded
    noise of gain times the peak.  Noise is a function of seed and place, so a task that runs again gives the
    same samples."""

    def masked(samples, spans) -> np.ndarray:
        x = np.array(samples, np.float32)
        top = float(np.abs(x).max(initial=0.0)) or 1.0
        for s in () if spans is None else spans:
            a, b = max(0, round(s["start"] * rate)), min(len(x), round(s["end"] * rate))
            if b > a:
                x[a:b] = replacement("noise", a, b, a, b, rate, top, 0.0, gain, max(1, int(rate * fade_ms / 1000)), seed)
        return x

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "samples": [None if s is None else masked(s, p) for s, p in zip(b["samples"], b["spans"], strict=True)]})

    return recordings.select("id", "samples", "spans").mapInPandas(run, "id long, samples array<float>")


MODES = ("silence", "beep", "noise")
#: Loudness of a replacement, as a share of the peak.
GAIN = {"silence": 0.0, "beep": 0.35, "noise": 0.03}


def replacement(mode: str, a: int, b: int, lo: int, hi: int, rate: int, top: float, hertz: float, gain: float, fade_samples: int, seed: int) -> np.ndarray:
    """Samples lo..hi of what replaces the span a..b of a recording."""
    if mode == "silence":
        return np.zeros(hi - lo, np.float32)
    if mode == "noise":
        wave = gain * top * noise_at(lo, hi, seed)
    else:
        wave = gain * top * np.sin(2 * np.pi * hertz * np.arange(lo - a, hi - a).astype(np.float32) / np.float32(rate))
    return wave.astype(np.float32) * envelope(b - a, fade_samples, lo - a, hi - a).astype(np.float32)


def replacements(mode: str, a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray, rate: int, top: np.ndarray, hertz: float, gain: float, fade_samples: int, seed: int) -> np.ndarray:
    """`replacement` of many spans, their samples side by side."""
    lengths = hi - lo
    if mode == "silence":
        return np.zeros(int(lengths.sum()), np.float32)
    n, i = np.repeat(b - a, lengths), spread(lo - a, lengths)
    f = np.minimum(fade_samples, np.maximum(1, n // 2))
    rise = np.where((f <= 1) | (n <= 2), 1.0, np.minimum(1.0, np.minimum(i, n - 1 - i) / np.maximum(1, f - 1)))
    if mode == "noise":
        drawn = [noise_at(x, y, seed) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
        wave = np.repeat(gain * top, lengths) * np.concatenate([*drawn, np.zeros(0)])
    else:
        wave = np.repeat((gain * top).astype(np.float32), lengths) * np.sin(2 * math.pi * hertz * i.astype(np.float32) / np.float32(rate))
    return wave.astype(np.float32) * rise.astype(np.float32)


def masked(channels: list[np.ndarray], spans, rate: int, mode: str, both: bool, hertz: float, gain: float, fade_ms: float, seed: int) -> list[np.ndarray]:
    """Channels with every span replaced, in order, so that a later span wins.  One channel is made two.  A
    span is for its channel; for all where that is null, -1 or not there, or with `both`.  The peak is that
    of the whole recording as it came."""
    x = [np.array(c, np.float32) for c in channels]
    x = x * 2 if len(x) == 1 else x
    x = [c.copy() for c in x]
    top = max((float(np.abs(c).max(initial=0.0)) for c in x), default=0.0) or 1.0
    fade_samples = max(1, int(rate * fade_ms / 1000))
    for s in () if spans is None else spans:
        a, b = max(0, round(s["start"] * rate)), min(len(x[0]) if x else 0, round(s["end"] * rate))
        if b > a:
            new = replacement(mode, a, b, a, b, rate, top, hertz, gain, fade_samples, seed)
            k = s["channel"]
            for c in x if both or k is None or not 0 <= k < len(x) else [x[int(k)]]:
                c[a:b] = new
    return x


def mask(recordings: DataFrame, rate: int = 48000, mode: str = "silence", both: bool = False, hertz: float = 1000.0, gain: float | None = None, fade_ms: float = 8.0, seed: int = 42) -> DataFrame:
    """recordings (id, channels: array of sample arrays, spans: array of start, end in seconds and channel)
    with their spans silenced, beeped over or replaced by noise.  Null recordings stay null, empty ones
    empty; a recording is held whole by one task, and tasks share nothing."""
    if mode not in MODES:
        raise ValueError(f"unknown masking mode: {mode}")
    level = GAIN[mode] if gain is None else gain

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [None if c is None else masked(list(c), s, rate, mode, both, hertz, level, fade_ms, seed) for c, s in zip(b["channels"], b["spans"], strict=True)]
            yield pd.DataFrame({"id": b["id"], "channels": out})

    return recordings.select("id", "channels", "spans").mapInPandas(run, "id long, channels array<array<float>>")
