"""Media at the edges: external commands, probes, PCM and WAV readers, and files put in place at once.
Tools run where the tasks run; a failed file is a row with an error and never an exception."""

from __future__ import annotations

import io
import json
import os
import shutil
import subprocess
import tempfile
import time
import uuid
import wave
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, groupby
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a failed command's error output that are kept.
TAIL = 4000


def run_command(command: list[str], data: bytes | None = None, timeout: float | None = None) -> bytes:
    """Standard output of a command; a RuntimeError with the end of its error output where it fails."""
    done = subprocess.run(command, input=data, capture_output=True, timeout=timeout)
    if done.returncode:
        raise RuntimeError(f"{command[0]} ended with {done.returncode}: {done.stderr.decode('utf-8', 'replace')[-TAIL:]}")
    return done.stdout


def probe_command(path: str, tool: str = "ffprobe") -> str:
    return run_command([tool, "-v", "error", "-print_format", "json", "-show_format", "-show_streams", path], timeout=120).decode()


def probe(files: DataFrame, port: Callable[[str], str] = probe_command) -> DataFrame:
    """path, status (ok or probe_failed), probe (JSON) and error of every file."""

    def one(path: str) -> tuple:
        try:
            found = port(path)
            json.loads(found)
            return path, "ok", found, None
        except Exception as e:  # any failure of a file is that file's row
            return path, "probe_failed", None, repr(e)[:TAIL]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([one(p) for p in b["path"]], columns=["path", "status", "probe", "error"])

    return files.select("path").mapInPandas(run, "path string, status string, probe string, error string")


def probe_outputs(files: DataFrame, port: Callable[[str], str] = probe_command) -> DataFrame:
    """file_id, out_bytes (null: there is none), side_there, out_probe (JSON; null: it cannot be probed) of the
    outputs and sidecars of files (file_id, out_path, sidecar_path)."""

    def one(file_id: int, out: str | None, side: str | None) -> tuple:
        size = os.path.getsize(out) if out and os.path.isfile(out) else None
        found = None
        if size is not None:
            try:
                found = port(out)
                json.loads(found)
            except Exception:  # what cannot be probed is no valid output
                found = None
        return file_id, size, bool(side) and os.path.isfile(side), found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([one(*r) for r in b.itertuples(index=False)], columns=["file_id", "out_bytes", "side_there", "out_probe"])
            yield out.astype({"out_bytes": "Int64"})

    return files.select("file_id", "out_path", "sidecar_path").mapInPandas(run, "file_id long, out_bytes long, side_there boolean, out_probe string")


def split_frames(raw: bytes, channels: int) -> list[np.ndarray]:
    """Channels of interleaved 32-bit little-endian samples; an incomplete last frame is dropped."""
    whole = len(raw) // (4 * channels) * 4 * channels
    return list(np.frombuffer(raw[:whole], "<f4").reshape(-1, channels).T)


def pcm_channels(rows: DataFrame, channels: int = 2) -> DataFrame:
    """rows (id, raw: interleaved 32-bit samples) as one array a channel; null stays null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "channels": [None if r is None else split_frames(bytes(r), channels) for r in b["raw"]]})

    return rows.select("id", "raw").mapInPandas(run, "id long, channels array<array<float>>")


def decode_command(path: str, rate: int = 48000, channels: int = 2, tool: str = "ffmpeg", threads: int = 1) -> bytes:
    return run_command([tool, "-v", "error", "-threads", str(threads), "-i", path, "-f", "f32le", "-ac", str(channels), "-ar", str(rate), "-"])


@contextmanager
def started(command: list[str], **pipes: int) -> Iterator[subprocess.Popen]:
    """A running command; a RuntimeError as of run_command where it fails, and it is ended where its user fails."""
    with tempfile.TemporaryFile() as said:
        p = subprocess.Popen(command, stderr=said, **pipes)
        try:
            yield p
            for pipe in (p.stdin, p.stdout):
                if pipe:
                    pipe.close()
            ended = p.wait()
        except BrokenPipeError:  # it ended before it took everything; why, it says itself
            ended = p.wait() or 1
        finally:
            if p.poll() is None:
                p.kill()
                p.wait()
        if ended:
            said.seek(0)
            raise RuntimeError(f"{command[0]} ended with {ended}: {said.read().decode('utf-8', 'replace')[-TAIL:]}")


def decode_stream(path: str, size: int, rate: int = 48000, channels: int = 2, tool: str = "ffmpeg") -> Iterator[list[np.ndarray]]:
    """A recording's channels by `size` samples at once; one block is held at a time."""
    command = [tool, "-v", "error", "-threads", "1", "-i", path, "-f", "f32le", "-ac", str(channels), "-ar", str(rate), "-"]
    with started(command, stdout=subprocess.PIPE) as p:
        while raw := p.stdout.read(size * 4 * channels):
            if len(raw) >= 4 * channels:
                yield split_frames(raw, channels)


def encode_stream(parts: Iterator[list[np.ndarray]], path: str, rate: int = 48000, kbps: int = 64, tool: str = "ffmpeg") -> None:
    """Clipped samples of two channels, part after part, as Opus at path."""
    command = [tool, "-v", "error", "-y", "-f", "f32le", "-ar", str(rate), "-ac", "2", "-i", "-", "-c:a", "libopus", "-b:a", f"{kbps}k", "-f", "opus", path]
    with started(command, stdin=subprocess.PIPE, stdout=subprocess.DEVNULL) as p:
        for x in parts:
            p.stdin.write(np.clip(np.stack(x * 2 if len(x) == 1 else x, 1), -1, 1).astype("<f4").tobytes())


BLOCKS = "id long, block int, channels array<array<float>>, error string"


def decoded_blocks(files: DataFrame, size: int, rate: int, channels: int, stream: Callable = decode_stream) -> DataFrame:
    """files (id, path) as numbered blocks of `size` samples.  A file that fails ends with a row that has an
    error and no samples, and so does one without any."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, path in b[["id", "path"]].itertuples(index=False):
                n, error = 0, None
                try:
                    for x in stream(path, size, rate, channels):
                        yield pd.DataFrame({"id": [i], "block": [n], "channels": [x], "error": [None]})
                        n += 1
                    error = None if n else "no samples"
                except Exception as e:  # any failure of a file is that file's row
                    error = repr(e)[:TAIL]
                if error:
                    yield pd.DataFrame({"id": [i], "block": [n], "channels": [None], "error": [error]})

    return files.select("id", "path").mapInPandas(run, BLOCKS)


WRITTEN = "id long, error string, began double, elapsed_sec double"


def written_blocks(blocks: DataFrame, places: DataFrame, rate: int, encode: Callable = encode_stream) -> DataFrame:
    """Join the blocks (id, block, channels, error) of each file to its output (places: id, out_path, sidecar_path,
    kbps): one row a file.  A file's blocks come to its writer in order and go on as they come, so they are never held
    together; the file takes its place when the last is in, and nothing is left of one that fails."""

    def parts(rows):
        for r in rows:
            if r.error is not None:
                raise RuntimeError(r.error)
            yield [np.asarray(c, np.float32) for c in r.channels]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in b.itertuples(index=False))
        for i, own in groupby(rows, key=lambda r: r.id):
            first, began, error = next(own), time.time(), None
            try:
                in_place(first.out_path, lambda part: encode(parts(chain([first], own)), part, rate, first.kbps))  # noqa: B023
            except Exception as e:
                error = repr(e)[:TAIL]
                delete_partial([first.out_path, first.sidecar_path])
            yield pd.DataFrame({"id": [i], "error": [error], "began": [began], "elapsed_sec": [time.time() - began]})

    placed = blocks.join(places.select("id", "out_path", "sidecar_path", "kbps"), "id")
    return placed.select(F.col("id").cast("long").alias("id"), "block", "channels", "error", "out_path", "sidecar_path", "kbps").repartition("id").sortWithinPartitions("id", "block").mapInPandas(run, WRITTEN)


def extract_command(path: str, channel: int | None, rate: int = 16000, tool: str = "ffmpeg") -> bytes:
    """One channel as 16-bit WAV, or the mix of all where channel is None."""
    pick = ["-ac", "1"] if channel is None else ["-af", f"pan=mono|c0=c{channel}"]
    return run_command([tool, "-v", "error", "-i", path, *pick, "-ar", str(rate), "-c:a", "pcm_s16le", "-f", "wav", "-"])


def read_wav(raw: bytes) -> tuple[int, np.ndarray]:
    """Rate and samples of a 16-bit WAV file; several channels are averaged."""
    with wave.open(io.BytesIO(raw)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("only 16-bit WAV files are read")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
        return w.getframerate(), x.reshape(-1, w.getnchannels()).mean(1).astype(np.float32)


def wav_samples(files: DataFrame) -> DataFrame:
    """files (path, content, as the binaryFile source gives them) as path, rate, samples and error."""

    def one(path: str, content) -> tuple:
        try:
            rate, x = read_wav(bytes(content))
            return path, rate, x, None
        except Exception as e:
            return path, None, None, repr(e)[:TAIL]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([one(p, c) for p, c in zip(b["path"], b["content"], strict=True)], columns=["path", "rate", "samples", "error"])
            yield out.astype({"rate": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, rate int, samples array<float>, error string")


def in_place(path: str, write: Callable[[str], None]) -> None:
    """write() makes a file beside path, which then takes its place at once; nothing is left if it fails."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    try:
        write(part)
        os.replace(part, path)
    finally:
        Path(part).unlink(missing_ok=True)


def encode_command(channels: list[np.ndarray], path: str, rate: int = 48000, kbps: int = 64, tool: str = "ffmpeg") -> None:
    """Clipped samples, one channel made two, as Opus at path."""
    x = channels * 2 if len(channels) == 1 else channels
    raw = np.clip(np.stack(x, 1), -1, 1).astype("<f4").tobytes()
    command = [tool, "-v", "error", "-y", "-f", "f32le", "-ar", str(rate), "-ac", str(len(x)), "-i", "-", "-c:a", "libopus", "-b:a", f"{kbps}k", "-f", "opus"]
    in_place(path, lambda part: run_command([*command, part], raw) and None)


def pass_through(source: str, path: str, method: str = "hardlink_or_copy") -> None:
    """The file unchanged, as a hard link where that can be, never a symbolic link."""
    if os.path.realpath(source) == os.path.realpath(path):
        raise ValueError("an input is never its own output")

    def write(part: str) -> None:
        if method == "hardlink_or_copy":
            try:
                return os.link(os.path.realpath(source), part)
            except OSError:
                pass
        shutil.copyfile(source, part)

    in_place(path, write)


def write_json(value: object, path: str) -> None:
    in_place(path, lambda part: Path(part).write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8") and None)


def delete_partial(paths: list[str]) -> None:
    """Outputs of a failed file, its sidecar and a cache with its side files; what is not there is no error."""
    for p in paths:
        for name in (p, f"{p}-wal", f"{p}-shm"):
            Path(name).unlink(missing_ok=True)
