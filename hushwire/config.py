"""Configuration: nested defaults, deep merge, files, profiles and rules, on the driver."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path

from hushwire.sources.media import in_place

PROFILES = ("default", "large")
KINDS = ("timed", "text")


@dataclass(frozen=True)
class Paths:
    input_root: str = "calls"
    input_glob: str = "audio.opus"
    output_root: str = "masked"
    work_dir: str = "work"
    suffix: str = ".opus"
    sidecar_suffix: str = ".json"
    exclude_globs: tuple[str, ...] = ()


def default_engines() -> dict[str, dict]:
    return {name: {"kind": "timed" if name == "alpha" else "text", "enabled": True, "model": name, "batch": 8 if name == "alpha" else 2} for name in ("alpha", "beta", "gamma", "delta")}


@dataclass(frozen=True)
class Recognisers:
    engines: dict = field(default_factory=default_engines)
    order: tuple[str, ...] = ("alpha", "beta", "gamma", "delta")
    anchor: str = "alpha"
    prefer: str = "alpha"
    fallback: tuple[str, ...] = ("alpha", "beta", "gamma", "delta")
    mode: str = "per_channel"
    input: str = "single_decode"
    residency: str = "keep_loaded"
    scope: str = "final_and_all_engines"
    word_times: bool = True
    batch: int = 8
    wav_rate: int = 16000
    min_agreement: int = 3
    soft_threshold: float = 0.78


@dataclass(frozen=True)
class Detection:
    batch: int = 16
    chunk_chars: int = 1800
    chunk_overlap: int = 240
    tag_threshold: float = 0.5
    rules: bool = True
    spoken: bool = True
    saved: bool = True
    taggers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Masking:
    mode: str = "silence"
    target_channels: str = "channel"
    rate: int = 48000
    channels: int = 2
    least_kbps: int = 24
    pad_sec: float = 0.12
    least_span_sec: float = 0.3
    merge_gap_sec: float = 0.05
    unmapped_policy: str = "mask_full_channel"


@dataclass(frozen=True)
class Runtime:
    profile: str = "default"
    schedule: str = "file_major"
    file_batch: int = 2
    least_batch: int = 1
    decoded_gb: float = 2.0
    least_free_gb: float = 2.0
    metrics: bool = False
    copy_method: str = "hardlink_or_copy"
    shard_count: int = 1
    shard_index: int = 0
    report_rows: int = 10_000
    limit: int | None = None
    resume: bool = True
    validate: bool = True
    validate_existing: bool = True
    longest_delta_sec: float = 0.2
    delete_results: bool = False


@dataclass(frozen=True)
class Config:
    paths: Paths = field(default_factory=Paths)
    recognisers: Recognisers = field(default_factory=Recognisers)
    detection: Detection = field(default_factory=Detection)
    masking: Masking = field(default_factory=Masking)
    runtime: Runtime = field(default_factory=Runtime)


def merged(base: dict, over: dict) -> dict:
    """Deep merge; lists and scalars are replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read(path: str) -> dict:
    """A JSON file, or a YAML file where a YAML reader is installed; an empty file gives nothing."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text or "{}")
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need a YAML reader; JSON files do without") from e
    return yaml.safe_load(text) or {}


def load(over: dict | str | None = None) -> Config:
    """Defaults with the given values (or a file's) over them; unknown keys are dropped; the profile is
    applied and the whole is validated."""
    values = merged(asdict(Config()), read(over) if isinstance(over, str) else over or {})
    parts = {f.name: type(getattr(Config(), f.name)) for f in fields(Config)}
    made = {}
    for name, kind in parts.items():
        known = {f.name for f in fields(kind)}
        made[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values[name].items() if k in known})
    return validate(profiled(Config(**made)))


def dump(c: Config, path: str) -> None:
    """The configuration in effect, as a file that load() reads."""
    in_place(path, lambda part: Path(part).write_text(json.dumps(asdict(c), indent=2, ensure_ascii=False), encoding="utf-8") and None)


def enabled(c: Config) -> list[str]:
    """Names of the enabled engines, in order."""
    r = c.recognisers
    return [n for n in (r.order or tuple(r.engines)) if r.engines.get(n, {}).get("enabled", True)]


def with_engines(c: Config, only: list[str] | None = None, without: list[str] | None = None) -> Config:
    """Only the named engines enabled, or all but some; unknown names are an error."""
    r = c.recognisers
    unknown = {*(only or ()), *(without or ())} - set(r.engines)
    if unknown:
        raise ValueError(f"unknown engines: {', '.join(sorted(unknown))}")
    on = lambda n: (n in only if only else r.engines[n].get("enabled", True)) and n not in (without or ())
    return validate(replace(c, recognisers=replace(r, engines={n: {**e, "enabled": on(n)} for n, e in r.engines.items()})))


def positive_ints(listed: str) -> list[int]:
    """Comma-separated whole numbers of at least 1."""
    out = [int(x) for x in listed.split(",") if x.strip()]
    if not out or min(out) < 1:
        raise ValueError("a list of positive whole numbers is wanted")
    return out


def profiled(c: Config) -> Config:
    """With the values of its profile."""
    if c.runtime.profile != "large":
        return c
    r = c.recognisers
    least = lambda e: max(8 if e.get("kind") == "timed" else 4, int(e.get("batch", 1)))
    return replace(
        c, recognisers=replace(r, residency="keep_loaded", engines={n: {**e, "batch": least(e)} for n, e in r.engines.items()}), detection=replace(c.detection, batch=32),
        runtime=replace(c.runtime, file_batch=4, decoded_gb=4.0, least_batch=1, least_free_gb=3.0, metrics=True),
    )


def validate(c: Config) -> Config:
    p, r, d, m, t = c.paths, c.recognisers, c.detection, c.masking, c.runtime
    rules = [
        (t.profile in PROFILES, "unknown profile"),
        (t.schedule in ("file_major", "model_major"), "unknown schedule"),
        (r.mode in ("per_channel", "mono_mix"), "unknown recogniser mode"),
        (r.input in ("single_decode", "temp_wav"), "unknown input strategy"),
        (r.word_times, "word times are needed, for masks depend on them"),
        (r.batch >= 1, "recogniser batch must be positive"),
        (r.wav_rate > 0, "wav_rate must be positive"),
        (r.residency in ("keep_loaded", "unload_after_file"), "unknown residency"),
        (r.scope in ("final_only", "all_engines_only", "final_and_all_engines"), "unknown detection scope"),
        (bool(r.engines), "engines must be defined"),
        (all(n in r.engines for n in r.order), "order names an unknown engine"),
        (all(e.get("kind") in KINDS for e in r.engines.values()), "unknown engine kind"),
        (all(e.get("model") for e in r.engines.values() if e.get("enabled", True)), "an enabled engine needs a model"),
        (all(int(e.get("batch", r.batch)) >= 1 for e in r.engines.values()), "engine batch must be positive"),
        (bool(enabled(c)), "at least one recogniser must be enabled"),
        (len(set(r.order)) == len(r.order), "recognisers must differ"),
        (r.anchor in enabled(c), "the anchor must be enabled"),
        (r.engines.get(r.anchor, {}).get("kind") == "timed", "the anchor must give word times"),
        (r.engines.get(r.anchor, {}).get("word_times", True), "the anchor must give word times"),
        (r.min_agreement >= 1, "min_agreement must be positive"),
        (0 <= r.soft_threshold <= 1, "soft_threshold must be within 0 and 1"),
        (m.mode in ("silence", "beep", "noise"), "unknown masking mode"),
        (m.target_channels in ("channel", "both"), "unknown target_channels"),
        (m.rate == 48000, "output rate must be 48000"),
        (m.channels == 2, "output must have two channels"),
        (m.unmapped_policy in ("mask_full_channel", "fail"), "unmapped_policy must mask or fail; copying is unsafe"),
        (min(m.pad_sec, m.least_span_sec, m.merge_gap_sec) >= 0, "lengths must not be negative"),
        (m.least_kbps >= 6, "least_kbps must be at least 6"),
        (d.batch >= 1, "detection batch must be positive"),
        (d.chunk_chars >= 256, "chunk_chars must be at least 256"),
        (d.chunk_overlap >= 0, "chunk_overlap must not be negative"),
        (0 <= d.tag_threshold <= 1, "tag_threshold must be within 0 and 1"),
        (t.longest_delta_sec >= 0, "longest_delta_sec must not be negative"),
        (len(enabled(c)) < 64, "at most 63 engines can be enabled"),
        (t.shard_count >= 1, "shard_count must be positive"),
        (0 <= t.shard_index < t.shard_count, "shard_index must be below shard_count"),
        (t.file_batch >= 1, "file_batch must be positive"),
        (t.least_batch >= 1, "least_batch must be positive"),
        (t.decoded_gb > 0, "decoded_gb must be positive"),
        (t.least_free_gb >= 0, "least_free_gb must not be negative"),
        (t.report_rows >= 0, "report_rows must not be negative"),
        (t.limit is None or t.limit >= 0, "limit must not be negative"),
        (t.copy_method in ("hardlink_or_copy", "copy"), "copy_method must link or copy; symbolic links are not allowed"),
        (Path(p.output_root).resolve() != Path(p.input_root).resolve(), "output_root must not be input_root"),
        (Path(p.work_dir).resolve() != Path(p.input_root).resolve(), "work_dir must not be input_root"),
    ]
    for ok, message in rules:
        if not ok:
            raise ValueError(message)
    return c
