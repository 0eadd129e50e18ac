"""Configuration: defaults, YAML-like overrides, environment, validation, and the hash of what affects data."""

from __future__ import annotations

import copy
import hashlib
import json
import os
from collections.abc import Mapping
from typing import Any

VERSION = "0.1.0"

DEFAULTS: dict[str, Any] = {
    "pipeline_version": VERSION,
    "paths": {"workspace": "./workspace"},
    "queue": {"max_local_shards": 5, "max_retries": 4, "retry_backoff_base_s": 30, "retry_backoff_max_s": 3600},
    "shard": {"target_bytes": 1_500_000_000, "min_bytes": 1_000_000_000, "max_bytes": 2_000_000_000},
    "processing": {"batch_size": 2048, "parquet_compression": "zstd", "parquet_row_group_size": 65_536, "parquet_row_group_max_mb": 64, "token_counter": "heuristic"},
    "dedup": {
        "exact": {"enabled": True},
        "near": {"enabled": True, "mode": "annotate", "num_perm": 128, "jaccard_threshold": 0.8, "shingle_size": 5, "min_tokens": 30, "exempt_record_types": ["commit", "issue"]},
    },
    "licenses": {
        "permissive_action": "keep", "weak_copyleft_action": "flag", "strong_copyleft_action": "drop", "unknown_action": "flag",
        "source_level_permissive": ["starcoderdata", "starcoder2data_extras"],
    },
    "secrets": {"enabled": True, "redact_emails": True, "redact_ips": True, "max_hits_per_file": 20, "drop_env_like_files": True},
    "quality": {
        "min_content_chars": 2, "max_content_bytes": 1_048_576, "minified_avg_line_len": 250.0, "minified_max_line_len": 10_000, "max_base64_run": 2048, "repeated_line_ratio": 0.10, "min_alnum_ratio": 0.20,
        "lockfile_max_bytes": 204_800,
        "drop_flags": ["binary_like", "empty", "too_large", "minified", "vendored", "data_blob_heavy", "repeated_content", "generated_metadata", "lockfile_large", "low_alnum"],
        "flag_only": ["generated_marker", "lockfile", "suspicious_obfuscation"],
    },
    "complexity": {"min_file_tokens": 4, "drop_below_min_tokens": True},
    "subsets": {"materialize_high_quality": True, "high_quality_min_score": None},
    "sources": {},
    "prototype": {"max_total_shards": None},
}

#: Keys that only change speed or layout; they aren't hashed.
UNHASHED = ("paths", "queue", "prototype", "processing.parquet_row_group_size", "processing.parquet_row_group_max_mb", "processing.batch_size", "sources")

#: Sizes that may be given in decimal gigabytes.
_SIZES = ("target", "min", "max")


class ConfigError(ValueError):
    pass


def merge(base: Mapping[str, Any], over: Mapping[str, Any] | None) -> dict[str, Any]:
    """over laid on base, mapping by mapping; other values replace."""
    out = copy.deepcopy(dict(base))
    for k, v in (over or {}).items():
        out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else copy.deepcopy(v)
    return out


def get(cfg: Mapping[str, Any], dotted: str, default: Any = None) -> Any:
    node: Any = cfg
    for part in dotted.split("."):
        if not isinstance(node, Mapping) or part not in node:
            return default
        node = node[part]
    return node


def load(over: Mapping[str, Any] | None = None, env: Mapping[str, str] | None = None, dotenv: str | None = None) -> dict[str, Any]:
    """Defaults, then over, then a .env file, then the environment (SILTWORKS__A__B=json or text)."""
    cfg = merge(DEFAULTS, over)
    values: dict[str, str] = {}
    if dotenv and os.path.exists(dotenv):
        with open(dotenv, encoding="utf-8") as f:
            for line in f:
                k, eq, v = line.strip().partition("=")
                if eq and not k.startswith("#"):
                    values[k.removeprefix("export ").strip()] = v.strip().strip("\"'")
    values |= dict(os.environ if env is None else env)
    for k, v in values.items():
        if k.startswith("SILTWORKS__"):
            node = cfg
            *parts, last = k[len("SILTWORKS__"):].lower().split("__")
            for part in parts:
                node = node.setdefault(part, {})
            try:
                node[last] = json.loads(v)
            except ValueError:
                node[last] = v
    shard = cfg["shard"]
    for k in _SIZES:
        if f"{k}_gb" in shard:
            shard[f"{k}_bytes"] = int(float(shard.pop(f"{k}_gb")) * 1e9)
    validate(cfg)
    return cfg


def validate(cfg: Mapping[str, Any]) -> None:
    s = cfg["shard"]
    if not 0 < s["min_bytes"] <= s["target_bytes"] <= s["max_bytes"]:
        raise ConfigError("shard sizes must be 0 < min <= target <= max")
    near = cfg["dedup"]["near"]
    if near["mode"] not in ("annotate", "drop"):
        raise ConfigError("dedup.near.mode must be annotate or drop")
    if not 0 < near["jaccard_threshold"] <= 1 or near["num_perm"] < 1 or near["shingle_size"] < 1:
        raise ConfigError("dedup.near has values out of range")
    for k in ("permissive", "weak_copyleft", "strong_copyleft", "unknown"):
        if cfg["licenses"][f"{k}_action"] not in ("keep", "flag", "drop"):
            raise ConfigError(f"licenses.{k}_action must be keep, flag or drop")
    if not 1 <= cfg["queue"]["max_local_shards"] <= 5:
        raise ConfigError("queue.max_local_shards must be 1 to 5")


def config_hash(cfg: Mapping[str, Any]) -> str:
    """16 hex digits over the keys that affect data: equal settings give equal hashes, in any order."""
    data = copy.deepcopy(dict(cfg))
    for dotted in UNHASHED:
        node = data
        *parts, last = dotted.split(".")
        for part in parts:
            node = node.get(part, {})
        node.pop(last, None)
    return hashlib.sha256(json.dumps(data, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]
