"""Command line: run, status, enumerate, verify-remote, retry-failed, finalize."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from siltworks import config
from siltworks.sources.adapters import ADAPTERS
from siltworks.sources.readers import read
from siltworks.sources.shards import cap_total, enumerate_shards, registry


def _shards(cfg: dict, limit: int | None) -> list:
    out = []
    for name, s, priority, ok, why in registry(cfg["sources"]):
        if not ok:
            print(f"{name}: {why}", file=sys.stderr)
            continue
        out += enumerate_shards(name, s["folder"], s.get("patterns", ("*",)), cfg["shard"]["target_bytes"], cfg["shard"]["max_bytes"], priority, s.get("max_shards"))
    shards, cut = cap_total(out, limit or cfg["prototype"]["max_total_shards"])
    if cut:
        print("the limit leaves shards out", file=sys.stderr)
    return shards


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="siltworks", description=__doc__)
    p.add_argument("--config", help="JSON file laid over the defaults")
    sub = p.add_subparsers(dest="verb", required=True)
    for verb in ("run", "status", "enumerate", "verify-remote", "retry-failed", "finalize"):
        q = sub.add_parser(verb)
        q.add_argument("--workspace")
        if verb in ("run", "enumerate"):
            q.add_argument("--max-shards", type=int)
        if verb == "run":
            q.add_argument("--allow-config-change", action="store_true")
        if verb in ("verify-remote", "run"):
            q.add_argument("--target")
    a = p.parse_args(argv)
    over = json.load(open(a.config, encoding="utf-8")) if a.config else None
    cfg = config.load(over, dotenv=".env")
    folder = a.workspace or cfg["paths"]["workspace"]
    if a.verb == "enumerate":
        for s in _shards(cfg, a.max_shards):
            print(s.shard_id, len(s.files), s.size)
        return 0
    from siltworks.plans.pipeline import Store
    from siltworks.session import session

    store = Store(session(), folder, cfg)
    failed = os.path.join(folder, "_failed.json")
    bad = json.load(open(failed)) if os.path.exists(failed) else {}
    if a.verb == "status":
        print(json.dumps({"committed": store.committed(), "failed": bad}, indent=1))
    elif a.verb == "retry-failed":
        if os.path.exists(failed):
            os.remove(failed)
    elif a.verb == "finalize":
        print(json.dumps(store.finalize(), indent=1))
    elif a.verb == "verify-remote":
        wrong = store.verify(a.target or os.path.join(folder, "published"))
        print("\n".join(wrong) or "all files match")
        return 1 if wrong else 0
    else:
        store.reconcile()
        for s in _shards(cfg, a.max_shards):
            if s.shard_id in bad or store.commit_of(s.shard_id):
                continue
            settings = cfg["sources"][s.source_dataset]
            for attempt in range(cfg["queue"]["max_retries"] + 1):
                try:
                    raw = read(store.spark, [f for f, _ in s.files])
                    store.run_batch(ADAPTERS[settings["adapter"]](raw, s.source_dataset, s.shard_id, **settings.get("options", {})), s.shard_id, allow_config_change=a.allow_config_change)
                    break
                except config.ConfigError:
                    raise
                except Exception as e:  # noqa: BLE001
                    if attempt == cfg["queue"]["max_retries"]:
                        bad[s.shard_id] = str(e)[:500]
                        json.dump(bad, open(failed, "w"))
                    else:
                        time.sleep(min(cfg["queue"]["retry_backoff_max_s"], cfg["queue"]["retry_backoff_base_s"] * 2**attempt))
        if a.target:
            store.finalize()  # records get the stamps of whole repositories
            store.publish(a.target)
        return 2 if bad else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
