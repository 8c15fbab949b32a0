"""Command line: init, search, remember, stats, sync-local, seed, ingest-notes."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import functions as F

from .bridge import Bridge, errors
from .config import load
from .operators import ingest, views
from .session import local_session
from .sources import curated, local, notes
from .store import Store


def _show(rows) -> None:
    print(json.dumps([r.asDict(recursive=True) for r in rows], indent=2, default=str, ensure_ascii=False))


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="recall")
    p.add_argument("--user", default="")
    p.add_argument("--agent", default="")
    p.add_argument("--home", default="")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init")
    s = sub.add_parser("search")
    s.add_argument("query")
    s.add_argument("--top-k", type=int, default=8)
    s = sub.add_parser("remember")
    s.add_argument("fact")
    sub.add_parser("stats")
    s = sub.add_parser("sync-local")
    s.add_argument("--limit", type=int, default=50)
    s = sub.add_parser("seed")
    s.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("ingest-notes")
    s.add_argument("vault", nargs="*")
    s.add_argument("--limit", type=int, default=0)
    s.add_argument("--batch-chars", type=int, default=6000)
    s.add_argument("--min-chars", type=int, default=200)
    s.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    settings = load(user_id=a.user, agent_name=a.agent, home=a.home)
    home = os.path.expanduser(settings.home)
    spark = spark or local_session()
    store = Store(spark, settings)
    store.init()
    bridge = Bridge(store)
    if a.command == "init":
        print(f"Ready: {settings.database}, bank {store.create_bank()}")
    elif a.command == "search":
        found = bridge.retrieve_context(a.query, a.top_k)
        print(json.dumps(found, indent=2, default=str, ensure_ascii=False))
        if found["prompt_context"]:
            print(f"\n--- Prompt context ---\n{found['prompt_context']}")
    elif a.command == "remember":
        done = bridge.explicit_remember(a.fact)
        print(json.dumps(done, indent=2, default=str, ensure_ascii=False))
        return int(bool(errors(done)))
    elif a.command == "stats":
        _show(views.stats(store.table("memories"), a.user or None).collect())
    elif a.command == "sync-local":
        rows = local.read_local(spark, home, a.limit).collect()
        _show(rows)
        print(f"Found {len(rows)} local facts.")
    elif a.command == "seed":
        found = curated.read_curated(spark, home)
        new = ingest.seed_new_facts(found, store.table("memories"), settings.user_id, settings.seed_limit)
        _show(ingest.summary(found, new).collect())
        rows = new.collect()  # what a person has written into two files
        if a.dry_run:
            _show(rows)
            return 0
        written = 0
        for r in rows:
            bad = errors(bridge.explicit_remember(r["fact"], {"kind": r["kind"], "source_file": r["source_file"], "seed": True}))
            written += not bad
            print(f"  [{'FAIL' if bad else 'OK'}] {r['fact'][:60]}" + (f" -> {bad}" if bad else ""))
        print(f"Seeded {written}/{len(rows)} new facts for {bridge.scope()}")
    elif a.command == "ingest-notes":
        path = os.path.join(home, "manifest")
        known = notes.read_manifest(spark, path)
        every = notes.discover_notes(spark, a.vault or settings.note_roots, a.min_chars)
        new = ingest.note_diff(every, known).orderBy("path")
        new = new.limit(a.limit) if a.limit else new
        _show(ingest.summary(every, new).collect())
        batches = ingest.note_batches(new, a.batch_chars).cache()
        numbers = [tuple(r) for r in batches.groupBy("vault", "batch").agg(F.count("*")).orderBy("vault", "batch").collect()]  # a row a batch, none for a note
        done = failed = 0
        for i, (vault, number, count) in enumerate(numbers):
            own = new.join(batches.filter((F.col("vault") == vault) & (F.col("batch") == number)).select("path"), "path")
            if a.dry_run:
                print(f"  [dry-run] batch {i + 1}/{len(numbers)}: {count} notes")
                continue
            try:  # the facts of a batch, then its manifest: what is done is not done again
                lines = F.array_sort(F.collect_list(F.struct("path", "rendered")))
                text = ingest.note_render(own).agg(F.concat_ws("\n\n", F.transform(lines, lambda x: x["rendered"])).alias("text"))
                bridge.generate(text, bridge.scope())
                os.makedirs(path, exist_ok=True)
                notes.write_manifest(ingest.manifest_upsert(notes.read_manifest(spark, path), own), path)
                done += count
            except Exception as e:
                failed += 1
                print(f"  [FAIL] batch {i + 1}/{len(numbers)}: {str(e).splitlines()[0]}")
        batches.unpersist()
        if not a.dry_run:
            print(f"Ingested {done} notes in {len(numbers) - failed}/{len(numbers)} batches for {bridge.scope()}")
        return int(bool(failed))
    return 0
