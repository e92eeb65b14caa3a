"""Command lines: sample a snapshot or a catalog, build topic partitions, sample every topic, resolve Scholar articles."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from urllib.request import Request, urlopen

from .functions.ids import topic_key
from .plans import rest_runs, workflows
from .runtime import clear, cluster_session, local_session
from .sources import rest, scholar, snapshot
from .sources.config import api_key, load_config
from .streaming.builder import build


def parser() -> argparse.ArgumentParser:
    engine = argparse.ArgumentParser(add_help=False)
    engine.add_argument("--master", help="a cluster, in place of a local session")
    engine.add_argument("--cores", default="*", help="threads of a local session")
    engine.add_argument("--memory", default="8g", help="memory of a local session")
    engine.add_argument("--shuffle-partitions", type=int, default=200)
    engine.add_argument("--open-files", type=int, help="writers that a task keeps open at once")
    engine.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="any other setting of the session")
    served = argparse.ArgumentParser(add_help=False)
    served.add_argument("--url", help="a catalog's REST interface, in place of a snapshot")
    served.add_argument("--key-variable", default="CATALOG_API_KEY", help="environment variable with the key")
    served.add_argument("--env-file", default=".env")
    top = argparse.ArgumentParser(prog="paperloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    sample = commands.add_parser("sample", help="sample a snapshot or a catalog", parents=[engine, served])
    sample.add_argument("--config", required=True)
    sample.add_argument("--snapshot")
    sample.add_argument("--output")
    sample.add_argument("--count", type=int)
    make = commands.add_parser("build", help="build topic partitions", parents=[engine])
    make.add_argument("source")
    make.add_argument("output")
    make.add_argument("--files-per-batch", type=int, default=32)
    make.add_argument("--buckets-at-once", type=int, default=8)
    make.add_argument("--compression", choices=("zstd", "snappy"), default="zstd")
    batch = commands.add_parser("topics", help="sample every topic of a partitioned snapshot, or of a catalog's field", parents=[engine, served])
    batch.add_argument("--snapshot")
    batch.add_argument("--field", help="id of the field")
    batch.add_argument("--field-name", help="its name, looked up")
    batch.add_argument("output")
    batch.add_argument("--since", default="2005-01-01")
    batch.add_argument("--overwrite", action="store_true")
    articles = commands.add_parser("scholar", help="resolve scraped articles", parents=[engine, served])
    articles.add_argument("output")
    articles.add_argument("--scrape", metavar="URL", help="page of the top journals")
    articles.add_argument("--fixture", help="JSON or CSV, used where scraping fails or isn't asked for")
    articles.add_argument("--snapshot")
    articles.add_argument("--per-page", type=int, default=rest.MOST_PAGE)
    for one in (batch, articles):
        one.add_argument("--count", type=int, default=workflows.PER_TOPIC)
        one.add_argument("--seed", type=int)
    return top


def _page(url: str) -> str:
    with urlopen(Request(url, headers={"Accept": "text/html"}), timeout=rest.TIMEOUT) as answer:  # noqa: S310
        return answer.read().decode("utf-8", "replace")


def session(args: argparse.Namespace):
    own = dict(pair.split("=", 1) for pair in args.conf) | {"spark.driver.memory": args.memory}
    if args.open_files:
        own["spark.sql.maxConcurrentOutputFileWriters"] = str(args.open_files)
    if args.master:
        return cluster_session(args.master, **own, **{"spark.sql.shuffle.partitions": str(args.shuffle_partitions)})
    return local_session(args.cores, args.shuffle_partitions, **own)


def main(argv: list[str] | None = None, *, fetcher=rest.fetch, fetch_page=_page) -> int:
    from pyspark.sql import functions as F

    args, spark = parser().parse_args(argv), None
    try:
        for name in ("count", "files_per_batch", "buckets_at_once"):
            if getattr(args, name, None) is not None and getattr(args, name) <= 0:
                raise ValueError(f"--{name.replace('_', '-')} must be positive")
        if not 1 <= getattr(args, "per_page", 1) <= rest.MOST_PAGE:
            raise ValueError(f"--per-page must be from 1 to {rest.MOST_PAGE}")
        if hasattr(args, "url") and bool(args.url) == bool(args.snapshot):
            raise ValueError("either --snapshot or --url must be given")
        key = api_key(args.key_variable, args.env_file) if getattr(args, "url", None) else None
        spark = session(args)
        if args.command == "sample":
            config = load_config(args.config, **({"api_key": key} if args.url else {"most": None}))
            config = dataclasses.replace(config, **{k: v for k, v in (("output_path", args.output), ("count", args.count)) if v is not None})
            document = rest_runs.sample_catalog(spark, config, args.url, fetcher=fetcher) if args.url else workflows.sample_snapshot(spark, args.snapshot, config)
            result = document["metadata"]["query"]
        elif args.command == "build":
            result = build(spark, args.source, args.output, files_per_batch=args.files_per_batch, compression=args.compression, buckets_at_once=args.buckets_at_once)
        elif args.command == "topics" and args.url:
            field = args.field or rest_runs.find_field(spark, args.field_name or "", args.url, fetcher, key)
            result = rest_runs.topic_batch(spark, field.rsplit("/", 1)[-1], args.output, args.url, since=args.since, count=args.count, seed=args.seed, overwrite=args.overwrite, fetcher=fetcher, api_key=key)["metadata"]
        elif args.command == "topics":
            works = spark.read.parquet(f"{args.snapshot}/data")
            catalog = snapshot.read_catalog(spark, args.snapshot).withColumn("topic_id", topic_key(F.col("id")))
            result = workflows.topic_batch(works, catalog, args.output, count=args.count, seed=args.seed or 0)[1]
        else:
            given = (lambda: scholar.read_fixture(spark, args.fixture)) if args.fixture else None
            if not args.scrape and given is None:
                raise ValueError("either --scrape or --fixture must be given")
            failures: list[str] = []

            def scraped():
                try:
                    return scholar.scrape(spark, args.scrape, fetch_page)
                except Exception as e:
                    failures.append(str(e))
                    raise

            rows, method = scholar.load(scraped, given) if args.scrape else (given(), "fixture")
            if args.url:
                result = rest_runs.scholar_run(spark, rows, args.output, args.url, method=method, failures=tuple(failures), count=args.count, seed=args.seed, per_page=args.per_page, fetcher=fetcher, api_key=key)
                result = {"papers": len(result["papers"]), "unresolved": len(result["unresolved"])}
            else:
                rows = rows.withColumn("article_id", F.xxhash64("journal", "ord"))
                result = workflows.scholar_run(rows, spark.read.parquet(f"{args.snapshot}/data"), args.output, count=args.count, seed=args.seed or 0, folders=True)[1]
    except (ValueError, LookupError, RuntimeError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    finally:
        if spark is not None:
            clear(spark)
    print(json.dumps(result, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
