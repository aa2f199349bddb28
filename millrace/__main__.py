"""Command line: ``python -m millrace <job> --root <folder> ...``"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from millrace.jobs import Lakehouse, jdbc_source
from millrace.ml.evaluation import MODES
from millrace.ml.model import SEED, TEST_SIZE
from millrace.ml.scoring import ALERT_THRESHOLD
from millrace.plans.marts import MARTS
from millrace.session import get_session
from millrace.sources.entities import ENTITIES
from millrace.sources.readers import read_jdbc_keys
from millrace.streaming.feed import kafka_feed
from millrace.streaming.supervise import Supervisor


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description="Loads of the lakehouse.")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the lakehouse")
        sub.add_argument("--active_only", action="store_true", help="leave out soft-deleted rows")
        sub.add_argument("--buckets", type=int, help="partitions of the cleaned tables; fixed once used")
        return sub

    seed = job("seed", "load CSV files once")
    seed.add_argument("--folder", required=True)

    extract = job("extract", "land a table of the relational source")
    extract.add_argument("--table_name", required=True, choices=sorted(ENTITIES))
    extract.add_argument("--url", required=True)
    extract.add_argument("--logical_date", type=datetime.fromisoformat)
    _add_slices(extract)

    land = job("land", "land change topics until stopped")
    land.add_argument("--servers", required=True)
    land.add_argument("--topic", action="append", required=True, metavar="ENTITY=TOPIC")

    silver = job("silver", "clean and merge a landed table")
    silver.add_argument("--table_name", required=True, choices=sorted(ENTITIES))
    silver.add_argument("--json_schema", help="fields of a change record, as DDL")
    silver.add_argument("--url", help="relational source, for the sweep of deleted rows")
    _add_slices(silver)

    job("dimensions", "load all dimensions").add_argument("--now")
    job("facts", "load all facts")
    job("mart", "build a mart").add_argument("--table_name", required=True, choices=list(MARTS))
    job("publish", "register all tables in the catalog")
    job("features", "build the training features")

    train = job("train", "train and report")
    train.add_argument("--optimize", choices=MODES, default="recall0")
    train.add_argument("--test-size", type=float, default=TEST_SIZE)
    train.add_argument("--random-state", type=int, default=SEED)

    job("score", "alert on new orders").add_argument(
        "--threshold", type=float, default=ALERT_THRESHOLD
    )
    return top


def _add_slices(job: argparse.ArgumentParser) -> None:
    job.add_argument("--partition_column", help="numeric or date column to read the source in slices by")
    job.add_argument("--slices", type=int, default=64)
    job.add_argument("--bounds", nargs=2, metavar=("LOW", "HIGH"), help="asked of the source when absent")


def slices(args: argparse.Namespace) -> dict[str, object]:
    """Options of a relational read in slices; none without a partition column."""
    if not args.partition_column:
        return {}
    bounds = tuple(args.bounds) if args.bounds else None
    return {"partition_column": args.partition_column, "num_partitions": args.slices, "bounds": bounds}


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = get_session(f"millrace-{args.job}")
    house = Lakehouse(spark, args.root, args.active_only, args.buckets)
    now = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")

    if args.job == "seed":
        print(house.seed(args.folder))
    elif args.job == "extract":
        rows = jdbc_source(spark, args.url, **slices(args))(args.table_name)
        print(house.extract(args.table_name, rows, args.logical_date or datetime.now(UTC)))
    elif args.job == "land":
        topics = dict(pair.split("=", 1) for pair in args.topic)
        feeds = {name: kafka_feed(spark, args.servers, topic) for name, topic in topics.items()}
        queries = house.land_changes(feeds)
        with Supervisor(spark, f"{house.root}/counts") as supervisor:
            supervisor.finish(*queries.values(), names=list(queries))
    elif args.job == "silver":
        keys = None
        if args.url:
            names = list(ENTITIES[args.table_name].keys)
            keys = read_jdbc_keys(spark, args.url, args.table_name, names, **slices(args))
        house.refresh_entity(args.table_name, keys, args.json_schema)
    elif args.job == "dimensions":
        house.refresh_dimensions(args.now or now)
    elif args.job == "facts":
        house.refresh_facts()
    elif args.job == "mart":
        house.refresh_mart(args.table_name)
    elif args.job == "publish":
        house.warehouse.publish()
    elif args.job == "features":
        house.refresh_features()
    elif args.job == "train":
        report, threshold, area = house.train(
            args.optimize, test_size=args.test_size, seed=args.random_state
        )
        report.show()
        print(f"threshold {threshold}, ROC AUC {area:.4f}")
    elif args.job == "score":
        house.score(now, args.threshold)


if __name__ == "__main__":
    main()
