"""``python -m weir produce|consume|report --domain coffee --data DIR --out DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from weir.functions.money import DECIMAL, PYTHON_FLOAT, money_text
from weir.plans import pipelines
from weir.session import build_session
from weir.streaming import runs

POLICIES = {policy.name: policy for policy in (DECIMAL, PYTHON_FLOAT)}
MONEY = ("revenue", "discount_given", "total", "mean", "minimum", "maximum")


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="weir")
    parser.add_argument("step", choices=["produce", "consume", "report"])
    parser.add_argument("--domain", choices=sorted(pipelines.DOMAINS), default="sales")
    parser.add_argument("--data", help="folder of the CSV files")
    parser.add_argument("--out", required=True, help="folder of the topic and the outputs")
    parser.add_argument("--count", type=int, help="records to read, or messages to consume, at most; all by default")
    parser.add_argument("--resume", action="store_true", help="consume what the last consumer left")
    parser.add_argument("--partitions", type=int, default=1, help="partitions of the topic")
    parser.add_argument("--rounding", choices=sorted(POLICIES), default=DECIMAL.name)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    domain, policy = pipelines.DOMAINS[args.domain], POLICIES[args.rounding]
    spark = build_session(f"weir {args.step}")
    spark.sparkContext.setLogLevel("WARN")
    if args.step == "produce":
        print(pipelines.run_producer(spark, domain, args.data, args.out, args.count, args.partitions))
    elif args.step == "consume":
        rates = pipelines.load_rates(spark, domain, args.data)
        topic = pipelines.read_whole_topic(spark, args.out)
        checkpoint = f"{args.out}/consumer"
        if not args.resume:
            runs.restart(spark, checkpoint)
        print(pipelines.run_consumer(topic, domain, rates, args.out, checkpoint, args.count, policy, not args.resume))
    else:
        frames = pipelines.report(spark, domain, args.out, policy)
        for name in ("accepted", "rejected", "by_region", "by_store", "by_size", "by_loyalty", "run_stats"):
            if name in frames:
                shown = [c for c in MONEY if c in frames[name].columns]
                print(name)
                frames[name].withColumns({c: money_text(F.col(c)) for c in shown}).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
