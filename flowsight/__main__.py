"""Runs a job: `python -m flowsight JOB --option value ...`, or the same by spark-submit.

Jobs: flow-batch, flow-stream, fraud-batch, fraud-stream, publish, compact. Every option of
`flowsight.options` is an argument of its name; see --help after the job.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from flowsight.operators.ensemble import load_ensemble
from flowsight.options import FlowOptions, FraudOptions, GeneratorOptions
from flowsight.plans import flow_anomaly, fraud_detection, inputs, publisher
from flowsight.session import build_session
from flowsight.sinks import compaction

KINDS = {
    "flow-batch": FlowOptions,
    "flow-stream": FlowOptions,
    "fraud-batch": FraudOptions,
    "fraud-stream": FraudOptions,
    "publish": GeneratorOptions,
}


def _argument(parser: argparse.ArgumentParser, field: dataclasses.Field) -> None:
    name, default = f"--{field.name}", field.default
    if isinstance(default, bool):
        parser.add_argument(name, action=argparse.BooleanOptionalAction, default=default)
    elif "tuple" in str(field.type):
        parser.add_argument(name, type=lambda text: tuple(text.split(",")), default=default)
    elif "bytes |" in str(field.type):
        parser.add_argument(name, type=str.encode, default=default)
    else:
        parser.add_argument(name, type=type(default) if default is not None else str, default=default)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flowsight", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for job, kind in KINDS.items():
        one = jobs.add_parser(job)
        for field in dataclasses.fields(kind):
            if "Callable" not in str(field.type):
                _argument(one, field)
        if job.endswith("-stream"):
            one.add_argument("--checkpoint", required=True)
            one.add_argument("--available_now", action="store_true")
        if job.endswith("-batch"):
            one.add_argument("--load_id", default=None)
        if job.startswith("fraud"):
            kind_of_model = one.add_mutually_exclusive_group(required=True)
            kind_of_model.add_argument("--model", help="folder of a saved model")
            kind_of_model.add_argument("--nodes", help="folder of a saved table of tree nodes")
        if job == "publish":
            one.add_argument("--output", required=True)
            one.add_argument("--rows", type=int, required=True)
    one = jobs.add_parser("compact")
    one.add_argument("--table", required=True)
    one.add_argument("--cluster_by", type=lambda text: text.split(","), default=None)
    one.add_argument("--clean", action="store_true", help="remove what was merged; no reader may be running")
    return top


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    """Parses the arguments, makes missing tables and runs the job to its end."""
    given = vars(parser().parse_args(arguments))
    job = given["job"]
    if job == "compact":
        compaction.compact(spark, given["table"], cluster_by=given["cluster_by"])
        if given["clean"]:
            compaction.clean(spark, given["table"])
        return
    kind = KINDS[job]
    names = {f.name for f in dataclasses.fields(kind)}
    options = kind(**{k: v for k, v in given.items() if k in names})
    if job == "publish":
        publisher.bounded(spark, given["rows"], options).select("value").write.text(given["output"])
        return
    if job.startswith("flow"):
        flow_anomaly.create_tables(spark, options)
        centroids, ranges = inputs.side_tables(spark, options)
    else:
        fraud_detection.create_tables(spark, options)
        nodes = given["nodes"]
        model = load_ensemble(spark, nodes) if nodes else PipelineModel.load(given["model"])
    if job == "flow-batch":
        lines = inputs.batch_lines(spark, options)
        flow_anomaly.run_batch(lines, centroids, options, ranges, given["load_id"])
    elif job == "fraud-batch":
        lines = inputs.batch_lines(spark, options)
        fraud_detection.run_batch(lines, options, model, load_id=given["load_id"])
    else:
        lines = inputs.live_lines(spark, options)
        if job == "flow-stream":
            started = flow_anomaly.start_stream(
                lines, centroids, options, given["checkpoint"], ranges, given["available_now"]
            )
        else:
            started = fraud_detection.start_stream(
                lines, options, given["checkpoint"], model, available_now=given["available_now"]
            )
        for query in started:
            query.awaitTermination()


if __name__ == "__main__":
    run(build_session())
