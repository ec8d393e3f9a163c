"""Command line: ``python -m annoweave.cli <command>``.

Commands: initialize, run, leakage, merge, coverage. Options that ``run`` does not
know are settings by name (``--limit-per-entry 5``), over those of the settings file.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from annoweave import config
from annoweave.functions.text import accession
from annoweave.operators import coverage, leakage
from annoweave.plans import pipeline
from annoweave.runtime import session
from annoweave.sources import fasta, raw, sinks

#: Settings that ``run`` takes as options, all as text; cleaning is the settings' own.
OPTIONS = (
    "input prefix base_directory reference limit_execution only_lookup only_embedding device length_filter sequence_queue_package limit_per_entry "
    "redundancy_identity redundancy_filter redundancy_coverage alignment_coverage threads taxonomy_ids_to_exclude taxonomy_ids_included_exclusively get_descendants log_path monitor_interval"
).split()


def lookup_of(conf: Mapping[str, Any]) -> pipeline.Lookup:
    """The lookup that resolved settings ask for."""
    look, post = conf["lookup"], conf.get("postprocess") or {}
    keep = config.boolean(post.get("keep_sequences"))
    return pipeline.Lookup(
        k=look["limit_per_entry"],
        metric=look["distance_metric"],
        thresholds=config.thresholds_of(conf),
        exclude=look["taxonomy"]["exclude"],
        include=look["taxonomy"]["include_only"],
        evidence=list(look.get("evidence_codes") or []),
        redundancy_identity=look["redundancy"]["identity"],
        redundancy_coverage=look["redundancy"]["coverage"],
        align=config.boolean(look.get("align")) is not False,
        keep_sequences=keep is not False,
        precision=look["precision"],
    )


def run_settings(spark: SparkSession, conf: Mapping[str, Any]) -> str:
    """A run as the settings say; the folder of its results.

    ``reference`` is the folder of the reference tables (by default
    ``base_directory``/reference), ``input`` a FASTA path or, with only_lookup,
    a parquet table of query vectors. ``limit_execution`` caps the input records.
    """
    base = os.path.expanduser(str(conf.get("base_directory") or "."))
    tables = conf.get("reference") or os.path.join(base, "reference")
    source, limit = conf.get("input"), conf["limit_execution"] or None
    if not source:
        raise ValueError("no input is set")
    out = sinks.experiment_dir(spark, os.path.join(base, "experiments"), str(conf.get("prefix") or "run"), conf)
    if conf["only_lookup"]:
        t = pipeline.Tables.at(spark, tables, vectors=source)
    else:
        t = pipeline.Tables.at(spark, tables, fasta_path=source, limit=limit)
    pipeline.run(
        t,
        out,
        lookup_of(conf),
        config.summary_of(conf),
        models=config.models_of(conf),
        only_lookup=conf["only_lookup"],
        only_embedding=conf["only_embedding"],
        max_length=conf["embedding"].get("max_sequence_length"),
        topgo=conf["lookup"]["topgo"],
    )
    return out


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    given = {k: getattr(args, k) for k in OPTIONS if getattr(args, k) is not None}
    print(run_settings(spark, config.load(args.config, config.overrides(args.rest), given)))
    return 0


def _initialize(spark: SparkSession, args: argparse.Namespace) -> int:
    """Copies reference tables, by JDBC or from parquet; nothing without a source."""
    conf = config.load(args.config, {"base_directory": args.base_directory, "embeddings_url": args.embeddings_url})
    url = conf.get("embeddings_url")
    if not url:
        print("no embeddings_url is set: nothing to do")
        return 0
    target = os.path.join(os.path.expanduser(str(conf.get("base_directory") or ".")), "reference")
    names = [n.strip() for n in args.tables.split(",") if n.strip()]
    source = {"url": url, "tables": ",".join(names)} if url.startswith("jdbc:") else {n.partition(":")[0]: f"{url.rstrip('/')}/{n}.parquet" for n in names}
    print(f"{config.url_name(url)}: {'copied' if raw.import_reference(spark, source, target) else 'there already'}")
    return 0


def _leakage(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = raw.read_strict(spark, args.input)
    for t in sorted(set(args.threshold)):
        sinks.write_leakage(rows, args.output_dir, t)
        print(json.dumps(leakage.counters(rows, t).first().asDict(), sort_keys=True))
    return 0


def _merge(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = raw.read_strict(spark, args.input)
    out = args.output or f"{args.input.rstrip('/')}_merged"
    sinks.write_merged(rows, out, args.add_source_file)
    whole = raw.merge_statistics(rows).where("total").first()
    print(f"{whole['files']} files, {whole['rows']} rows: {out}")
    return 0


def coverage_of(spark: SparkSession, path: str, vectors: str) -> DataFrame:
    """Which identifiers of FASTA headers have a vector."""
    stored = spark.read.parquet(vectors).select(accession("accession").alias("accession"))
    return coverage.report(fasta.header_ids(spark, path), stored)


def _coverage(spark: SparkSession, args: argparse.Namespace) -> int:
    rep = coverage_of(spark, args.input, args.embeddings)
    sinks.write_table(rep.orderBy("accession"), args.output, sep="\t")
    print(json.dumps(coverage.counts(rep).first().asDict()))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="annoweave", description=__doc__)
    top.add_argument("--master", help="Spark master; by default that of the environment, or all local cores")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, do: Callable[[SparkSession, argparse.Namespace], int], text: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        p.set_defaults(do=do)
        return p

    p = command("initialize", _initialize, "copy the reference tables")
    p.add_argument("--config")
    p.add_argument("--embeddings_url", help="a jdbc: address, or a folder of parquet tables")
    p.add_argument("--base_directory")
    p.add_argument("--log_path")
    p.add_argument("--tables", default="reference_embedding,ref_sequences,protein,protein_go_term_annotation,go_terms,embedding_type")
    p = command("run", _run, "embedding, lookup and summary")
    p.add_argument("--config")
    for name in OPTIONS:
        p.add_argument(f"--{name}", **({"nargs": "?", "const": "true"} if name in ("only_lookup", "only_embedding", "get_descendants") else {}))
    p = command("leakage", _leakage, "choose donors under identity cutoffs")
    p.add_argument("input")
    p.add_argument("--threshold", type=float, action="append", required=True)
    p.add_argument("--output-dir", required=True)
    p = command("merge", _merge, "one table of many result files")
    p.add_argument("input")
    p.add_argument("-o", "--output")
    p.add_argument("--add-source-file", action="store_true")
    p = command("coverage", _coverage, "which records have a vector")
    p.add_argument("--input", required=True)
    p.add_argument("--embeddings", required=True)
    p.add_argument("--output", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args, rest = parser().parse_known_args(argv)
    if rest and args.command != "run":
        parser().error(f"unknown options: {' '.join(rest)}")
    args.rest = rest
    spark = spark or SparkSession.getActiveSession() or (SparkSession.builder.master(args.master).getOrCreate() if args.master else session())
    try:
        return args.do(spark, args)
    except (ValueError, FileNotFoundError) as problem:
        print(f"annoweave: {problem}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
