"""Queries of sources, sinks, settings and preparation: what is written is read again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annoweave import config
from annoweave.config import Summary
from annoweave.functions.align import OPEN, EXTEND, local_alignment, matrix
from annoweave.functions.text import accession, letters, source_name
from annoweave.operators import annotate, embed, exports, leakage, prepare, redundancy, reference, summary, taxonomy
from annoweave.plans import pipeline, queries as q, sql as s
from annoweave.runtime import materialise, scratch, spread, table
from annoweave.schema import RAW
from annoweave.sources import fasta, raw as raw_source, sinks
from annoweave.streaming import search

_ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _ALL[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_ALL)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# sources ---------------------------------------------------------------------

_SEQ = s._LETTERS.format("sequence")
_REFS = f"refs AS (SELECT id, min({_SEQ}) AS sequence FROM ref_sequences WHERE id IS NOT NULL AND sequence IS NOT NULL GROUP BY 1)"


def _fasta_files(spark: SparkSession, d: str) -> str:
    """The reference sequences as wrapped, lower-case FASTA, in order of their ids; the folder."""
    refs = table(spark, d, "ref_sequences").where("id is not null and sequence is not null").groupBy("id").agg(F.min(letters("sequence")).alias("sequence"))
    wrapped = F.regexp_replace(F.lower("sequence"), "(.{60})", "$1\n")
    path = scratch(spark, "fasta")
    refs.orderBy("id").select(F.concat(F.lit(">sp|"), F.col("id").cast("string"), F.lit(" name\nOS=1\n"), wrapped)).write.text(path)
    return path


@_query(f"WITH {_REFS} SELECT 'sp|' || id AS identifier, sequence FROM refs ORDER BY id LIMIT 25")
def fasta_row_cap(spark: SparkSession, d: str) -> DataFrame:
    """The row cap of the query scan, in order of files and positions; the cap is the feature."""
    return fasta.read(spark, _fasta_files(spark, d), limit=25).select("identifier", "sequence")


@_query(f"WITH {_REFS} SELECT 'sp_' || id AS accession FROM refs")
def fasta_headers(spark: SparkSession, d: str) -> DataFrame:
    return fasta.header_ids(spark, _fasta_files(spark, d))


#: Files (folder, name) made of query_split: two names per record, with an ending by its last sign.
_ENDS = [*fasta.ENDINGS, *(f"{e}.gz" for e in fasta.ENDINGS), "txt"]
_BASE = "replace(regexp_replace(accession, '^accession_', ''), '|', '_')"
_FILES = f"""files AS (SELECT DISTINCT coalesce(nullif(lower(trim(source)), ''), 'none') AS folder, {_BASE} AS base, (ascii(right(accession, 1)) + k) % 9 AS p
        FROM query_split, (VALUES (0), (4)) t(k) WHERE accession IS NOT NULL AND {_BASE} <> '')"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "query_split").where("accession is not null").withColumn("k", F.explode(F.array(F.lit(0), F.lit(4))))
    ends = F.array(*[F.lit(e) for e in _ENDS])
    name = F.concat_ws(".", accession("accession"), F.element_at(ends, (F.ascii(F.right("accession", F.lit(1))) + F.col("k")) % 9 + 1))
    return rows.where(accession("accession") != "").select(F.coalesce(source_name("source"), F.lit("none")).alias("folder"), name.alias("name")).distinct()


@_query(f"WITH {_FILES}, e AS (SELECT unnest({_ENDS}) AS ending, unnest(range(9)) AS p) SELECT folder, base, base || '.' || ending AS name FROM files JOIN e USING (p) WHERE p < 8 QUALIFY row_number() OVER (PARTITION BY folder, base ORDER BY p) = 1")
def proteome_files(spark: SparkSession, d: str) -> DataFrame:
    """Of each folder and base name the file with the best ending."""
    return fasta.chosen_files(_files(spark, d))


@_query(f"WITH {_FILES}, n AS (SELECT folder, count(DISTINCT base) AS proteomes FROM files WHERE p < 8 GROUP BY 1) SELECT folder, proteomes, CASE WHEN proteomes < 10 THEN 'lt10' WHEN proteomes > 10 AND proteomes < 20 THEN 'gt10lt20' ELSE 'rest' END AS batch FROM n")
def proteome_batches(spark: SparkSession, d: str) -> DataFrame:
    return fasta.folder_batches(_files(spark, d))


@_query("SELECT 'test_20240506070809' AS folder, CAST(3 AS BIGINT) AS k, 'cosine' AS metric")
def experiment(spark: SparkSession, d: str) -> DataFrame:
    """The folder of a run with its effective settings, read again."""
    path = sinks.experiment_dir(spark, scratch(spark, "experiments"), "test", {"k": 3, "metric": "cosine"}, datetime(2024, 5, 6, 7, 8, 9))
    back = spark.read.json(f"{path}/config.json", multiLine=True, schema="k long, metric string")
    return back.select(F.lit(path.rpartition("/")[2]).alias("folder"), "k", "metric")


@_query("SELECT name AS prefix FROM embedding_type WHERE id % 2 = 0")
def not_yet_run(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "embedding_type")
    done = m.where("id % 2 = 1").select(F.concat("name", F.lit("_2024010100000"), F.col("id").cast("string")).alias("name"))
    return fasta.not_yet_run(m.select(F.col("name").alias("prefix")), done, "prefix")


@_query("SELECT 'run_2024010100000' || max(id) AS name FROM embedding_type")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "embedding_type").select(F.explode(F.array(F.lit("run"), F.lit("runner"))).alias("p"), "id")
    return sinks.latest_experiment(m.select(F.concat("p", F.lit("_2024010100000"), F.col("id").cast("string")).alias("name")), "run")


@_query("SELECT go_id, category, description FROM go_terms")
def reference_import(spark: SparkSession, d: str) -> DataFrame:
    """Tables copied once; the second import copies nothing."""
    target, source = scratch(spark, "import"), {"go_terms": f"{d}/go_terms.parquet"}
    again = raw_source.import_reference(spark, source, target) and raw_source.import_reference(spark, source, target)
    return spark.read.parquet(f"{target}/go_terms.parquet").where(F.lit(not again)).select("go_id", "category", "description")


@_query("SELECT go_id AS child, 'ROOT:' || upper(category) AS parent, 'is_a' AS relation FROM go_terms WHERE category IS NOT NULL AND go_id IS NOT NULL UNION SELECT go_id, 'X:1', 'part_of' FROM go_terms WHERE go_id IS NOT NULL AND category IS NULL")
def term_graph(spark: SparkSession, d: str) -> DataFrame:
    """The terms as stanzas of a term file, read as edges."""
    t = table(spark, d, "go_terms").where("go_id is not null")
    link = F.when(F.col("category").isNotNull(), F.concat(F.lit("is_a: ROOT:"), F.upper("category"), F.lit(" ! root"))).otherwise("relationship: part_of X:1 ! x")
    path = scratch(spark, "terms")
    t.select(F.concat(F.lit("[Term]\nid: "), F.col("go_id"), F.lit("\nname: some name\n"), link)).write.text(path, lineSep="\n\n")
    return raw_source.term_edges(spark, path).distinct()


# result files ----------------------------------------------------------------

_SHARD = ["accession", "model_name", "embedding_type_id", "layer_index", "go_id", "protein_id", "ref_idx", "distance", "reliability_index", "identity"]
_FLOATS = ("distance", "reliability_index", "identity")


def _results(spark: SparkSession, d: str) -> DataFrame:
    r = q._latest(spark, d, *[c for c in RAW.fieldNames()])
    clean = [letters(c).alias(c) if c.startswith("sequence_") else F.regexp_replace(c, r"[\r\n]", " ").alias(c) if t == "string" else F.col(c) for c, t in r.dtypes]
    return r.select(*clean).where("accession is not null")


@_query(f"WITH {s._RAW} SELECT {', '.join(f'CAST(round(CAST(CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS VARCHAR) AS DECIMAL(28, 18)), 4) AS DOUBLE) AS {c}' if c in _FLOATS else c for c in _SHARD)} FROM raw WHERE accession IS NOT NULL")
def csv_shards(spark: SparkSession, d: str) -> DataFrame:
    """Raw results written as CSV shards by model and layer with four decimals, and read with their fixed schema."""
    path = scratch(spark, "shards")
    sinks.write_raw(_results(spark, d), path, 4, "csv")
    back = raw_source.read_shards(spark, path)
    return back.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in _FLOATS else F.col(c) for c in _SHARD])


def _four_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "strict")
    table(spark, d, "go_terms").select("go_id", "category", "description").repartition(4).write.csv(path, header=True)
    return raw_source.read_strict(spark, path)


@_query("SELECT go_id, category, description FROM go_terms")
def merged_csv(spark: SparkSession, d: str) -> DataFrame:
    """Files with one header, merged into one table."""
    path = scratch(spark, "merged")
    sinks.write_merged(_four_files(spark, d), path)
    return spark.read.option("header", True).csv(path)


@_query("SELECT CAST(4 AS BIGINT) AS files, count(*) AS rows FROM go_terms")
def merged_totals(spark: SparkSession, d: str) -> DataFrame:
    return raw_source.merge_statistics(_four_files(spark, d)).where("total").select("files", "rows")


@_query(f"WITH {s._RAW}, s AS ({s._STATS}) SELECT accession, go_id, CAST(term_count AS VARCHAR) AS term_count, row_number() OVER (ORDER BY accession, go_id) - 1 AS idx FROM s")
def summary_file(spark: SparkSession, d: str) -> DataFrame:
    """The summary's parts in the order of their names hold the rows in the order of accession and term."""
    path = scratch(spark, "summary")
    sinks.write_summary(q.term_stats(spark, d), path)
    back = spark.read.option("header", True).csv(path).select("accession", "go_id", "term_count", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("n", F.monotonically_increasing_id())
    return annotate.dense_numbers(back, ["file", "block", "n"]).select("accession", "go_id", "term_count", "idx")


def _exported(spark: SparkSession, d: str) -> str:
    path, r = scratch(spark, "topgo"), q._latest(spark, d, *q._TOPGO)
    sinks.write_topgo(exports.topgo_per_model(r), exports.topgo_ensemble(r), path)
    return path


_TSV = "accession string, go_id string, reliability_index double"


@_query(f"WITH {s._RAW}, {s._TOPGO} SELECT DISTINCT * FROM topgo WHERE model_name IS NOT NULL")
def topgo_files(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.schema(f"{_TSV}, model_name string, layer string, category string").csv(f"{_exported(spark, d)}/topgo", sep="\t")


@_query(f"WITH {s._RAW}, {s._TOPGO} SELECT category, accession, go_id, max(reliability_index) AS reliability_index FROM topgo GROUP BY 1, 2, 3")
def topgo_ensemble_files(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.schema(f"{_TSV}, category string").csv(f"{_exported(spark, d)}/topgo_ensemble", sep="\t")


@_query(f"WITH {s._donors(0.5)} SELECT c.*, (SELECT count(*) FROM selected) AS rows_in_file, (SELECT count(*) FROM best) AS donors_in_file, (SELECT count(*) FROM keyed WHERE {s._IDENTITY} > 0.5) AS filtered_in_file FROM {s._counters(0.5)} c")
def leakage_files(spark: SparkSession, d: str) -> DataFrame:
    """The reports of one cutoff, read again: the counters and the rows of each file."""
    path = scratch(spark, "leakage")
    sinks.write_leakage(q._donor_rows(spark, d), path, 0.5)
    out = f"{path}/global_identity_le_{leakage.label(0.5)}"
    rows = lambda name: spark.read.option("header", True).csv(f"{out}/{name}").agg(F.count(F.lit(1))).first()[0]
    number = lambda name: F.lit(rows(name)).cast("long")
    counters = spark.read.json(f"{out}/summary")
    return counters.select("*", number("selected_rows").alias("rows_in_file"), number("selected_donors").alias("donors_in_file"), number("filtered_out_rows").alias("filtered_in_file"))


@_query(f"WITH {s._vectors()}, {s._BOTH} SELECT DISTINCT md5(s) AS cluster, identifier, side FROM both_sides")
def clusters_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "clusters")
    sinks.write_table(q._equal_clusters(spark, d), path, sep="\t")
    return spark.read.option("header", True).option("sep", "\t").csv(path)


@_query(f"WITH {s._ORDERED}, refs AS (SELECT s, row_number() OVER (ORDER BY first, s) - 1 AS idx FROM (SELECT {_SEQ} AS s, min(id) AS first FROM ref_sequences WHERE sequence IS NOT NULL GROUP BY 1)) SELECT 'Q' || idx AS identifier, sequence FROM idx UNION ALL SELECT 'R' || idx, s FROM refs")
def fasta_file(spark: SparkSession, d: str) -> DataFrame:
    """The numbered sequences of both sides as one FASTA, read again."""
    a = annotate.sequence_index(q._ordered_queries(spark, d), "sequence", "vec_id")
    b = annotate.sequence_index(table(spark, d, "ref_sequences").select("id", letters("sequence").alias("sequence")), "sequence", "id")
    path = scratch(spark, "sequences")
    sinks.write_fasta(a, b, path)
    return fasta.read(spark, path).select("identifier", "sequence")


@_query("SELECT * FROM (VALUES ('yeast', '1', 'm', '/a', '0', 'x.log'), ('worm', '2', 'm', '/b', '1', NULL)) t(organism, taxid, model, path, exit, log)")
def manifest(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "manifest")
    sinks.add_manifest(spark, path, {"organism": "yeast", "taxid": 1, "model": "m", "path": "/a", "exit": 0, "log": "x.log"})
    sinks.add_manifest(spark, path, {"organism": "worm", "taxid": 2, "model": "m", "path": "/b", "exit": 1})
    return spark.read.csv(path, sep="\t").toDF("organism", "taxid", "model", "path", "exit", "log")


# settings --------------------------------------------------------------------

#: Weights of (metric, aggregates) under an alias, and what must come of them.
_WEIGHTS = [
    ("metric_dict", {"ri": ("max", "mean")}, {"reliability_index": {"max": 0.4}}, {"max_ri": 1.0}),
    ("alias_dict", {"ri": ("max",)}, {"ri": {"max": 0.4}}, {"max_ri": 1.0}),
    ("avg_key", {"ri": ("mean",)}, {"reliability_index": {"avg": 0.3}}, {"mean_ri": 1.0}),
    ("falls_through", {"ri": ("max", "mean")}, {"reliability_index": {"max": 0.6}, "ri": 0.2}, {"max_ri": 0.75, "mean_ri": 0.25}),
    ("full_name_first", {"ri": ("max", "min")}, {"max_ri": 3, "reliability_index": 1}, {"max_ri": 0.75, "min_ri": 0.25}),
    ("zero_weight", {"ri": ("max", "min")}, {"max_ri": 0, "min_ri": 2}, {"max_ri": 0.0, "min_ri": 1.0}),
    ("all_zero", {"ri": ("max",)}, {"max_ri": 0}, {}),
    ("none", {"ri": ("max",)}, {}, {}),
    ("count", {"ri": ("max",)}, {"max_ri": 1, "count": 3}, {"max_ri": 0.25, "count": 0.75}),
]


@_query("SELECT * FROM (VALUES " + ", ".join(f"('{name}', '{c}', {w}::DOUBLE)" for name, _, _, out in _WEIGHTS for c, w in out.items()) + ") t(settings, output, weight)")
def weights_resolved(spark: SparkSession, d: str) -> DataFrame:
    rows = []
    for name, aggs, weights, _ in _WEIGHTS:
        active = Summary(metrics={"reliability_index": aggs["ri"]}, aliases={"reliability_index": "ri"}, weights=weights).active()
        rows += [(name, c, round(w, 9)) for c, w in active.items()]
    return spark.createDataFrame(rows, "settings string, output string, weight double")


_SETTINGS = {
    "threshold off": "None", "threshold 0": "None", "threshold ' Off '": "None", "threshold '0.5'": "0.5", "threshold -1": "None",
    "metric": "cosine", "k": "5", "precision": "2", "topgo": "False", "identity": "0.9", "coverage": "0.5", "threads": "8",
    "exclude": "1,2,30", "include": "7", "types": "A,C", "layers of A": "0,3", "device": "cpu", "length": "120", "only_lookup": "True",
    "both runs": "error", "identity 1.5": "error", "coverage 0": "error", "descendants": "error", "no model": "error", "taxa 1.5": "error", "url": "dump.backup",
}


@_query("SELECT * FROM (VALUES " + ", ".join(f"('{k.replace(chr(39), chr(39) * 2)}', '{v}')" for k, v in _SETTINGS.items()) + ") t(name, value)")
def settings_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Settings of a file, flags over them, old sections and flat keys, as they are resolved."""
    base = {"redundancy": {"coverage": 0.5, "identity": 0.1}, "lookup": {"distance_metric": "manhattan", "precision": 2, "topgo": "off", "redundancy": {"identity": 0.2}}}
    base |= {"embedding": {"models": {"A": {"enabled": True, "layer_index": [3, 0, 3]}, "B": {"enabled": False}, "C": {"enabled": "yes"}}}, "limit_per_entry": 1}
    flags = config.overrides(["--limit-per-entry", "5", "--redundancy_identity=0.9", "--threads", "8", "--taxonomy_ids_to_exclude", "1,2 030", "--device", "cpu", "--length_filter", "120", "--only_lookup"])
    conf = config.resolve(base | flags | {"taxonomy": {"include_only": 7}})
    look = conf["lookup"]

    def fails(**bad) -> str:
        try:
            config.resolve(base | bad)
        except ValueError:
            return "error"
        return "accepted"

    got = {f"threshold {x if isinstance(x, (int, float)) else repr(x) if x != 'off' else x}": str(config.threshold(x)) for x in ("off", 0, " Off ", "0.5", -1)}
    got |= {"metric": look["distance_metric"], "k": str(look["limit_per_entry"]), "precision": str(look["precision"]), "topgo": str(look["topgo"])}
    got |= {k: str(look["redundancy"][k]) for k in ("identity", "coverage", "threads")}
    got |= {"exclude": ",".join(look["taxonomy"]["exclude"]), "include": ",".join(look["taxonomy"]["include_only"]), "types": ",".join(conf["embedding"]["types"])}
    got |= {"layers of A": ",".join(map(str, config.models_of(conf)["A"])), "device": conf["embedding"]["device"], "length": str(conf["embedding"]["max_sequence_length"]), "only_lookup": str(conf["only_lookup"])}
    got |= {"both runs": fails(only_lookup=True, only_embedding="yes"), "identity 1.5": fails(redundancy_identity=1.5), "coverage 0": fails(alignment_coverage=0), "descendants": fails(get_descendants="true")}
    got |= {"no model": fails(embedding={"models": {"A": {}}}), "taxa 1.5": fails(taxonomy_ids_to_exclude=1.5), "url": config.url_name("https://x.org/files/dump.backup?download=1")}
    return spark.createDataFrame(list(got.items()), "name string, value string")


_YAML = """
prefix: sample
limit_execution: 20
embedding:
  models:
    Lumen-S: {enabled: true, layer_index: [0], distance_threshold: 0.5}
    Tessel-L: {enabled: true, layer_index: [1, 0], distance_threshold: false}
    Orbit-XS: {enabled: false}
lookup: {limit_per_entry: 3, taxonomy: {exclude: ["9100000"]}}
postprocess: {summary: {metrics: {identity: [avg]}, weights: {identity: 2, count: 2}, weighted_prefix: "v_"}}
"""


@_query("""SELECT * FROM (VALUES ('prefix', 'sample'), ('records', '20'), ('k', '3'), ('exclude', '9100000'), ('Lumen-S', '0 at 0.5'), ('Tessel-L', '0,1 at None'), ('mean_id', '0.5'), ('count', '0.5'), ('weighted', 'v_'),
    ('run', 'sample_20240506070809'), ('job 1', 'a.fa|out/a|--k 5'), ('job 2', 'b.fa|out/b|'), ('job 3', 'none')) t(name, value)""")
def run_settings(spark: SparkSession, d: str) -> DataFrame:
    """A settings file and a job list as they reach a run."""
    conf = config.loads(_YAML, {"prefix": None})
    post, limits = replace(config.summary_of(conf), aliases={"identity": "id"}), config.thresholds_of(conf)
    rows = [("prefix", conf["prefix"]), ("records", conf["limit_execution"]), ("k", conf["lookup"]["limit_per_entry"]), ("exclude", conf["lookup"]["taxonomy"]["exclude"][0])]
    rows += [(m, f"{','.join(map(str, ks))} at {limits[m]}") for m, ks in config.models_of(conf).items()]
    rows += [*post.active().items(), ("weighted", post.prefix), ("run", sinks.experiment_name(conf["prefix"], datetime(2024, 5, 6, 7, 8, 9)))]
    jobs = ["a.fa\tout/a\t--k 5\n", "b.fa\tout/b\n"]
    for n in (1, 2, 3):
        try:
            rows.append((f"job {n}", "|".join(fasta.parameters(iter(jobs), n))))
        except IndexError:
            rows.append((f"job {n}", "none"))
    return spark.createDataFrame([(k, str(v)) for k, v in rows], "name string, value string")


# preparation -----------------------------------------------------------------


@_query("""WITH RECURSIVE edges AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION ALL SELECT 'n3', 'r1'),
    below AS (SELECT 'r1' AS taxon UNION SELECT child FROM below JOIN edges ON parent = taxon) SELECT taxon FROM below""")
def taxon_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All below one root in a table of parents and children that holds a cycle."""
    n, m = table(spark, d, "nation"), table(spark, d, "supplier")
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    edges = n.select(name("r", "n_regionkey").alias("parent"), name("n", "n_nationkey").alias("child")).union(m.select(name("n", "s_nationkey"), name("s", "s_suppkey")))
    return taxonomy.descendants(edges.union(spark.createDataFrame([("n3", "r1")], "parent string, child string")), ["r1"])


_MEMBERS = f"""WITH {s._vectors()}, {s._BOTH}, c AS (SELECT DISTINCT md5(s) AS cluster, identifier, side FROM both_sides),
    one AS (SELECT min(identifier) AS a FROM c WHERE side = 'q' AND cluster IN (SELECT cluster FROM c WHERE side = 'r'))
    SELECT DISTINCT identifier, side FROM c WHERE cluster IN (SELECT cluster FROM c, one WHERE side = 'q' AND identifier = a)"""


@_query(_MEMBERS)
def cluster_members(spark: SparkSession, d: str) -> DataFrame:
    """Who shares a cluster with the first query that shares one with a reference."""
    c = q._equal_clusters(spark, d)
    shared = c.where("side = 'q'").join(c.where("side = 'r'").select("cluster"), "cluster", "left_semi")
    return redundancy.members(c, shared.agg(F.min("identifier")).first()[0] or "")


@_query(f"""WITH {s._vectors()}, {s._BOTH}, b AS (SELECT DISTINCT identifier, side, s FROM both_sides WHERE s <> '')
    SELECT count(*) AS members, count(DISTINCT s) AS texts, TRUE AS one_cluster_each, TRUE AS equal_together, TRUE AS match_their_representative FROM b""")
def clusters_checked(spark: SparkSession, d: str) -> DataFrame:
    """Whether every sequence is in one cluster, equal ones together, and every member matches the longest of its cluster."""
    t = pipeline.Tables.at(spark, d)
    both = prepare.all_sequences(t.sequences, t.queries).where("sequence != ''").withColumn("sid", F.xxhash64("sequence").cast("string"))
    c = materialise(redundancy.cluster(both, identity=0.9, coverage=0.7), "clusters")
    m = materialise(both.select("identifier", "side", "sid").distinct().join(c, ["identifier", "side"]), "members")
    texts = m.select("cluster", "sid").distinct()
    joined = materialise(texts.where("sid != cluster"), "joined")
    # sequences only of what is compared, each once
    compared = joined.select("sid").union(joined.select("cluster")).distinct()
    seqs = materialise(both.select("sid", "sequence").join(compared, "sid", "left_semi").groupBy("sid").agg(F.first("sequence").alias("sequence")), "compared")
    leads = texts.where("sid = cluster").join(seqs, "sid").select("cluster", F.col("sequence").alias("lead"))
    pairs = joined.join(seqs.withColumnRenamed("sequence", "member"), "sid").join(leads, "cluster", "left")
    pairs = spread(pairs, "sid").withColumn("m", local_alignment("member", "lead"))
    ok = (F.col("m.identity_sw") >= 0.9) & (F.col("m.alignment_length_sw") * (1 - F.col("m.gaps_percentage_sw")) >= 0.7 * F.length("member"))
    bad = pairs.where(~F.coalesce(ok, F.lit(False))).agg(F.count(F.lit(1)).alias("bad"))
    per = c.groupBy("identifier", "side").agg(F.countDistinct("cluster").alias("n")).agg((F.max("n") == 1).alias("one_cluster_each"))
    equal = m.groupBy("sid").agg(F.countDistinct("cluster").alias("n")).agg((F.max("n") == 1).alias("equal_together"), F.count(F.lit(1)).alias("texts"))
    one = lambda df: df.withColumn("_", F.lit(1))
    out = one(m.agg(F.count(F.lit(1)).alias("members"))).join(one(per), "_").join(one(equal), "_").join(one(bad), "_")
    return out.select("members", "texts", "one_cluster_each", "equal_together", (F.col("bad") == 0).alias("match_their_representative"))


@_query(f"WITH {s._vectors()} SELECT sequence_id, len(re) AS dimension FROM rv WHERE layer_index IS NULL")
def reference_legacy_layer(spark: SparkSession, d: str) -> DataFrame:
    """Reference vectors of a model that has none but the layer without a number."""
    t = pipeline.Tables.at(spark, d)
    refs = reference.reference_vectors(t.references, t.sequences, t.proteins)
    models = [r["id"] for r in table(spark, d, "embedding_type").select("id").distinct().collect()]  # the few models
    parts = [reference.by_layer(refs, m, None) for m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("sequence_id", F.size("embedding").cast("long").alias("dimension"))


_TASKS = f"""tasks AS (SELECT DISTINCT CAST(id AS VARCHAR) AS accession, {_SEQ} AS sequence FROM ref_sequences WHERE id IS NOT NULL AND sequence IS NOT NULL)"""


def _made(spark: SparkSession, d: str) -> DataFrame:
    """Vectors (length, layer, number of A) of every reference sequence under two models."""
    models = prepare.enabled_models(table(spark, d, "embedding_type"), {"lumen-s": [0], "TESSEL-L": [1, 0, 1]})
    seqs = table(spark, d, "ref_sequences").select(F.col("id").cast("string").alias("accession"), letters("sequence").alias("sequence")).distinct()
    maker = lambda: lambda texts, layer: np.array([[len(t), layer, t.count("A")] for t in texts], dtype=np.float32)
    return prepare.checked_tasks(embed.embed(prepare.tasks(seqs, models), makers={m: maker for m in ("Lumen-S", "Tessel-L")}))


@_query(f"""WITH {_TASKS} SELECT accession, e.id AS embedding_type_id, k AS layer_index, length(sequence)::DOUBLE AS length, k::DOUBLE AS layer, (length(sequence) - length(replace(sequence, 'A', '')))::DOUBLE AS count_a
    FROM tasks CROSS JOIN (VALUES ('lumen-s', 0), ('tessel-l', 0), ('tessel-l', 1)) l(n, k) JOIN embedding_type e ON lower(trim(e.name)) = n""")
def embedded_vectors(spark: SparkSession, d: str) -> DataFrame:
    """A plug-in model over all tasks: vectors keep their row's metadata and their layer."""
    v = _made(spark, d)
    return v.select("accession", "embedding_type_id", "layer_index", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(("length", "layer", "count_a"))])


@_query(f"""WITH {_TASKS}, first AS (SELECT accession, min(sequence) AS sequence FROM tasks GROUP BY 1)
    SELECT accession, e.id AS embedding_type_id, k AS layer_index, length(sequence) AS stored FROM first CROSS JOIN (VALUES ('lumen-s', 0), ('tessel-l', 0), ('tessel-l', 1)) l(n, k) JOIN embedding_type e ON lower(trim(e.name)) = n""")
def stored_vectors(spark: SparkSession, d: str) -> DataFrame:
    """What is stored first stays: two deliveries, the second with other vectors for the same keys."""
    path = scratch(spark, "vectors")
    sinks.write_vectors(_made(spark, d), path, "sequence")
    sinks.write_vectors(_made(spark, d).withColumn("embedding", F.array(F.lit(-1.0).cast("float"))), path, "sequence")
    return spark.read.parquet(path).select("accession", "embedding_type_id", "layer_index", F.col("embedding")[0].cast("long").alias("stored"))


@_query("SELECT count(*) AS sequences, CAST(ceil(count(*) / 100) AS BIGINT) AS batches_wanted, TRUE AS all_within FROM (SELECT DISTINCT id FROM ref_sequences WHERE id IS NOT NULL)")
def queue_batches(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "ref_sequences").where("id is not null").select(F.col("id").cast("string").alias("accession")).distinct()
    n = F.ceil(F.count(F.lit(1)) / 100).cast("long")
    return search.sequence_batches(ids, 100).agg(F.count(F.lit(1)).alias("sequences"), n.alias("batches_wanted"), (F.max("batch") < n).alias("all_within"))


@_query(f"WITH {s._knn(2)} {s._HITS}")
def stream_hits(spark: SparkSession, d: str) -> DataFrame:
    """Search over a stream of query files, as it comes out after all of them."""
    t = pipeline.Tables.at(spark, d)
    refs = reference.reference_vectors(t.references, t.sequences, t.proteins)
    path = scratch(spark, "stream")
    t.queries.select("accession", "sequence", "embedding_type_id", "layer_index", "embedding").repartition(3).write.parquet(f"{path}/in")
    search.search_stream(search.vector_stream(spark, f"{path}/in", files_per_batch=2), refs, f"{path}/out", f"{path}/checkpoint", k=2).awaitTermination()
    return q._hits(spark.read.parquet(f"{path}/out"))


# alignment -------------------------------------------------------------------

_M = matrix()
#: Substitution scores as one list, by 27 times the first letter's number plus the second's.
_BLOSUM = "[" + ", ".join(str(int(x)) for x in _M.ravel()) + "]"


def _score(kind: str) -> str:
    """Scores of all pairs by the textbook recurrences, one cell after the other; rows of h and e are lists."""
    local = kind == "local"
    floor_ = "0, " if local else ""
    edge = lambda n: "0" if local else f"CASE WHEN {n} = 0 THEN 0 ELSE -({OPEN} + ({n} - 1) * {EXTEND}) END"
    start = f"list_transform(range(0, m + 1), lambda x: {edge('x')})"
    sub = f"{_BLOSUM}[27 * (ascii(a[i]) - 65) + ascii(b[j]) - 65 + 1]"
    return f"""{kind}(a, b, n, m, i, j, above, e, row, f, best) AS (
        SELECT a, b, n, m, 1, 1, {start}, list_transform(range(0, m + 1), lambda x: -100000), [{edge('1')}], -100000, 0 FROM pairs
        UNION ALL
        SELECT a, b, n, m, CASE WHEN j = m THEN i + 1 ELSE i END, CASE WHEN j = m THEN 1 ELSE j + 1 END,
          CASE WHEN j = m THEN list_append(row, h) ELSE above END, list_concat(list_concat(e[1:j], [ev]), e[j + 2:]), CASE WHEN j = m THEN [{edge('(i + 1)')}] ELSE list_append(row, h) END, CASE WHEN j = m THEN -100000 ELSE fv END, greatest(best, h)
        FROM (SELECT *, greatest({floor_}above[j] + {sub}, ev, fv) AS h FROM (SELECT *, greatest(e[j + 1] - {EXTEND}, above[j + 1] - {OPEN}) AS ev, greatest(f - {EXTEND}, row[j] - {OPEN}) AS fv FROM {kind} WHERE i <= n)))"""


@_query(f"""WITH RECURSIVE w AS (SELECT DISTINCT lang, upper(regexp_replace(word, '[^A-Za-z]', '', 'g')) AS t FROM common_words WHERE word IS NOT NULL), pairs AS (SELECT DISTINCT x.t AS a, y.t AS b, length(x.t) AS n, length(y.t) AS m FROM w x JOIN w y ON x.lang = y.lang WHERE x.t <> '' AND y.t <> ''),
    {_score("whole")}, {_score("local")}
    SELECT g.a AS query, g.b AS reference, g.above[g.m + 1]::DOUBLE AS alignment_score, l.best::DOUBLE AS alignment_score_sw, g.n AS length_query, g.m AS length_reference, TRUE AS shares_add_up
    FROM (SELECT * FROM whole WHERE i > n) g JOIN (SELECT * FROM local WHERE i > n) l ON l.a = g.a AND l.b = g.b""")
def alignment_scores(spark: SparkSession, d: str) -> DataFrame:
    """Global and local scores of all pairs of common words of a language, and whether lengths and shares fit together."""
    w = table(spark, d, "common_words").where("word is not null").select("lang", letters("word").alias("t")).where("t != ''").distinct()
    pairs = w.select("lang", F.col("t").alias("sequence_query")).join(w.select("lang", F.col("t").alias("sequence_reference")), "lang").drop("lang").distinct()
    number = lambda c: F.xxhash64(c)
    m = annotate.aligned(pairs.withColumn("query_idx", number("sequence_query")).withColumn("ref_idx", number("sequence_reference")))
    n, r, size = F.length("sequence_query"), F.length("sequence_reference"), F.col("alignment_length")
    fits: Column = (F.round(2 * size) == n + r + F.round(F.col("gaps_percentage") * size)) & (F.col("identity") <= F.col("similarity")) & (F.col("similarity") + F.col("gaps_percentage") <= 1 + 1e-9) & (F.col("alignment_length_sw") <= n + r)
    return m.select(F.col("sequence_query").alias("query"), F.col("sequence_reference").alias("reference"), "alignment_score", "alignment_score_sw", F.col("length_query").cast("long").alias("length_query"), F.col("length_reference").cast("long").alias("length_reference"), fits.alias("shares_add_up"))
