"""Whole runs, sinks and the stream, on the smallest tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from annoweave import schema
from annoweave.config import Summary
from annoweave.operators import embed, knn
from annoweave.plans import pipeline
from annoweave.sources import raw as raw_source, sinks
from annoweave.streaming import search

from .conftest import DATA


def test_lookup_run(spark, tmp_path):
    t = pipeline.Tables.at(spark, DATA)
    conf = pipeline.Lookup(k=1, exclude=["9100000"], redundancy_identity=0.9)
    for _ in range(2):  # a repeated run repeats nothing
        pipeline.run(t, str(tmp_path), conf, Summary(k=1), only_lookup=True)
    raw = spark.read.parquet(f"{tmp_path}/raw_results")
    assert set(schema.RAW.fieldNames()) <= set(raw.columns) and raw.count() > 0
    bad = t.proteins.where("trim(taxonomy_id) = '9100000'").select(F.col("id").alias("protein_id"))
    assert raw.join(bad, "protein_id", "left_semi").isEmpty()
    assert raw.where("identity < 0 or identity > 1 or (identity is null) != (sequence_query is null or sequence_reference is null)").isEmpty()
    assert raw.where("abs(reliability_index + distance - 1) > 0.0002").isEmpty()
    summary = spark.read.option("header", True).csv(f"{tmp_path}/summary")
    assert summary.count() == raw.select("accession", "go_id").distinct().count()
    assert spark.read.option("sep", "\t").csv(f"{tmp_path}/topgo_ensemble").count() == raw.where("category is not null").select("accession", "go_id", "category").distinct().count()


def test_embedding_run(spark, tmp_path):
    t = pipeline.Tables.at(spark, DATA)
    t.models = spark.createDataFrame([(9, "composition", "x")], "id int, name string, model_name string")
    seqs = t.queries.where("sequence is not null").select("accession").distinct().count()
    for _ in range(2):
        pipeline.run(t, str(tmp_path), pipeline.Lookup(), Summary(), models={"Composition": [0, 2]}, only_embedding=True, max_length=100)
    out = spark.read.parquet(f"{tmp_path}/vectors")
    assert out.count() == 2 * seqs and out.where("length(sequence) > 100").isEmpty()
    with pytest.raises(ValueError):
        pipeline.run(t, str(tmp_path), pipeline.Lookup(), Summary(), only_lookup=True, only_embedding=True)


def test_command_line(spark, tmp_path, capsys):
    """From FASTA and a settings file to every output, then the commands on its files."""
    from annoweave import cli

    t = pipeline.Tables.at(spark, DATA)
    ref = tmp_path / "reference"
    tables = ["initialize", "--embeddings_url", DATA, "--base_directory", str(tmp_path), "--tables", "ref_sequences,protein,protein_go_term_annotation,go_terms"]
    assert cli.main(["initialize"], spark) == 0 and "nothing to do" in capsys.readouterr().out
    assert cli.main(tables, spark) == 0 and "copied" in capsys.readouterr().out
    assert cli.main(tables, spark) == 0 and "there already" in capsys.readouterr().out
    models = spark.createDataFrame([(9, "composition", "x")], "id int, name string, model_name string")
    models.write.parquet(str(ref / "embedding_type.parquet"))
    seqs = t.sequences.where("id is not null and sequence is not null").groupBy("id").agg(F.min("sequence").alias("sequence")).withColumn("accession", F.col("id").cast("string"))
    vectors = embed.embed(seqs.select("accession", "sequence", F.lit(9).alias("embedding_type_id"), F.lit("composition").alias("model_name"), F.lit(0).alias("layer_index")))
    vectors.select(F.col("accession").cast("long").alias("sequence_id"), "embedding_type_id", "layer_index", "embedding").write.parquet(str(ref / "reference_embedding.parquet"))
    lines = [f">q|{r['id']} some text\n{r['sequence']}" for r in seqs.orderBy("id").limit(12).collect()]
    (tmp_path / "in.fa").write_text("\n".join([*lines, lines[0].replace("\n", "\nW"), ""]))
    (tmp_path / "c.yaml").write_text(f"base_directory: {tmp_path}\ninput: {tmp_path}/in.fa\nembedding: {{models: {{Composition: {{enabled: true, layer_index: [0]}}}}}}\nlookup: {{redundancy: {{identity: 0}}}}\n")
    assert cli.main(["run", "--config", str(tmp_path / "c.yaml"), "--prefix", "x", "--limit-per-entry", "2", "--redundancy_identity", "0.95"], spark) == 0
    out = capsys.readouterr().out.strip().splitlines()[-1]
    raw = spark.read.parquet(f"{out}/raw_results")
    assert raw.count() > 0 and raw.where("identity is null").isEmpty()
    assert spark.read.parquet(f"{out}/vectors").count() == 12  # the second record of an accession is not stored
    for name in ("summary", "clusters", "sequences", "query_index_mapping", "topgo_ensemble"):
        assert spark.read.text(f"{out}/{name}").count() > 0
    assert cli.main(["coverage", "--input", f"{tmp_path}/in.fa", "--embeddings", f"{out}/vectors", "--output", f"{tmp_path}/cov"], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"total": 12, "embedded": 12, "missing": 0}
    raw.coalesce(2).write.csv(f"{tmp_path}/shards", header=True)
    assert cli.main(["merge", f"{tmp_path}/shards", "-o", f"{tmp_path}/merged", "--add-source-file"], spark) == 0
    assert cli.main(["leakage", f"{tmp_path}/shards", "--threshold", "0.5", "--output-dir", f"{tmp_path}/leak"], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["input_rows"] == raw.count()
    assert cli.main(["run", "--config", str(tmp_path / "c.yaml"), "--only_lookup", "--only_embedding"], spark) == 1


def test_first_stored_vector_wins(spark):
    rows = [("a|b", 1, 0, [2.0, 0.0], "AC D", 2, 7), ("a_b", 1, 0, [1.0, 0.0], "EEE", 3, 1), ("a_b", 1, 0, None, "FFF", 1, 1), ("accession_a|b", 1, None, [5.0, 5.0], None, 1, 9)]
    df = spark.createDataFrame(rows, "accession string, embedding_type_id int, layer_index int, embedding array<float>, sequence string, at int, vec_id long").withColumn("created_at", F.timestamp_seconds("at"))
    got = {(r["accession"], r["layer_index"]): (r["embedding"], r["sequence"]) for r in pipeline.first_stored(df).collect()}
    assert got == {("a_b", 0): ([2.0, 0.0], "ACD"), ("a_b", None): ([5.0, 5.0], None)}


def test_stream_equals_batch(spark, tmp_path):
    t = pipeline.Tables.at(spark, DATA)
    q = t.queries.select("accession", F.coalesce("sequence", F.lit("")).alias("sequence"), "embedding_type_id", "layer_index", "embedding")
    q.repartition(5).write.parquet(f"{tmp_path}/in")
    stream = search.vector_stream(spark, f"{tmp_path}/in", files_per_batch=2)
    search.search_stream(stream, t.references, f"{tmp_path}/out", f"{tmp_path}/cp", k=2).awaitTermination(120)
    cols = ["accession", "ref_sequence_id", "embedding_type_id", "layer_index"]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.select("batch").distinct().count() > 1
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, knn.blocked(q, t.references, 2).select(cols).collect()))
    assert search.sequence_batches(q, 10).select("batch").distinct().count() > 1


def test_hdf5_tree():
    """Which nodes of a tree are vectors; the library itself is optional."""
    from annoweave.sources import hdf5

    class Leaf:
        shape = ()

        def __init__(self, value):
            self.value = value

        def __getitem__(self, _):
            return self.value

    v = {"embedding": Leaf([1.0, 2.0])}
    tree = {"accession_a_b": {"sequence": Leaf(b"ACD"), "type_1": {"layer_0": v, "layer_x": v, "layer_2": {}}, "type_y": {"layer_0": v}, "type_2": v, "note": {}}, "accession_c": {"type_1": {"layer_0": v}}}
    assert list(hdf5.vectors(tree)) == [("a_b", "ACD", 1, 0, [1.0, 2.0]), ("a_b", "ACD", 2, None, [1.0, 2.0])]


def test_working_tables_can_go_early(spark):
    from annoweave.runtime import free, materialise

    t = materialise(spark.range(10))
    assert t.count() == 10
    free(t)
    with pytest.raises(Exception):
        t.count()


def test_import_is_done_once(spark, tmp_path):
    source = {"go_terms": f"{DATA}/go_terms.parquet"}
    assert raw_source.import_reference(spark, source, str(tmp_path))
    assert not raw_source.import_reference(spark, source, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/go_terms.parquet").count() > 0


def test_small_sinks(spark, tmp_path):
    path = sinks.experiment_dir(spark, str(tmp_path), "run", {"k": 1}, datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("run_20240506070809")
    with open(f"{path}/config.json") as f:
        assert json.load(f) == {"k": 1}
    for n in range(2):
        sinks.add_manifest(spark, f"{tmp_path}/manifest", {"organism": "o", "exit": n})
    assert spark.read.csv(f"{tmp_path}/manifest", sep="\t").count() == 2
    idx = spark.createDataFrame([("ACD", 0), ("EFG", 1)], "sequence string, idx long")
    sinks.write_fasta(idx, idx, f"{tmp_path}/fasta")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/fasta").collect()] == [">Q0", "ACD", ">Q1", "EFG", ">R0", "ACD", ">R1", "EFG"]
    raw = spark.createDataFrame([("a", "My Model/1", None, 0.123456)], "accession string, model_name string, layer_index long, distance double")
    sinks.write_raw(raw, f"{tmp_path}/raw", 3, "csv")
    got = spark.read.option("header", True).csv(f"{tmp_path}/raw").first()
    assert got["model"] == "my_model_1" and got["layer"] == "legacy" and got["distance"] == "0.123"


def test_plans_push_down(spark):
    """Scans read only the columns that a query needs, with its filters pushed to them."""
    from annoweave.plans.queries import queries

    plan = queries()["leakage_filtered"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "identity_sw" not in plan and "sequence_query" not in plan
    plan = queries()["annotation_join"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sequence_id)" in plan and "CartesianProduct" not in plan
