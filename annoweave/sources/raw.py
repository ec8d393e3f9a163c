"""Raw result sources: CSV shards with a fixed schema, merging, term graph, reference import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoweave import schema


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All CSV shards below ``path`` with the fixed schema; unreadable fields are null, NA stays text."""
    return spark.read.schema(schema.RAW).option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("mode", "PERMISSIVE").option("nullValue", "").csv(path)


def read_strict(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV files (or folders of them) that must share one header, as text columns, with ``source_file``.

    The first lines of all files are compared in one job. An empty file has no
    header and is skipped; a differing one stops the read.
    """
    lines = spark.read.text(paths, pathGlobFilter="*.csv").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    first = lines.where("block = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "n").alias("head"))
    heads = first.groupBy("head").agg(F.min("path").alias("path")).orderBy("path").limit(11).collect()
    if len(heads) > 1:
        raise ValueError(f"other columns than {heads[0]['path']} has: {', '.join(h['path'] for h in heads[1:])}")
    if not heads:
        return spark.createDataFrame([], "source_file string")
    read = spark.read.option("header", True).option("escape", '"').option("pathGlobFilter", "*.csv").csv(paths)
    return read.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def union(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge_statistics(df: DataFrame) -> DataFrame:
    """Rows per source file, and of all as the row without a name: files and rows."""
    per = df.groupBy("source_file").agg(F.lit(1).cast("long").alias("files"), F.count(F.lit(1)).alias("rows"), F.lit(False).alias("total"))
    whole = per.agg(F.count("source_file").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return per.unionByName(whole.select(F.lit(None).cast("string").alias("source_file"), "files", "rows", F.lit(True).alias("total")))


def casts(df: DataFrame) -> DataFrame:
    """Numeric columns of raw results in their types; what cannot be read is null."""
    types = {f.name: f.dataType.simpleString() for f in schema.RAW.fields}
    return df.select(*[F.expr(f"try_cast(`{c}` as {types[c]})").alias(c) if c in types else F.col(c) for c in df.columns])


def term_edges(spark: SparkSession, path: str) -> DataFrame:
    """(child, parent, relation) of a term file in stanzas, obsolete terms left out."""
    stanza = spark.read.text(path, lineSep="\n\n").where(F.col("value").rlike(r"(^|\n)\[Term\]") & ~F.col("value").rlike(r"\nis_obsolete: true"))
    child = F.regexp_extract("value", r"\nid: (\S+)", 1)
    links = F.transform(F.regexp_extract_all("value", F.lit(r"\n((?:is_a|relationship): [^\n!]+)"), 1), lambda x: F.split(F.trim(F.regexp_replace(x, "^relationship: ", "")), r"[: ]+", 2))
    out = stanza.select(child.alias("child"), F.explode(links).alias("l")).select("child", F.trim(F.element_at("l", 2)).alias("parent"), F.element_at("l", 1).alias("relation"))
    return out.where("child != ''")


def import_reference(spark: SparkSession, source: dict[str, str], target: str, overwrite: bool = False) -> bool:
    """Copies reference tables into parquet under ``target``; True if anything was copied.

    ``source`` maps table names to parquet paths, or holds ``url`` (and further
    JDBC options) with ``tables`` as a comma-separated list; a table written as
    ``name:column:lowest:highest:parts`` is read in so many ranges of that column
    at once, else by one connection. Tables that are there already stay, unless
    ``overwrite``.
    """
    jdbc = {k: v for k, v in source.items() if k != "tables"} if "url" in source else None
    names = [t.strip() for t in source.get("tables", "").split(",") if t.strip()] if jdbc else list(source)
    copied = False
    for name in names:
        name, *ranges = name.split(":")
        out = f"{target}/{name}.parquet"
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_SUCCESS")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and not overwrite:
            continue
        split = dict(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), ranges))
        df = spark.read.format("jdbc").options(**jdbc, dbtable=name, **split).load() if jdbc else spark.read.parquet(source[name])
        df.write.mode("overwrite").parquet(out)
        copied = True
    return copied
