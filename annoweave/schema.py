"""Schemas of the tables that the engine reads and makes."""

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "array<float>": T.ArrayType(T.FloatType())}


def _of(text: str) -> T.StructType:
    """A flat schema from ``name type, ...``; needs no session, unlike a DDL string."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])


QUERY_VECTORS = _of("accession string, sequence string, embedding_type_id int, layer_index int, embedding array<float>")
REFERENCE_VECTORS = _of("sequence_id bigint, embedding_type_id int, layer_index int, embedding array<float>")
SEQUENCES = _of("id bigint, sequence string")
PROTEINS = _of("id string, sequence_id bigint, organism string, taxonomy_id string, gene_name string")
ANNOTATIONS = _of("protein_id string, go_id string, evidence_code string")
TERMS = _of("go_id string, category string, description string")
MODELS = _of("id int, name string, model_name string")
CLUSTERS = _of("cluster string, identifier string, side string")
HITS = _of("accession string, ref_sequence_id bigint, distance double, model_name string, embedding_type_id bigint, layer_index bigint")
#: The columns of a raw result, in the order in which they are written.
RAW = _of(
    "accession string, model_name string, embedding_type_id bigint, layer_index bigint, distance double, go_id string, category string, "
    "evidence_code string, go_description string, protein_id string, organism string, gene_name string, query_idx bigint, ref_idx bigint, "
    "query_len bigint, ref_len bigint, sequence_query string, sequence_reference string, reliability_index double, identity double, "
    "similarity double, alignment_score double, gaps_percentage double, alignment_length double, length_query int, length_reference int, "
    "identity_sw double, similarity_sw double, alignment_score_sw double, gaps_percentage_sw double, alignment_length_sw double, "
    "distance_metric string, distance_threshold double"
)
#: The twelve metrics of an alignment.
METRICS = _of(
    "identity double, similarity double, alignment_score double, gaps_percentage double, alignment_length double, identity_sw double, similarity_sw double, "
    "alignment_score_sw double, gaps_percentage_sw double, alignment_length_sw double, length_query int, length_reference int"
)
