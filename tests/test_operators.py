"""Operators on small tables: the traps of the semantics, one by one."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annoweave.config import Summary
from annoweave.functions import align as A
from annoweave.operators import annotate, collapse, coverage, embed, exports, knn, leakage, prepare, redundancy, reference, summary, taxonomy
from annoweave.plans import pipeline, queries
from annoweave.runtime import CLEANUP, materialise, shared_dir
from annoweave.sources import fasta, raw as raw_source, sinks

from .conftest import DATA

Q = "accession string, embedding_type_id int, layer_index int, embedding array<float>"
R = "sequence_id long, embedding_type_id int, layer_index int, embedding array<float>"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(3)
    v = lambda: [rng.gauss(0, 1) for _ in range(8)]
    same = v()
    q = [(f"q{i}", 1 + i % 2, [0, 1, None][i % 3], v()) for i in range(40)] + [("tie", 1, 0, same), ("zero", 1, 0, [0.0] * 8), ("nan", 1, 0, [float("nan")] * 8), ("null", 1, 0, None), ("short", 1, 0, [1.0, 2.0])]
    r = [(i, 1 + i % 2, [0, 1, None][i % 3], v()) for i in range(90)] + [(200 + i, 1, 0, same) for i in range(5)] + [(300, 1, 0, [0.0] * 8), (301, 1, 0, None)]
    return spark.createDataFrame(q, Q), spark.createDataFrame(r, R)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("threshold", [None, 0.9])
@pytest.mark.parametrize("k", [1, 3, 200])
def test_knn_paths_agree(vectors, monkeypatch, metric, threshold, k):
    q, r = vectors
    cols = ["accession", "ref_sequence_id", "embedding_type_id", "layer_index"]
    expected = rows(knn.declarative(q, r, k, metric, threshold), *cols)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 7)
    monkeypatch.setattr(knn, "REFERENCE_BLOCK", 5)
    assert rows(knn.blocked(q, r, k, metric, threshold), *cols) == expected
    names = {x[0] for x in expected}
    assert not names & {"zero", "nan", "null", "short"}
    if k == 3:
        assert [x[1] for x in expected if x[0] == "tie"] == [200, 201, 202]


def test_knn_masks_and_empty(spark, vectors):
    q, r = vectors
    masked = spark.createDataFrame([("tie", 200), ("tie", 202), ("q0", 5), (None, 1), ("q1", None)], "accession string, ref_sequence_id long")
    cols = ["accession", "ref_sequence_id", "layer_index"]
    got = rows(knn.blocked(q, r, 2, masked=masked), *cols)
    assert got == rows(knn.declarative(q, r, 2, masked=masked), *cols)
    assert [x[1] for x in got if x[0] == "tie"] == [201, 203]
    assert knn.blocked(q, r, 0).count() == 0 and knn.blocked(q, r.limit(0), 3).count() == 0 and knn.blocked(q.limit(0), r, 3).count() == 0


def test_declarative_multiplies_blocks(spark, monkeypatch):
    """Pairs of vectors are products of blocks, never rows of a join with interpreted array functions."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(150, 64)).astype(np.float32), rng.normal(size=(400, 64)).astype(np.float32)
    q = spark.createDataFrame([(f"q{i:03}", 1, 0, x.tolist()) for i, x in enumerate(a)], Q)
    r = spark.createDataFrame([(i, 1, 0, x.tolist()) for i, x in enumerate(b)], R)
    unit = lambda x: x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    d = np.round(1 - unit(a) @ unit(b).T, 10)
    want = {(f"q{i:03}", int(j)) for i in range(150) for j in np.lexsort((np.arange(400), d[i]))[:3]}
    plan = knn.declarative(q, r, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan
    for blocks in ((4096, 8192), (32, 64)):
        monkeypatch.setattr(knn, "QUERY_BLOCK", blocks[0])
        monkeypatch.setattr(knn, "REFERENCE_BLOCK", blocks[1])
        for search in (knn.declarative, knn.blocked):
            got = search(q, r, 3).collect()
            assert {(x.accession, x.ref_sequence_id) for x in got} == want and len(got) == 450


def test_search_shuffles_each_side_once(spark, monkeypatch):
    """Shuffles of a masked search do not grow with the number of blocks."""
    rng = np.random.default_rng(6)
    side = lambda n, name: [(name(i), 1, 0, x.tolist()) for i, x in enumerate(rng.normal(size=(n, 64)))]
    q, r = materialise(spark.createDataFrame(side(300, lambda i: f"q{i}"), Q)), materialise(spark.createDataFrame(side(300, lambda i: i), R))
    masked = materialise(spark.createDataFrame([(f"q{i}", i) for i in range(300)], "accession string, ref_sequence_id long"))
    sc = spark.sparkContext._jsc.sc()

    def written() -> int:
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    def search() -> tuple[int, list]:
        before = written()
        hits = rows(knn.blocked(q, r, 2, masked=masked), "accession", "ref_sequence_id")
        return written() - before, hits

    few, expected = search()
    monkeypatch.setattr(knn, "QUERY_BLOCK", 20)
    monkeypatch.setattr(knn, "REFERENCE_BLOCK", 20)
    many, hits = search()
    assert few > 0 and many < 2 * few
    assert hits == expected and not {(a, i) for a, i in hits if a == f"q{i}"}


def test_masked_search_in_steps(spark, vectors, monkeypatch):
    """No step of a masked search keeps the files of those before it, nothing but its hits stays, and the mask is made once."""
    q, r = vectors
    local = [str(x) for x in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in local for f in Path(d).rglob("shuffle_*.data")}
    tables = lambda: {f.name for f in Path(shared_dir(spark).removeprefix("file:")).glob("work-*/*")}
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    masked = materialise(spark.createDataFrame([("tie", 200), ("tie", 202), ("q0", 5)], "accession string, ref_sequence_id long"))
    shuffled, stored, kept = files(), tables(), []
    steps = knn.materialise
    monkeypatch.setattr(knn, "materialise", lambda df, label: (kept.append(files() - shuffled), steps(df, label))[1])
    hits = knn.blocked(q, r, 2, masked=masked.mapInPandas(count, masked.schema))
    got = rows(hits, "accession", "ref_sequence_id")
    assert len(kept) > 3 and not any(kept) and not files() - shuffled
    assert [x.split("-")[0] for x in tables() - stored] == ["hits"] and made.value == 3
    assert [x[1] for x in got if x[0] == "tie"] == [201, 203]


def test_search_shuffles_no_vectors_for_counts(spark, vectors):
    plan = knn.blocked(*vectors, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2


def test_taxonomy_sides(spark):
    p = spark.createDataFrame([(1, "10"), (1, "20"), (2, None), (3, " 10 "), (4, "30")], "sequence_id long, taxonomy_id string")
    ids = lambda e, i: [x[0] for x in rows(taxonomy.allowed_sequences(p, e, i), "sequence_id")]
    assert ids([], []) == [1, 2, 3, 4]
    assert ids(["10"], []) == [1, 4]
    assert ids([], ["10"]) == [1, 3]
    assert ids(["10"], ["10", "20"]) == [1]
    t = F.trim("taxonomy_id")
    keep = lambda e, i: [x for x, in rows(p.where(taxonomy.allowed_annotation(t, e, i)).select(F.coalesce("taxonomy_id", F.lit("-")).alias("x")), "x")]
    assert keep(["10"], []) == ["-", "20", "30"]
    assert keep(["10"], ["10", "20"]) == ["20"]


def test_descendants(spark):
    edges = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "1"), ("2", "4"), ("9", "8"), (None, "5"), ("4", None)], "parent string, child string")
    assert [x for x, in rows(taxonomy.descendants(edges, ["2"]), "taxon")] == ["1", "2", "3", "4"]
    assert [x for x, in rows(taxonomy.descendants(edges, ["2"], False), "taxon")] == ["1", "3", "4"]


def test_annotations_fan_out(spark):
    p = spark.createDataFrame([("p1", 1, "o", "1", "g"), ("p2", 1, "o", None, None), ("p2", 1, "o", None, None), ("p3", None, "o", "1", "g")], "id string, sequence_id long, organism string, taxonomy_id string, gene_name string")
    a = spark.createDataFrame([("p1", "t1", "ida"), ("p1", "t1", "IDA"), ("p1", "t2", "IEA"), ("p2", "t1", "IDA"), ("p1", "gone", "IDA"), ("p3", "t1", "IDA")], "protein_id string, go_id string, evidence_code string")
    t = spark.createDataFrame([("t1", "bp", "x"), ("t2", None, "y")], "go_id string, category string, description string")
    out = reference.annotations(p, a, t)
    assert rows(out, "protein_id", "go_id", "category") == [("p1", "t1", "BP"), ("p1", "t2", None), ("p2", "t1", "BP")]
    assert reference.annotations(p, a, t, evidence=["iea"]).count() == 1
    hits = spark.createDataFrame([("q", 1, 0.25), ("q", 2, 0.5)], "accession string, ref_sequence_id long, distance double")
    expanded = annotate.scored(annotate.expand(hits, out), "euclidean")
    assert expanded.count() == 3 and rows(expanded, "reliability_index")[0] == (0.5 / 0.75,)


def brute_score(a, b, local):
    m, low = A.matrix(), -(10**9)
    h = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    e, f = ([row[:] for row in h] for _ in range(2))
    h[0][0] = best = 0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i + j == 0:
                continue
            if not i or not j:
                edge = -(A.OPEN + (i + j - 1) * A.EXTEND)
                h[i][j] = 0 if local else edge
                (f if not i else e)[i][j] = h[i][j]
                continue
            e[i][j] = max(e[i - 1][j] - A.EXTEND, h[i - 1][j] - A.OPEN)
            f[i][j] = max(f[i][j - 1] - A.EXTEND, h[i][j - 1] - A.OPEN)
            h[i][j] = max(h[i - 1][j - 1] + m[ord(a[i - 1]) - 65, ord(b[j - 1]) - 65], e[i][j], f[i][j], 0 if local else low)
            best = max(best, h[i][j])
    return best if local else h[len(a)][len(b)]


def test_alignment_scores():
    rng = random.Random(6)
    make = lambda: "".join(rng.choice("ARNDWX") for _ in range(rng.randint(0, 14)))
    a, b = [make() for _ in range(250)], [make() for _ in range(250)]
    for local in (False, True):
        got = A.align(a, b, local)
        assert [int(x) for x in got[:, 0]] == [brute_score(x, y, local) for x, y in zip(a, b)]
        for (score, length, same, positive, gaps), x, y in zip(got.tolist(), a, b):
            assert 0 <= same <= positive <= length and gaps <= length
            if not local:
                assert 2 * length == len(x) + len(y) + gaps


def test_alignment_cases(spark):
    rows_ = [("ACDEFGHIK", "ACDEFGHIK"), ("ACDEFGHIK", "ACDEYGHIK"), ("ACDEFGHIKLMN", "ACDEFGKLMN"), ("", "ACD"), ("", ""), ("WWWW", "PPPP"), (None, "ACD"), ("PPPPWWWWHHHHPPPP", "GGGWWWWHHHHGGG")]
    df = spark.createDataFrame([(i, None if r[0] is None else i, i, *r) for i, r in enumerate(rows_)], "i int, query_idx int, ref_idx int, sequence_query string, sequence_reference string")
    m = annotate.aligned(df).toPandas().set_index("i")
    assert m.identity[0] == 1 and m.gaps_percentage[0] == 0 and m.alignment_length[0] == 9
    assert m.identity[1] == 8 / 9 and m.similarity[1] == 1
    assert m.gaps_percentage[2] == 2 / 12 and m.identity[2] == 10 / 12
    assert m.alignment_length[3] == 3 and m.identity[3] == 0 and m.gaps_percentage[3] == 1 and m.alignment_length[4] == 0
    assert m.alignment_score_sw[5] == 0 and m.identity_sw[5] == 0
    assert np.isnan(m.identity[6]) and np.isnan(m.length_reference[6])
    assert m.identity_sw[7] == 1 and m.alignment_length_sw[7] == 8
    assert annotate.aligned(df.limit(0)).count() == 0


def test_alignment_of_long_pairs_needs_no_whole_trace(monkeypatch):
    rng = random.Random(8)
    make = lambda n: "".join(rng.choice(A.RESIDUES) for _ in range(n))
    a = [make(rng.randint(0, 90)) for _ in range(40)]
    b = [x[5:30] + make(rng.randint(0, 9)) + x[33:] for x in a]
    for local in (False, True):
        monkeypatch.setattr(A, "TRACE", 64_000_000)
        whole = A.align(a, b, local)
        monkeypatch.setattr(A, "TRACE", 1)
        assert (A.align(a, b, local) == whole).all()


RAW = "accession string, go_id string, category string, model_name string, layer_index long, reliability_index double, identity double, identity_sw double, protein_id string"


def test_summary(spark):
    nan = float("nan")
    data = [("a", "t", "BP", "M", 0, 0.12345, 0.3, None, "p2"), ("a", "t", "BP", "M", 0, 0.9, nan, None, "p1"), ("a", "t", "BP", "N", None, 0.5, 0.1, 0.2, "p1"), ("b", "t", None, "M", 0, None, None, None, None), (None, "t", None, "M", 0, 1.0, 1.0, 1.0, "p")]
    raw = spark.createDataFrame(data, RAW)
    conf = Summary(k=1, raw_count=True)
    m = {(r["accession"], r["model_name"]): r for r in summary.weighted(summary.metrics(raw, conf), conf).collect()}
    assert set(m) == {("a", "M"), ("a", "N"), ("b", "M")}
    one = m["a", "M"]
    assert one["max_ri"] == 0.9 and one["mean_id_g"] == 0.3 and one["max_id_l"] is None and one["count"] == 2.0 and one["count_raw"] == 2
    assert one["final_score"] == pytest.approx(0.36 + 0.06 + 0 + 0.4)
    wide = summary.summary(raw, Summary(), [("M", 0), ("N", None), ("absent", 3)]).toPandas().set_index("accession")
    assert wide.loc["a", "term_count"] == 3 and wide.loc["a", "proteins"] == "p1|p2" and wide.loc["b", "proteins"] == ""
    assert wide.loc["a", "max_ri_M_L0"] == 0.9 and wide.loc["a", "max_ri_N_Llegacy"] == 0.5 and wide["max_ri_absent_L3"].isna().all()
    assert "final_score" not in summary.weighted(summary.metrics(raw, conf), Summary(weights={})).columns


def test_exports(spark):
    data = [("a", "t", "bp", "M", 0, 0.5, None, None, "p"), ("a", "t", "BP", "M", 0, 0.5, None, None, "q"), ("a", "t", "BP", "N", None, 0.7, None, None, "q"), ("a", "u", None, "M", 0, 0.9, None, None, "q"), ("a", "v", "MF", "M", 0, float("nan"), None, None, "q")]
    raw = spark.createDataFrame(data, RAW)
    assert rows(exports.topgo_per_model(raw), "model_name", "layer", "go_id") == [("M", "0", "t"), ("N", "legacy", "t")]
    assert rows(exports.topgo_ensemble(raw), "category", "go_id", "reliability_index") == [("BP", "t", 0.7)]


def test_leakage(spark, tmp_path):
    cols = "accession string, reliability_index double, distance double, protein_id string, organism string, gene_name string, query_len long, ref_len long, identity double, go_id string"
    base = lambda acc, ri, d, p, ident, go: (acc, ri, d, p, None, None, 1, None, ident, go)
    raw = spark.createDataFrame([base("a", 0.9, 0.1, "p1", 0.5, "t1"), base("a", 0.9, 0.1, "p1", 0.5, "t2"), base("a", 0.95, 0.05, "p0", 0.51, "t1"), base("a", 0.9, 0.1, "p2", None, "t9"), base("b", 0.4, 0.6, "p", 0.9, "t"), base("c", None, None, None, None, "t")], cols)
    assert rows(leakage.best_donor_rows(raw, 0.5), "accession", "go_id") == [("a", "t1"), ("a", "t2"), ("c", "t")]
    # beyond the protein fields are compared as text, and a missing accession is one
    tie = spark.createDataFrame([("d", 0.5, 0.5, "p", "o", "g", 100, 1, 0.1, "long"), ("d", 0.5, 0.5, "p", "o", "g", 99, 1, 0.1, "short"), (None, 0.5, 0.5, "p", "o", "g", 9, 1, 0.9, "lost")], cols)
    assert rows(leakage.best_donor_rows(tie, 0.5), "accession", "go_id") == [("d", "long")] and rows(leakage.no_survivor(tie, 0.5), "accession") == [("",)]
    assert leakage.counters(tie, 0.5).first()["input_rows"] == 3
    files = tie.withColumn("source_file", F.concat("go_id", F.lit(".csv")))
    assert rows(leakage.selected_donors(files.where("accession = 'd'")), "source_file", "query_len") == [("long.csv", 100), ("short.csv", 99)]
    assert rows(leakage.no_survivor(raw, 0.5), "accession") == [("b",)]
    assert leakage.filtered_out(raw, 0.5).count() == 2
    c = leakage.counters(raw, 0.5).first()
    assert c.asDict() == {"identity_threshold": 0.5, "input_rows": 6, "kept_rows": 3, "filtered_out_rows": 2, "selected_donors": 2, "accessions_with_no_surviving_donor": 1, "input_donors": 5, "filtered_out_donors": 2}
    assert leakage.label(0.5) == "0p50"
    assert leakage.counters(raw.limit(0), 0.5).first()["input_rows"] == 0
    sinks.write_leakage(raw, str(tmp_path), 0.5)
    assert spark.read.text(f"{tmp_path}/global_identity_le_0p50/no_survivor").count() == 1


def test_redundancy(spark):
    c = spark.createDataFrame([("k1", "q1", "q"), ("k1", "7", "r"), ("k1", "8", "r"), ("k1", "7", "q"), ("k2", "q2", "q"), (None, "q3", "q"), ("k3", "9", "r")], "cluster string, identifier string, side string")
    assert rows(redundancy.mask(c), "accession", "ref_sequence_id") == [("7", 7), ("7", 8), ("q1", 7), ("q1", 8)]
    assert rows(redundancy.members(c, "q1"), "identifier", "side") == [("7", "q"), ("7", "r"), ("8", "r"), ("q1", "q")]
    assert redundancy.members(c, "nobody").count() == 0
    assert redundancy.sizes(c.where("cluster = 'k1'")).first()["references"] == 2


def test_representatives(spark):
    """3 matches 2 but not 1, whose member 2 is: so 3 is a representative, and 4 joins it, not 2."""
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (4, 2), (6, 5), (7, 6), (8, 7)], "sid long, rep long")
    assert rows(redundancy.representatives(edges), "sid") == [(1,), (3,), (5,), (7,)]
    assert redundancy.representatives(edges.limit(0)).count() == 0


def test_native_clusters(spark):
    rng = random.Random(11)
    make = lambda n: "".join(rng.choice(A.RESIDUES) for _ in range(n))
    base, other = make(150), make(150)
    near = base[:70] + "W" + base[71:]
    rows_ = [("1", "r", base), ("2", "r", near.lower()), ("q", "q", base), ("3", "r", other), ("4", "r", base[5:140]), ("5", "r", None), ("6", "r", "AC")]
    df = spark.createDataFrame(rows_, "identifier string, side string, sequence string")
    got = {r["identifier"]: r["cluster"] for r in redundancy.cluster(df, 0.9, 0.7).collect()}
    assert got["1"] == got["2"] == got["q"] == got["4"] != got["3"] and "5" not in got and got["6"] not in (got["1"], got["3"])
    assert redundancy.cluster(df, 0, 0.7).count() == 0 and redundancy.cluster(df.limit(0), 0.9, 0.7).count() == 0


def test_native_clusters_of_fragments(spark):
    rng = random.Random(5)
    longer = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(400))
    parts = {"30": longer[40:160], "45": longer[200:380], "60": longer[:240], "4": longer[9:25]}
    df = spark.createDataFrame([("long", "r", longer), *[(k, "q", v) for k, v in parts.items()]], "identifier string, side string, sequence string")
    got = {r["identifier"]: r["cluster"] for r in redundancy.cluster(df, 0.9, 0.7).collect()}
    assert len(got) == 5 and len(set(got.values())) == 1


@pytest.mark.parametrize("identity", [0.5, 0.6, 0.7, 0.8, 0.9])
def test_native_clusters_against_brute_force(spark, identity):
    rng = random.Random(int(identity * 10))
    letter = lambda: rng.choice("ACDEFGHIKLMNPQRSTVWY")
    seqs = {}
    for i in range(60):
        base = "".join(letter() for _ in range(rng.randint(60, 240)))
        lo = rng.randint(0, len(base) // 2)
        seqs[f"{i}a"] = base
        seqs[f"{i}b"] = "".join(letter() if rng.random() > identity + 0.03 else c for c in base[lo : lo + rng.randint(50, 200)])
    names = list(seqs)
    pairs = [(s, r) for s in names for r in names if len(seqs[r]) > len(seqs[s]) and s[:-1] == r[:-1]]
    m = A.metrics(pd.Series([seqs[s] for s, _ in pairs]), pd.Series([seqs[r] for _, r in pairs]))
    ok = (m.identity_sw >= identity) & (m.alignment_length_sw * (1 - m.gaps_percentage_sw) >= 0.7 * m.length_query)
    want = [p for p, x in zip(pairs, ok) if x]
    df = spark.createDataFrame([(k, "r", v) for k, v in seqs.items()], "identifier string, side string, sequence string")
    got = {r["identifier"]: r["cluster"] for r in redundancy.cluster(df, identity, 0.7).collect()}
    found = sum(got[s] == got[r] for s, r in want)
    print(f"identity {identity}: {found} of {len(want)}")
    assert len(want) > 5 and found >= 0.95 * len(want)


def _greedy(seqs: dict[str, str], spark, identity: float = 0.9) -> dict[str, str]:
    """Representative of every sequence, by alignment of all pairs."""
    sid = {r["s"]: r["h"] for r in spark.createDataFrame([(x,) for x in seqs.values()], "s string").distinct().select("s", F.xxhash64("s").alias("h")).collect()}
    order = lambda x: (len(x), -sid[x])
    texts = sorted(sid, key=order)
    pairs = [(s, r) for i, s in enumerate(texts) for r in texts[i + 1 :]]
    m = A.metrics(pd.Series([s for s, _ in pairs]), pd.Series([r for _, r in pairs]), sides=(("_sw", True),))
    near = {p for p, x in zip(pairs, (m.identity_sw >= identity) & (m.alignment_length_sw * (1 - m.gaps_percentage_sw) >= 0.7 * m.length_query)) if x}
    top: dict[str, str] = {}
    for s in reversed(texts):
        top[s] = max((r for x, r in near if x == s and top[r] == r), key=order, default=s)
    return {k: str(sid[top[v]]) for k, v in seqs.items()}


@pytest.mark.parametrize(("wide", "residues", "sample"), [(2_000, 400_000, 8_000), (5, 400_000, 40), (5, 0, 8_000)])
def test_native_clusters_with_a_common_motif(spark, monkeypatch, wide, residues, sample):
    """A run of residues that most sequences hold makes no pairs of all of them, and none that matches is lost."""
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice(A.RESIDUES) for _ in range(n))
    motif, seqs = make(24), {}
    for i in range(70):
        seqs[f"{i}"] = make(rng.randint(20, 120)) + motif + make(rng.randint(5, 60))
        if i % 3 == 0:
            base = seqs[f"{i}"]
            lo = rng.randint(0, len(base) // 8)
            seqs[f"{i}m"] = "".join(c if rng.random() > 0.05 else rng.choice(A.RESIDUES) for c in base[lo : lo + int(len(base) * 0.85)])
    for name, value in (("WIDE", wide), ("WIDE_RESIDUES", residues), ("SAMPLE", sample), ("FREQUENT", 20)):
        monkeypatch.setattr(redundancy, name, value)
    df = spark.createDataFrame([(k, "r", v) for k, v in seqs.items()], "identifier string, side string, sequence string")
    got = {r["identifier"]: r["cluster"] for r in redundancy.cluster(df, 0.9, 0.7).collect()}
    want = _greedy(seqs, spark)
    assert got == want and len(set(want.values())) < len(seqs) - 10
    texts = df.select(F.monotonically_increasing_id().alias("id"), F.length("sequence").alias("n"), F.lit(7).alias("k"), "sequence")
    if wide == 5 and residues:  # few lead to so many others that an index is worth while
        assert redundancy._candidates(texts, 0.9, 0.7).distinct().count() < 3 * len(seqs)


def test_shuffle_files_go_with_the_job(spark):
    """A working table leaves none of the shuffle files that led to it."""
    dirs = [str(x) for x in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}
    before = files()
    made = materialise(spark.range(5000).groupBy((F.col("id") % 7).alias("g")).count())
    assert not files() - before and made.count() == 7
    assert spark.conf.get(CLEANUP) == "false"


def test_local_alignment_alone(spark):
    df = spark.createDataFrame([("ACDEFGHIKL", "WACDEFHIKLW"), (None, "AC"), ("MKV", "")], "q string, r string")
    both = df.select(A.alignment("q", "r").alias("a"), A.local_alignment("q", "r").alias("b")).collect()
    for x in both:
        assert all(x.a[c] == x.b[c] for c in ("identity_sw", "gaps_percentage_sw", "alignment_length_sw", "length_query"))
        assert x.b["identity"] is None


def test_sequences_alone_need_no_vectors(spark):
    """The clusters of a masked search take sequences of the query table without shuffling its vectors."""
    q = pipeline.Tables.at(spark, DATA).queries
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(q).count("min_by(") == 2 and plan(q.select("accession", "sequence")).count("min_by(") == 1


def test_packed_numbers():
    columns = [np.array([0, 1, -5, 1 << 62]), np.array([], dtype=np.int64), np.arange(300)]
    for x, y in zip(columns, redundancy._unpacked(redundancy._packed(columns), 3)):
        assert x.tolist() == y.tolist()


def test_search_masked_by_clusters(spark):
    t = pipeline.Tables.at(spark, DATA)
    both = [(r["identifier"], r["side"], r["sequence"]) for r in prepare.all_sequences(t.sequences, t.queries).collect() if r["sequence"]]
    sid = {r["s"]: r["h"] for r in spark.createDataFrame([(x[2],) for x in both], "s string").distinct().select("s", F.xxhash64("s").alias("h")).collect()}
    order = lambda x: (len(x), -sid[x])
    texts = sorted(sid, key=order)
    pairs = [(s, r) for i, s in enumerate(texts) for r in texts[i + 1 :]]
    m = A.metrics(pd.Series([s for s, _ in pairs]), pd.Series([r for _, r in pairs]))
    near = {p for p, x in zip(pairs, (m.identity_sw >= 0.9) & (m.alignment_length_sw * (1 - m.gaps_percentage_sw) >= 0.7 * m.length_query)) if x}
    assert near
    top = {}
    for s in reversed(texts):
        rep = max((r for x, r in near if x == s), key=order, default=None)
        top[s] = top[rep] if rep else s
    masked = {(a, int(b)) for a, x, u in both if x == "q" for b, y, v in both if y == "r" and top[u] == top[v]}
    refs = reference.reference_vectors(t.references, t.sequences, t.proteins)
    want = knn.declarative(t.queries, refs, k=1000).toPandas()
    want = want[[(a, b) not in masked for a, b in zip(want.accession, want.ref_sequence_id)]]
    want = want.assign(d=want.distance.round(10)).sort_values(["d", "ref_sequence_id"]).groupby(["accession", "embedding_type_id", "layer_index"], dropna=False).head(3)
    got = queries.knn_cluster_mask(spark, DATA).toPandas()
    key = lambda f: sorted(map(repr, zip(f.accession, f.ref_sequence_id.astype(int), f.embedding_type_id.astype(int), f.layer_index.fillna(-1).astype(int))))
    assert key(got) == key(want)


def test_collapse(spark):
    data = [("a", "t", "M", 0, 0.5, 1), ("a", "t", "N", None, 0.9, 2), ("a", "u", "N", None, 0.1, 3), ("a", "t", "N", None, 0.9, 1), ("b", "t", "M", 0, None, 1), ("c", "t", "M", 0, -1.0, 1)]
    df = spark.createDataFrame(data, "accession string, go_id string, model_name string, layer_index long, s double, i long")
    assert rows(collapse.collapse(df, "s", ["i"]).where("accession = 'a'"), "go_id", "model_name", "i") == [("t", "N", 1), ("u", "N", 3)]
    n = {(r["accession"], r["i"], r["go_id"]): r["n"] for r in collapse.normalized(df, "s", "n").collect()}
    assert n["a", 2, "t"] == 1 and n["b", 1, "t"] == 0 and n["c", 1, "t"] == 0


def test_indexes(spark):
    df = spark.createDataFrame([(5, "B"), (1, "B"), (2, "A"), (2, "C"), (9, None)], "o long, s string")
    assert rows(annotate.sequence_index(df, "s", "o"), "idx", "s") == [(0, "B"), (1, "A"), (2, "C")]
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("o"), F.col("id").cast("string").alias("s"))
    got = annotate.sequence_index(many, "s", "o").toPandas().sort_values("idx")
    assert got.idx.tolist() == list(range(5000))
    assert [int(x) * 7919 % 5000 for x in got.s] == list(range(5000))


def test_prepare(spark):
    v = spark.createDataFrame([("a", "S", 1, 0, [1.0], 2), ("a", "T", 1, 0, [2.0], 1), ("a", "S", 1, None, [3.0], 3), ("x|y", "S", 2, 0, [4.0], 4), (None, "S", 1, 0, [5.0], 5)], "accession string, sequence string, embedding_type_id int, layer_index int, embedding array<float>, n int")
    assert rows(sinks.new_vectors(v, None, "n").select("accession", F.col("embedding")[0].alias("e")), "accession", "e") == [("a", 2.0), ("a", 3.0), ("x_y", 4.0)]
    stored = spark.createDataFrame([("a", 1, None), ("x_y", 2, 0)], "accession string, embedding_type_id int, layer_index int")
    assert rows(sinks.new_vectors(v, stored, "n"), "accession", "layer_index") == [("a", 0)]
    assert v.select(prepare.truncated(F.lit("ABCDE"), 3).alias("x"), prepare.truncated(F.lit("ABCDE"), "3").alias("y"), prepare.truncated(F.lit("ABCDE"), 0).alias("z")).first()[:] == ("ABC", "ABCDE", "ABCDE")
    models = spark.createDataFrame([(1, "Big"), (2, "small"), (3, "BIG")], "id int, name string")
    assert rows(prepare.enabled_models(models, {"bIg": [1, 0, 1], "none": [0]}), "embedding_type_id", "layer_index") == [(1, 0), (1, 1)]
    with pytest.raises(Exception, match="a vector without embedding"):
        prepare.checked_tasks(v.withColumn("embedding", F.lit(None).cast("array<float>"))).collect()


def test_embedder(spark):
    t = spark.createDataFrame([("a", "ACDE", 1, "composition", 0), ("b", None, 1, "composition", 0), ("a", "ACDE", 1, "composition", 3)], "accession string, sequence string, embedding_type_id int, model_name string, layer_index int")
    out = embed.embed(t, 1).collect()
    assert len(out) == 2 and len(out[0]["embedding"]) == 64 and out[0]["embedding"] != out[1]["embedding"]
    legacy = embed.embed(t.withColumn("layer_index", F.lit(None).cast("int"))).collect()
    assert len(legacy) == 2 and legacy[0]["layer_index"] is None
    with pytest.raises(Exception, match="no embedder"):
        embed.embed(t.withColumn("model_name", F.lit("other"))).collect()


FASTA = """junk before
>one first
ACD
ef g
>sp|two|X desc
more of the header OS=1
ACDX
acd*
>three
MKV*
ACD
>
AAAA
>one again
GGG
>empty"""


def test_fasta(spark, tmp_path):
    got = list(fasta.records(FASTA.splitlines()))
    assert got == [("junk", ""), ("one", "ACDEFG"), ("sp|two|X", "ACDXACD*"), ("three", "ACD"), ("unknown", "AAAA"), ("one", "GGG"), ("empty", "")]
    assert list(fasta.records([])) == []
    assert list(fasta.records(["ACD", "lost too", ">a", "ACD"])) == [("a", "ACD")]
    import gzip

    (tmp_path / "b.fa").write_text(FASTA)
    with gzip.open(tmp_path / "a.fa.gz", "wt") as f:
        f.write(">z\nACD")
    df = fasta.read(spark, str(tmp_path))
    assert df.count() == 8 and rows(df.where("identifier = 'three'"), "sequence") == [("ACD",)]
    # a file cut anywhere gives the same records in the same order
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        cut = fasta.read(spark, str(tmp_path))
        assert cut.rdd.getNumPartitions() > 2
        assert rows(cut.orderBy("path", "position"), "identifier", "sequence") == rows(df, "identifier", "sequence")
        assert [r["identifier"] for r in cut.where("path like '%b.fa'").orderBy("position").collect()] == [r["identifier"] for r in df.where("path like '%b.fa'").orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows(fasta.read(spark, str(tmp_path), 2), "identifier") == [("junk",), ("z",)]
    assert rows(fasta.header_ids(spark, str(tmp_path / "b.fa")), "accession") == [("empty",), ("one",), ("sp_two_X",), ("three",)]


def test_folders(spark, tmp_path):
    files = spark.createDataFrame([("f", "x.fasta"), ("f", "x.pep.gz"), ("f", "y.fa.gz"), ("f", "z.txt")] + [("g", f"p{i}.faa") for i in range(10)] + [("h", f"p{i}.fa") for i in range(15)] + [("i", f"p{i}.fa") for i in range(20)], "folder string, name string")
    assert rows(fasta.chosen_files(files).where("folder = 'f'"), "base", "name") == [("x", "x.fasta"), ("y", "y.fa.gz")]
    assert rows(fasta.folder_batches(files), "folder", "proteomes", "batch") == [("f", 2, "lt10"), ("g", 10, "rest"), ("h", 15, "gt10lt20"), ("i", 20, "rest")]
    done = spark.createDataFrame([("a_20240101000000",)], "name string")
    assert rows(fasta.not_yet_run(spark.createDataFrame([("a",), ("b",)], "p string"), done, "p"), "p") == [("b",)]
    names = spark.createDataFrame([("a_20240101000000",), ("a_20250101000000",), ("ab_20260101000000",)], "name string")
    assert sinks.latest_experiment(names, "a").first()[0] == "a_20250101000000"
    job = tmp_path / "jobs.tsv"
    job.write_text("i1\to1\t--x 1\ni2\to2\n")
    assert fasta.parameter_row(str(job), 2) == ("i2", "o2", "")


def test_raw_sources(spark, tmp_path):
    (tmp_path / "m" / "layer_0").mkdir(parents=True)
    (tmp_path / "m" / "layer_0" / "a.csv").write_text("accession,model_name,embedding_type_id\nNA,M,1\nb,M,x\n")
    df = raw_source.read_shards(spark, str(tmp_path / "m"))
    assert rows(df, "accession", "embedding_type_id") == [("NA", 1), ("b", None)]
    one, two, none = (str(tmp_path / f"{n}.csv") for n in ("one", "two", "none"))
    for p, t in ((one, "a,b\n1,2\n"), (two, "a,b\n3,4\n5,6\n"), (none, "")):
        with open(p, "w") as f:
            f.write(t)
    merged = raw_source.read_strict(spark, [one, two, none])
    assert rows(raw_source.merge_statistics(merged).where("not total"), "source_file", "rows") == [("one.csv", 1), ("two.csv", 2)]
    assert raw_source.merge_statistics(merged).where("total").first()[:] == (None, 2, 3, True)
    sinks.write_merged(merged, str(tmp_path / "merged"), True)
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "merged")), "a", "source_file") == [("1", "one.csv"), ("3", "two.csv"), ("5", "two.csv")]
    with open(none, "w") as f:
        f.write("a,c\n")
    with pytest.raises(ValueError):
        raw_source.read_strict(spark, [one, none])


def test_term_edges(spark, tmp_path):
    p = tmp_path / "terms.obo"
    p.write_text("format-version: 1.2\n\n[Term]\nid: T:1\nname: a\nis_a: T:2 ! b\nrelationship: part_of T:3 ! c\n\n[Term]\nid: T:4\nis_obsolete: true\nis_a: T:2\n\n[Typedef]\nid: part_of\n")
    assert rows(raw_source.term_edges(spark, str(p)), "child", "parent", "relation") == [("T:1", "T:2", "is_a"), ("T:1", "T:3", "part_of")]


def test_coverage(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "accession string")
    v = spark.createDataFrame([("y", 1), ("z", 1)], "accession string, n int")
    rep = coverage.report(a, v)
    assert rows(rep, "accession", "embedded") == [("x", "no"), ("y", "yes")]
    assert coverage.counts(rep).first()[:] == (2, 1, 1) and rows(coverage.missing(a, v), "accession") == [("x",)]
