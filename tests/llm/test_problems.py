"""The nine problems: edge cases, brute force, invariants."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from annoweave.llm import boundaries, forest, holdout, mixture, near_duplicates, packing, portions, quality, queries, split_overlap, sql, topn, weighted_sampling as ws, winnowing

from ..conftest import DATA

RESIDUES = "ACDEFGHIKLMNPQRSTVWY"


def text(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(RESIDUES) for _ in range(n))


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_equals_sql(name, same_as_sql):
    same_as_sql(queries.queries()[name], sql.oracle_sql()[name])


# 1 ---------------------------------------------------------------------------

ITEMS = "accession string, embedding_type_id long, sequence string, piece_limit int, piece_overlap int, cuts string, boundaries string"


@pytest.mark.parametrize(
    "sequence, expected",
    [
        ("AAAA*CCCC", (8, [4])),
        ("AAAA**--CCCC*", (8, [4])),
        ("*AAAA", (4, [])),
        ("AAXXXXCC", (8, [])),
        ("AAXX 12\nXXXCC", (9, [7])),
        ("XXXXXAA", (7, [])),
        ("AAXXXXX", (7, [])),
        ("XXXXX*AA", (7, [5])),
        ("AAxxxxx*XXXXXcc", (14, [7, 12])),
        ("XXX*XXA", (6, [3])),
        ("", (0, [])),
        ("*-1", (0, [])),
    ],
)
def test_boundaries(sequence, expected):
    around = ["XXXXA", sequence, "XXXXXA*A", "é-Äß"]
    lengths, who, at = boundaries.natural_boundaries(around)
    assert (lengths[1], at[who == 1].tolist()) == expected and lengths[0] == 5 and at[who == 2].tolist() == [6] and 3 not in who


def greedy(n, natural, limit, overlap):
    cuts, at = [0], 0
    while at < n:
        reach = (at - overlap if at else 0) + limit
        if reach >= n:
            at = n
        else:
            near = [b for b in natural if at < b <= reach]
            at = near[-1] if near else reach
        cuts.append(at)
    return cuts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 400), st.integers(1, 60), st.integers(0, 80), st.sets(st.integers(1, 399), max_size=12)), min_size=1, max_size=8))
def test_doubling_equals_greedy(rows):
    natural = [sorted(b for b in bs if b < n) for n, _, _, bs in rows]
    limit, overlap = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    who = np.repeat(np.arange(len(rows)), [len(b) for b in natural])
    got, owner, start, reach = boundaries.greedy_cuts(np.array([r[0] for r in rows]), who, np.array([x for b in natural for x in b], dtype=np.int64), limit, overlap)
    assert [start[owner == i].tolist() for i in range(len(rows))] == [[0, *b] for b in natural] and (reach > start).all()
    for (n, lim, ov, _), nat, cuts in zip(rows, natural, got):
        assert cuts.tolist() == greedy(n, nat, lim, min(ov, lim - 1))


def test_split_edge_cases(spark):
    rng = random.Random(1)
    long = text(rng, 60) + "*" + text(rng, 70)
    rows = [
        ("a", 1, long, 50, 5, "x", "y"),
        ("a", 1, " ".join(long).lower() + "*", 50, 5, "x", "y"),
        ("b", 1, "ACD", 50, 5, None, None),
        ("c", 1, None, 50, 5, None, None),
        ("d", 1, "", 50, 5, None, None),
        ("e", 1, long, None, 5, None, None),
        ("f", 1, long, 0, 5, None, None),
        ("g", None, long, 40, None, None, None),
        ("h", 1, long, 10, 99, None, None),
    ]
    df = spark.createDataFrame(rows, ITEMS)
    keys = ["accession", "embedding_type_id"]
    out = boundaries.split_oversized(df, keys, "sequence", "piece_limit", "piece_overlap")
    assert sorted(r["accession"] for r in out.collect()) == ["a", "g", "h"]
    got = boundaries.pieces(out, keys).toPandas()
    for name, limit, overlap in (("a", 50, 5), ("g", 40, 0), ("h", 10, 9)):
        p = got[got.accession == name].sort_values("piece_no")
        whole = p.piece.iloc[0] + "".join(x[overlap:] for x in p.piece.iloc[1:])
        assert whole == long.replace("*", "")
        assert p.piece.str.len().max() <= limit
    assert boundaries.pieces(boundaries.split_oversized(df.limit(0), keys, "sequence", "piece_limit", "piece_overlap"), keys).count() == 0


def test_pieces_cover_every_oversized_pair(spark):
    pieces = queries.p1_pieces(spark, DATA).toPandas()
    limits = spark.read.parquet(f"{DATA}/model_limits.parquet").toPandas().set_index("embedding_type_id")
    for (_, model), p in pieces.groupby(["accession", "embedding_type_id"]):
        p = p.sort_values("piece_no")
        assert p.piece.str.len().max() <= limits.piece_limit[model]
        assert (p.start_at.to_numpy()[1:] == p.end_at.to_numpy()[:-1] - limits.piece_overlap[model]).all()
        assert p.start_at.iloc[0] == 0


# 2 ---------------------------------------------------------------------------


def test_top_n(spark):
    nan = float("nan")
    rows = [("a", 0.9, 0.5, i) for i in range(20, 0, -1)] + [("a", 0.9, None, 0), ("a", 0.95, nan, 50), ("a", 0.95, 7.0, 51), ("a", None, 0.1, 60), ("a", nan, 0.1, 61)]
    rows += [("a", 0.95, 7.0, 51)] * 30 + [("b", 0.1, 1.0, 5), (None, 1.0, 0.0, 9), ("c", 0.3, 0.1, None)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "g string, s double, c double, i long, rank int, score string")
    got = topn.top_n(df.repartition(5), "g", "s", "c", "i", 4).collect()
    assert sorted(r["i"] for r in got if r["g"] == "a") == [1, 2, 50, 51]
    assert [r["i"] for r in got if r["g"] == "b"] == [5]
    assert {r["g"] for r in got} == {"a", "b"}
    assert topn.top_n(df.limit(0), "g", "s", "c", "i", 4).count() == 0
    assert topn.top_n(df, "g", "s", "c", "i", 0).count() == 0


def test_top_n_reduces_as_it_goes(spark, monkeypatch):
    df = spark.range(0, 30_000, 1, 3).select((F.col("id") % 7).cast("string").alias("g"), (F.col("id") * 37 % 1001).cast("double").alias("s"), F.lit(None).cast("double").alias("c"), F.col("id").alias("i"))
    monkeypatch.setattr(topn, "GATHER", 1500)
    monkeypatch.setattr(topn, "HELD", 20)
    got = {(r["g"], r["i"]) for r in topn.top_n(df, "g", "s", "c", "i", 3).collect()}
    pdf = df.toPandas().sort_values(["g", "s", "i"], ascending=[True, False, True])
    assert got == set(map(tuple, pdf.groupby("g").head(3)[["g", "i"]].itertuples(index=False)))


# 3 and 6 ---------------------------------------------------------------------


def edited(rng: random.Random, t: str) -> str:
    blocks = [t[i : i + 60] for i in range(0, len(t), 60)]
    if rng.random() < 0.5:
        blocks[0], blocks[-1] = blocks[-1], blocks[0]
    t = "".join(blocks)
    for _ in range(rng.randint(0, 2)):
        i = rng.randrange(len(t))
        t = t[:i] + rng.choice(RESIDUES) + t[i + rng.randint(0, 2) :]
    return t


def family_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(30):
        base = text(rng, rng.randint(120, 400))
        out += [base] + [edited(rng, base) for _ in range(rng.randint(0, 5))]
    motif = text(rng, 30)
    out += [text(rng, 150) + motif + text(rng, 150) for _ in range(60)]
    return out


def brute(texts: list[str]) -> set[tuple[str, str]]:
    grams = {t: {t[i : i + 8] for i in range(len(t) - 7)} for t in texts}

    def share(a, b):
        covered = {i + k for i in range(len(a) - 7) if a[i : i + 8] in grams[b] for k in range(8)}
        return len(covered) / len(a)

    return {(min(a, b), max(a, b)) for a in grams for b in grams if a < b and grams[a] & grams[b] and share(a, b) >= 0.8 and share(b, a) >= 0.8}


def test_similar_texts_equal_brute_force(spark, monkeypatch):
    texts = sorted(set(family_texts(3)))
    members = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    distinct = near_duplicates.distinct_texts(members, "t")
    by_id = {r["text_id"]: r["t"] for r in distinct.collect()}
    expected = brute(texts)
    assert len(expected) > 60
    for block in (512, 3):  # small blocks split every bucket
        monkeypatch.setattr(near_duplicates, "BUCKET_BLOCK", block)
        for exact in (False, True):
            got = {tuple(sorted((by_id[r["a"]], by_id[r["b"]]))) for r in near_duplicates.similar_texts(distinct, "t", exact).collect()}
            assert got == expected


def test_groups_and_pairs(spark):
    rng = random.Random(5)
    base = text(rng, 200)
    chain = [base, base[12:] + text(rng, 12), base[24:] + text(rng, 24), base[36:] + text(rng, 36)]
    rows = [(i, t) for i, t in enumerate([*chain, base, base, text(rng, 200), "ACD"])]
    members = spark.createDataFrame(rows, "ref long, t string").where(F.length("t") >= 8).withColumn("text_id", F.xxhash64("t"))
    links = near_duplicates.similar_texts(near_duplicates.distinct_texts(members, "t"), "t").cache()
    of = near_duplicates.classes(near_duplicates.distinct_texts(members, "t"), "t")
    found = members.join(of, "text_id").toPandas().set_index("ref")
    assert found.loc[[0, 1, 2, 3, 4, 5], "class_id"].nunique() == 1
    assert found.loc[6, "class_id"] == found.loc[6, "text_id"]
    pairs = {tuple(r) for r in near_duplicates.record_pairs(members, links, "ref").collect()}
    assert {(0, 4), (0, 5), (4, 5), (0, 1)} <= pairs and all(a < b for a, b in pairs)


def test_classes_are_the_components_of_all_links(spark):
    """Comparing with representatives first loses no link between classes."""
    texts = sorted(set(family_texts(8)))
    rng = random.Random(8)
    drift = [text(rng, 240)]
    for _ in range(12):  # neighbours alike, ends not
        drift.append(drift[-1][20:] + text(rng, 20))
    distinct = near_duplicates.distinct_texts(spark.createDataFrame([(t,) for t in texts + drift], "t string"), "t")
    links = near_duplicates.similar_texts(distinct, "t", True)
    of = {r["node"]: r["component"] for r in near_duplicates.components(links).collect()}
    for exact in (False, True):
        got = {r["text_id"]: r["class_id"] for r in near_duplicates.classes(distinct, "t", exact).collect()}
        assert len(got) == distinct.count() and all(of.get(t, t) == c for t, c in got.items())


def test_pairs_of_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BUCKET_BLOCK", 7)
    members = spark.createDataFrame([(i, i % 3 // 2) for i in range(90)], "ref long, text_id long")
    links = spark.createDataFrame([(0, 1)], "a long, b long")
    assert near_duplicates.record_pairs(members, links, "ref").count() == 90 * 89 // 2
    assert near_duplicates.record_pairs(members, links.limit(0), "ref").count() == 60 * 59 // 2 + 30 * 29 // 2


def test_frequency_table_is_bounded(spark, monkeypatch):
    df = spark.createDataFrame([("ACDEFGHIKLMNPQRSTVWY" * (i + 1),) for i in range(40)], "t string")
    assert len(ws.document_frequencies(df, "t").codes) > 10
    monkeypatch.setattr(ws, "LISTED", 10)
    assert len(ws.document_frequencies(df, "t").codes) <= 10


def test_no_texts(spark):
    empty = spark.createDataFrame([], "id long, t string")
    distinct = near_duplicates.distinct_texts(empty, "t")
    links = near_duplicates.similar_texts(distinct, "t")
    assert links.count() == 0
    assert near_duplicates.components(links).count() == 0
    sides = distinct.withColumn("l", F.lit(True)).withColumn("r", F.lit(True))
    assert split_overlap.near_overlaps(sides, "t", "l", "r").count() == 0
    assert near_duplicates.classes(distinct, "t").count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in near_duplicates.components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100 and len(got) == 63


def test_samples_follow_weighted_jaccard():
    rng = random.Random(9)
    idf = ws.Idf(np.array([], np.int64), np.array([], np.int64), 1000, 2.0)
    base = text(rng, 3000)
    other = base[:2000] + text(rng, 1000)
    j, *_ = ws.compare([base], [other], idf)
    _, sig = ws.signatures([base, other], idf)
    agreed = (sig[0] == sig[1]).mean()  # a band agrees with the square of the similarity
    assert abs(agreed - j[0] ** ws.ROWS) < 0.2
    assert ws.compare(["ACD"], ["ACD"], idf)[1][0] == 0


def test_overlap_sides(spark):
    rng = random.Random(2)
    a, b = text(rng, 150), text(rng, 150)
    rows = [(a, True, True), (edited(random.Random(1), a), False, True), (b, True, False), (text(rng, 150), False, True)]
    texts = spark.createDataFrame(rows, "t string, l boolean, r boolean").withColumn("text_id", F.xxhash64("t"))
    got = {(r["a"], r["b"]) for r in split_overlap.near_overlaps(texts, "t", "l", "r").collect()}
    ids = [r["text_id"] for r in texts.collect()]
    assert got == {(ids[0], ids[1])}
    ev = split_overlap.hashed(spark.createDataFrame([("x", a), ("y", "ACD"), ("z", None), ("w", "")], "acc string, text string"), "text")
    tr = split_overlap.hashed(spark.createDataFrame([(1, a), (2, "ACD"), (2, "ACD"), (3, ""), (4, None)], "ref long, text string"), "text")
    assert {tuple(r) for r in split_overlap.exact_overlaps(ev, tr, ["acc", "ref"]).collect()} == {("x", 1), ("y", 2)}


# 4 ---------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 100)), min_size=1, max_size=60), st.integers(1, 6))
def test_pack_keeps_every_limit(items, segments):
    tokens = np.array([t for t, _ in items])
    loss = np.array([min(t, x) for t, x in items])
    batch = packing.pack(tokens, loss, 100, segments, 100)
    for n in range(batch.max() + 1):
        here = batch == n
        assert here.any() and tokens[here].sum() <= 100 and here.sum() <= segments and loss[here].sum() <= 100


def test_batches(spark):
    rng = random.Random(4)
    rows = [(f"s{i}", 1, text(rng, rng.randint(5, 120)) + "XX", 100) for i in range(200)] + [("n", 1, None, 100), ("e", 1, "*", 100), ("big", 1, text(rng, 350), 100), ("z", 1, "ACD", None), ("s1", 1, None, 100)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "accession string, embedding_type_id long, sequence string, cap int, batch_no string")
    sized = packing.cut_items(df.union(df), ["accession", "embedding_type_id"], "sequence", "cap")
    out = packing.fill_batches(sized, "embedding_type_id").toPandas()
    assert out[out.accession == "big"].tokens.sum() == 350 and out.tokens.max() <= 100
    assert out.groupby(["batch_block", "batch_no"]).tokens.sum().max() <= 100
    assert out.tokens.sum() == sum(len(s) for _, _, s, c in rows if s and c and s != "*")
    assert not set(out.accession) & {"n", "e", "z"}
    assert packing.fill_batches(sized.limit(0), "embedding_type_id").count() == 0


def test_loss_limit_holds_beside_an_item_over_it(spark):
    items = [(1, i, 0, 10, 10, 100) for i in range(30)] + [(1, 99, 0, 100, 100, 100), (2, 1, 0, 90, 90, 100)]
    sized = spark.createDataFrame(items, "g int, content_id long, chunk_no long, tokens long, loss_tokens long, capacity long")
    out = packing.fill_batches(sized, "g", loss_share=0.5).toPandas()
    sums = out.groupby(["g", "batch_block", "batch_no"]).agg(loss=("loss_tokens", "sum"), items=("tokens", "size"))
    assert len(out) == 32 and ((sums.loss <= 50) | (sums["items"] == 1)).all() and (sums.loss > 50).sum() == 2


def test_many_blocks_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 10)
    sized = spark.range(200).select(F.lit(1).alias("g"), F.col("id").alias("content_id"), F.lit(0).cast("long").alias("chunk_no"), (F.col("id") % 9 + 1).alias("tokens"), (F.col("id") % 9 + 1).alias("loss_tokens"), F.lit(20).cast("long").alias("capacity"))
    out = packing.fill_batches(sized, "g").withColumn("task", F.spark_partition_id())
    assert out.select("task").distinct().count() > 1 and out.count() == 200


def test_batches_are_full(spark):
    report = queries.p4_report(spark, DATA).toPandas()
    assert (report.batches <= report.least_batches + 2).all()


# 5 ---------------------------------------------------------------------------


def test_forest_recall(spark):
    """Recall of the five nearest against brute force, on data the arrays of which exceed the candidates."""
    g = np.random.default_rng(0)
    centres = g.standard_normal((900, 64))
    x = np.concatenate([centres, centres[:600] + 0.25 * g.standard_normal((600, 64)), g.standard_normal((2000, 64))])
    x *= g.uniform(0.5, 3, len(x))[:, None]
    x = x.astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "m": 1, "layer": None, "embedding": list(x.tolist())}).astype({"layer": object}), "vec_id long, m int, layer int, embedding array<float>")
    got = forest.nearest(df, "vec_id", ["m", "layer"], "embedding", 5).toPandas()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -2)
    true = np.argsort(-sim, axis=1)[:, :5]
    mine = got.groupby("vec_id").neighbour.apply(set)
    assert np.mean([len(mine[i] & set(true[i])) / 5 for i in range(len(x))]) >= 0.9
    close = [(i, j) for i in range(len(x)) for j in true[i] if sim[i, j] >= 0.9]
    assert sum(j in mine[i] for i, j in close) >= 0.97 * len(close)


def test_forest_borders_hide_nothing(spark, monkeypatch):
    """Arrays cut into many partitions give the neighbours that uncut ones give."""
    monkeypatch.setattr(forest, "CANDIDATES", 48)
    monkeypatch.setattr(forest, "FACTOR", 0.1)
    x = np.random.default_rng(5).standard_normal((3000, 8)).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "m": 1, "embedding": list(x.tolist())}), "vec_id long, m int, embedding array<float>")
    pairs = []
    for rows, spans in ((40_000, 8), (400, 1)):
        monkeypatch.setattr(forest, "RANGE_ROWS", rows)
        monkeypatch.setattr(forest, "RANGE_SPANS", spans)
        got = forest.nearest(df, "vec_id", ["m"], "embedding", 3, asked=F.col("vec_id") % 3 == 0).collect()
        assert all(r["vec_id"] % 3 == 0 for r in got)
        pairs.append({(r["vec_id"], r["neighbour"]) for r in got})
    assert len(pairs[0]) == 3000 and len(pairs[0] & pairs[1]) >= 0.995 * len(pairs[0])


def test_forest_least(spark):
    """With ``least`` only near vectors come out, and the sample's share never rounds to nothing."""
    g = np.random.default_rng(6)
    x = g.standard_normal((700, 32))
    x = np.concatenate([x, x[:300] + 0.15 * g.standard_normal((300, 32))]).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "m": 1, "embedding": list(x.tolist())}), "vec_id long, m int, embedding array<float>")
    got = {(r["vec_id"], r["neighbour"]) for r in forest.nearest(df, "vec_id", ["m"], "embedding", 5, least=0.9).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = {(i, j) for i, j in np.argwhere(u @ u.T >= 0.9) if i != j}
    assert got <= true and len(got) >= 0.99 * len(true)
    n = spark.range(200_000).where(portions.sampled(F.lit(1e-4), 7, "id")).count()
    assert 5 <= n <= 50


def test_forest_edge_cases(spark):
    nan = float("nan")
    same = [1.0, 2.0, 3.0]
    rows = [(i, 1, 0, same) for i in range(12)] + [(20, 1, 0, [2.0, 4.0, 6.0]), (21, 1, 0, [-1.0, 0.0, 1.0]), (22, 1, None, same), (23, 1, 0, None), (24, 1, 0, []), (25, 1, 0, [0.0] * 3), (26, 1, 0, [1.0, nan, 1.0]), (27, 1, 0, [1.0, 2.0]), (28, 1, 0, [1.0, None, 2.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, m int, layer int, embedding array<float>, space string, item string")
    ok = forest.usable(df, "m", "embedding")
    assert sorted(r["vec_id"] for r in ok.collect()) == [*range(12), 20, 21, 22]
    got = forest.nearest(ok, "vec_id", ["m", "layer"], "embedding", 5).toPandas()
    assert set(got[got.vec_id == 7].neighbour) == {0, 1, 2, 3, 4}
    assert set(got[got.vec_id == 2].neighbour) == {0, 1, 3, 4, 5}
    assert set(got[got.vec_id == 20].neighbour) == {0, 1, 2, 3, 4}
    assert 22 not in set(got.vec_id) and len(got) == 14 * 5
    assert forest.nearest(ok.limit(0), "vec_id", ["m", "layer"], "embedding", 5).count() == 0


def test_prefix_intervals_hold_the_longest_prefix():
    h = np.sort(np.random.default_rng(3).integers(0, 1 << forest.BITS, 500))
    lo, hi = forest.prefix_intervals(h, 20)
    assert ((hi - lo >= 20) & (lo <= np.arange(500)) & (np.arange(500) < hi)).all()
    for i in (0, 250, 499):
        depth = forest.BITS
        while ((h >> (forest.BITS - depth)) == (h[i] >> (forest.BITS - depth))).sum() < 20:
            depth -= 1
        assert hi[i] - lo[i] == ((h >> (forest.BITS - depth)) == (h[i] >> (forest.BITS - depth))).sum()


# 7 ---------------------------------------------------------------------------


def test_leaks(spark, monkeypatch):
    p = "Die Größe der Hülle wächst, wenn das Protein in der Membran bleibt und dort ruht."
    ten = "GRÖSSE der hülle -- WACHST\nwenn (das) Protein; in der Membran"
    docs = [(1, "vorher " + ten + " danach"), (2, "Große der Hülle wächst wenn das Protein in neuer der Membran"), (3, p.upper()), (4, None), (5, ""), (6, "kurz"), (7, ten.replace("GRÖSSE", "Größe") + " " + "x " * 50_000), (8, "Groesse der Hülle wächst wenn das Protein in der Membran bleibt")]
    items = [(10, p), (11, p.split(",")[0] + " " + p), (12, None), (13, "zu kurz")]
    d = spark.createDataFrame([(*r, 1, "t") for r in docs], "doc_id long, text string, span int, t string")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, passage string, d string")
    for bits in (winnowing.MAP_BITS, 1 << 6):  # a map that is full lets all pass
        monkeypatch.setattr(winnowing, "MAP_BITS", bits)
        got = {(r["doc_id"], r["item_id"]): r["span"] for r in winnowing.leaks(d, "doc_id", "text", i, "item_id", "passage").collect()}
        assert {k[0] for k in got} == {1, 3, 7, 8}
        assert got[3, 10] == 15 and got[1, 10] == 10
        assert winnowing.leaks(d.limit(0), "doc_id", "text", i, "item_id", "passage").count() == 0
        assert winnowing.leaks(d, "doc_id", "text", i.limit(0), "item_id", "passage").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=0, max_size=60), st.lists(st.sampled_from("abcd"), min_size=0, max_size=60))
def test_winnowing_finds_every_span_of_ten(a, b):
    """Texts with a common span of ten words share a kept hash that lies in it, so its shift shows the span."""
    spans = {tuple(a[i : i + 10]) for i in range(len(a) - 9)} & {tuple(b[i : i + 10]) for i in range(len(b) - 9)}
    h, count = winnowing.word_hashes([" ".join(a), " ".join(b)])
    own, place, g = winnowing.winnow(h, count)
    kept = [[(x - len(a) * k, y) for o, x, y in zip(own, place, g) if o == k] for k in (0, 1)]
    best = 0
    for x, gx in kept[0]:
        for y, gy in kept[1]:
            if gx == gy:
                lo, shift = max(0, x - y), x - y
                hi = min(len(a), shift + len(b))
                best = max(best, winnowing.longest_run(h[lo:hi], h[len(a) :][lo - shift : hi - shift]))
    assert bool(spans) == (best >= 10)


def test_hot_passage(spark):
    """A passage that every document quotes, and one document that quotes all passages."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(14))) for k in range(30)]
    docs = [(k, f"start {k} {items[0][1]} {word()}") for k in range(300)] + [(999, " und ".join(t for _, t in items))]
    got = {tuple(r) for r in winnowing.leaks(spark.createDataFrame(docs, "d long, t string"), "d", "t", spark.createDataFrame(items, "i long, p string"), "i", "p").collect()}
    assert got == {(k, 0, 14) for k in range(300)} | {(999, k, 14) for k in range(30)}


# 8 ---------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), min_size=1, max_size=8), st.integers(0, 600))
def test_fit_counts_is_best(hist, budget):
    lengths, counts = np.array(sorted(hist)), np.array([hist[k] for k in sorted(hist)])
    take = mixture.fit_counts(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    got = int((take * lengths).sum())
    assert got <= max(budget, 0)
    if budget < (lengths * counts).sum():
        assert budget - got <= lengths.max()


def test_mixture(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "of", "the"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))), s) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + ["c"] * 40)]
    docs += [(1000, None, "a"), (1001, "", "b"), (1002, "x y", None), (1003, "x y", "other"), (None, "x y", "a")] + [(2000 + i, "same text", "a") for i in range(100)]
    d = spark.createDataFrame([(*r, 3) for r in docs], "doc_id long, text string, source string, n_tokens int")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.1, 2), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    chosen, report = mixture.mixture(d, "doc_id", "text", "source", t)
    c, r = chosen.toPandas(), report.toPandas().set_index("source")
    assert c.doc_id.is_unique and not set(c.doc_id) & {1000, 1001, 1002, 1003}
    for s, cap in (("a", 1), ("b", 4), ("c", 2)):
        mine = c[c.source == s]
        assert mine.repeats.between(1, cap).all()
        assert (mine.repeats * mine.n_tokens).sum() == r.tokens_used[s] <= r.budget[s]
        assert abs(r.actual_share[s] - r.target_share[s] / 0.9) < 0.01
    assert r.budget["none"] == 0 and r.actual_share["none"] == 0
    again = mixture.mixture(d.repartition(7), "doc_id", "text", "source", t)[0].toPandas()
    assert set(map(tuple, again[["doc_id", "repeats"]].to_numpy())) == set(map(tuple, c[["doc_id", "repeats"]].to_numpy()))
    assert mixture.mixture(d, "doc_id", "text", "source", t, total_tokens=500)[1].toPandas().tokens_used.sum() <= 500
    empty, report = mixture.mixture(d.limit(0), "doc_id", "text", "source", t)
    assert empty.count() == 0 and report.count() == 4


# 9 ---------------------------------------------------------------------------


def test_quality_statistics(spark):
    texts = [(1, "The cat is on the mat. It sleeps."), (2, ""), (3, None), (4, "*** --- !!!"), (5, "word " * 30_000), (6, "a|b|c\n1|2|3"), (1, "The cat is on the mat. It sleeps.")]
    d = spark.createDataFrame([(*t, "x", 2.0) for t in texts], "doc_id long, text string, t string, word_count double")
    common = spark.createDataFrame([("en", "the"), ("en", "is"), ("en", "on"), ("en", "it"), (None, "x"), ("de", None)], "lang string, word string")
    got = quality.quality(d, "doc_id", "text", common).toPandas()
    assert len(got) == 7
    one = got[got.doc_id == 1].iloc[0]
    assert one.word_count == 8 and abs(one.common_share - 5 / 8) < 1e-9 and one.punctuated_lines == 1 and one.mean_word_length == 3
    by = got.drop_duplicates("doc_id").set_index("doc_id")
    assert by.word_count[2] == 0 and not by.is_prose[2] and not by.is_prose[4]
    assert by.word_count[5] == 30_000
    assert pd.isna(by.is_prose[3]) and pd.isna(by.word_count[3])
    assert quality.quality(d.limit(0), "doc_id", "text", common).count() == 0
    assert quality.quality(d, "doc_id", "text", common.limit(0)).count() == 7


def test_quality_on_the_tables(spark):  # the judged texts are on other subjects than the tables
    """Fitted on a larger table, the model tells the hand-checked texts and planted junk."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, "doc_id", "text", spark.read.parquet(f"{folder}/common_words.parquet"))
    p = model.probability(model.features([t for t, _ in holdout.JUDGED]))
    truth = np.array([y for _, y in holdout.JUDGED])
    print("judged", ((p >= 0.5) == truth).mean(), [(t[:40], round(x, 2)) for (t, y), x in zip(holdout.JUDGED, p) if (x >= 0.5) != y])
    assert ((p >= 0.5) == truth).mean() >= 0.75 and (p[~truth] < 0.5).mean() >= 0.9
    prose = [r["text"] for r in docs.where("text like '%the%' and text not like '%|%'").limit(60).collect()]
    rng = random.Random(1)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in prose if len(t.split()) > 60]
    assert (model.probability(model.features(mixed)) < 0.5).mean() >= 0.9
    tables = ["\n".join(f"FX{rng.randrange(10**6)}\tGO:{rng.randrange(10**6)}\t0.{rng.randrange(999)}" for _ in range(30)) for _ in range(20)]
    assert (model.probability(model.features(tables)) < 0.5).all()


@given(st.lists(st.integers(0, 50), max_size=30), st.integers(1, 60))
def test_portions_cover_all_rows(sizes, most):
    from annoweave.llm.portions import portions

    got = list(portions(sizes, most))
    assert [i for lo, hi in got for i in range(lo, hi)] == list(range(len(sizes)))
    assert all(sum(sizes[lo:hi]) <= most or hi == lo + 1 for lo, hi in got)


def test_texts_of_any_signs(spark):
    rows = [(0, "acdefghiklmn é中 pq"), (1, ""), (2, None), (3, "ACDEFGHIKLMN é中 PQ"), (4, "12345678901")]
    distinct = near_duplicates.distinct_texts(spark.createDataFrame(rows, "id long, t string"), "t")
    links = near_duplicates.similar_texts(distinct, "t").collect()
    assert len(links) == 1


def test_common_words_are_never_cut(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    words = spark.range(10_001).select(F.lit("aa").alias("lang"), F.col("id").cast("string").alias("word")).union(spark.createDataFrame([("zz", "last")], "lang string, word string"))
    seen = []
    monkeypatch.setattr(quality, "Common", lambda x: seen.extend(x))
    monkeypatch.setattr(quality, "Prose", lambda common, texts: None)
    quality.fit(docs, "doc_id", "text", words)
    assert len(seen) == 10_002 and seen[-1] == ("zz", "last")
    monkeypatch.setattr(quality, "MOST_WORDS", 10_000)
    with pytest.raises(ValueError, match="common words"):
        quality.fit(docs, "doc_id", "text", words)
