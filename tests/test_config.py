import pytest

from annoweave import config
from annoweave.config import Summary


@pytest.mark.parametrize("value, expected", [(None, None), (False, None), ("off", None), ("0", None), (0, None), (-1, None), ("0.5", 0.5), (0.5, 0.5), ("", None), ("None", None), ("disabled", None)])
def test_threshold(value, expected):
    assert config.threshold(value) == expected


def test_shipped_weights():
    active = Summary().active()
    assert active == pytest.approx({"max_ri": 0.4, "max_id_g": 0.2, "max_id_l": 0.2, "count": 0.2})


def test_weight_forms():
    s = Summary(metrics={"identity": ("min", "avg", "median"), "x": ("max",), "y": ("max",)}, aliases={"identity": "id", "y": "why"}, weights={"identity": 0.5, "min_id": 2, "x": {"max": 1}, "why": 0.25}, include_counts=False)
    assert [c for c, _, _ in s.columns()] == ["min_id", "mean_id", "max_x", "max_why"]
    assert [s.weight_of(m, a) for _, m, a in s.columns()] == [2, 0.5, 1, 0.25]
    assert Summary(weights={}).active() == {}
    one = lambda metric, agg, **w: Summary(metrics={metric: (agg,)}, weights=w, include_counts=False).active()
    assert one("reliability_index", "max", ri={"max": 0.4}) == {"max_ri": 1.0}
    assert one("reliability_index", "mean", reliability_index={"avg": 0.3}) == {"mean_ri": 1.0}
    both = Summary(metrics={"reliability_index": ("max", "mean", "min")}, weights={"reliability_index": {"max": 0.4}, "ri": 0.2, "min_ri": 0}, include_counts=False)
    assert both.active() == pytest.approx({"max_ri": 2 / 3, "mean_ri": 1 / 3, "min_ri": 0.0}) and both.active()["min_ri"] == 0
    assert Summary(weights={"count": -1}).active() == {}


def test_settings_reach_the_run(caplog):
    from annoweave import cli

    conf = config.resolve({"limit_per_entry": "3", "taxonomy_ids_to_exclude": "9,10", "redundancy_identity": "0.9", "threads": "4", "embedding": {"models": {"A": {"enabled": True, "layer_index": [3, 0], "distance_threshold": 0.5}, "B": {"enabled": "no"}}}, "lookup": {"topgo": "off", "precision": 2}, "postprocess": {"keep_sequences": False, "summary": {"metrics": {"identity": ["avg"]}, "weights": {"identity": 1}, "export_raw_count": True}}})
    look, summary = cli.lookup_of(conf), config.summary_of(conf)
    assert (look.k, look.exclude, look.redundancy_identity, look.keep_sequences, look.precision, look.thresholds) == (3, ["9", "10"], 0.9, False, 2, {"A": 0.5})
    assert (summary.k, summary.precision, summary.raw_count) == (3, 2, True) and summary.columns() == [("mean_id_g", "identity", "mean")]
    assert config.models_of(conf) == {"A": [0, 3]} and conf["lookup"]["redundancy"]["threads"] == 4 and conf["lookup"]["topgo"] is False
    assert config.metric("manhattan") == "cosine" and "manhattan" in caplog.text
    assert config.url_name("https://x.org/a/b%20c.backup?download=1") == "b c.backup"


def test_taxa():
    assert config.taxa(9606) == ["9606"]
    assert config.taxa("1,2 3") == ["1", "2", "3"]
    assert config.taxa(["07", 8, "x", "9 10"]) == ["7", "8", "9", "10"]
    assert config.taxa(None) == []
    with pytest.raises(ValueError):
        config.taxa(1.5)


def test_overrides_and_layers():
    assert config.overrides(["--a", "1", "--b-c=2", "--flag", "--d", "x"]) == {"a": "1", "b_c": "2", "flag": True, "d": "x"}
    assert config.layers(["3", 1, 1]) == [1, 3]


def test_resolve(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("redundancy: {identity: 0.9}\nlookup: {distance_metric: manhattan, redundancy: {coverage: 0.5}}\nembedding: {models: {A: {enabled: true}, B: {}}}\n")
    c = config.load(str(f), {"limit_per_entry": "5", "taxonomy_ids_to_exclude": "1,2", "redundancy_identity": None, "length_filter": 100})
    assert c["lookup"]["distance_metric"] == "cosine" and c["lookup"]["limit_per_entry"] == 5 and c["lookup"]["precision"] == 4
    assert c["lookup"]["redundancy"] == {"identity": 0.9, "coverage": 0.5}
    assert c["lookup"]["taxonomy"]["exclude"] == ["1", "2"] and c["embedding"]["types"] == ["A"] and c["embedding"]["max_sequence_length"] == 100


@pytest.mark.parametrize("bad", [{"redundancy_identity": 1.5}, {"alignment_coverage": -0.1}, {"only_lookup": True, "only_embedding": "yes"}, {"get_descendants": "true"}, {"embedding": {"models": {"A": {"enabled": False}}}}])
def test_resolve_rejects(bad):
    with pytest.raises(ValueError):
        config.resolve(bad)
