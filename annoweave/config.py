"""Run configuration: merging of layers, cleaning of values, weights of the summary.

Everything here is resolved once on the driver; operators get plain values.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote, urlparse

import yaml

_log = logging.getLogger(__name__)

#: Spellings that switch a distance threshold off.
OFF = {"", "false", "off", "disable", "disabled", "none", "null"}
#: Spellings of booleans on a command line.
TRUE, FALSE = {"1", "true", "t", "yes", "y", "on"}, {"0", "false", "f", "no", "n", "off"}
_MEANING = dict.fromkeys(TRUE, True) | dict.fromkeys(FALSE, False)
#: Keys of the lookup section that flat settings may override.
LOOKUP_KEYS = ("use_gpu", "batch_size", "distance_metric", "limit_per_entry", "topgo", "precision", "redundancy", "taxonomy")


def _spelled(value: Any) -> str:
    return str(value).strip().lower()


def threshold(value: Any) -> float | None:
    """A distance threshold, or None for anything that means off (zero and negatives too)."""
    word = _spelled(value)
    return None if word in OFF else max(float(word), 0.0) or None


def boolean(value: Any) -> bool | None:
    """A boolean from its usual spellings; None stays None."""
    try:
        return None if value is None else _MEANING[_spelled(value)]
    except KeyError:
        raise ValueError(f"not a boolean: {value!r}") from None


def metric(name: Any) -> str:
    """cosine or euclidean; anything else falls back to cosine with a warning."""
    word = _spelled(name or "cosine")
    if word not in ("cosine", "euclidean"):
        _log.warning("no distance metric %r, using cosine", name)
        return "cosine"
    return word


def url_name(url: str) -> str:
    """The file name at the end of a URL's path, without query or fragment."""
    return unquote(urlparse(url).path).rstrip("/").rpartition("/")[2]


def layers(values: Iterable[Any] | None) -> list[int]:
    """Sorted distinct layer numbers."""
    return sorted({int(v) for v in values or ()})


def taxa(value: Any) -> list[str]:
    """Taxonomy ids as digit strings, from an int, a string of ids, a list of either, or None."""
    if value is None:
        return []
    if isinstance(value, bool) or not isinstance(value, (int, str, list, tuple, set)):
        raise ValueError(f"taxonomy ids must be a number, a string or a list, not {type(value).__name__}")
    parts = [value] if isinstance(value, (int, str)) else list(value)
    words = [w for p in parts for w in re.split(r"[,\s]+", str(p).strip())]
    return [str(int(w)) for w in words if w.isdigit()]


def overrides(args: Iterable[str]) -> dict[str, Any]:
    """``--key value`` and ``--key=value`` pairs; a key without a value is True."""
    out: dict[str, Any] = {}
    key = None
    for a in args:
        if a.startswith("--"):
            if key:
                out[key] = True
            key, eq, value = a[2:].partition("=")
            key = key.replace("-", "_")
            if eq:
                out[key], key = value, None
        elif key:
            out[key], key = a, None
    if key:
        out[key] = True
    return out


def load(path: str | None, *later: Mapping[str, Any]) -> dict[str, Any]:
    """The YAML file with later settings over it (None values do not override)."""
    if not path:
        return loads("", *later)
    with open(path, encoding="utf-8") as f:
        return loads(f.read(), *later)


def loads(text: str, *later: Mapping[str, Any]) -> dict[str, Any]:
    """The same of YAML text."""
    base = yaml.safe_load(text) or {}
    for layer in later:
        base |= {k: v for k, v in layer.items() if v is not None}
    return resolve(base)


def resolve(raw: Mapping[str, Any]) -> dict[str, Any]:
    """Move old and flat keys to their sections, clean the values, and validate.

    Flat keys of a command line win over a section; old top-level ``redundancy``
    and ``taxonomy`` sections fill only what the lookup section lacks.
    """
    conf = dict(raw)
    lookup = dict(conf.get("lookup") or {})
    embedding = dict(conf.get("embedding") or {})
    for old in ("redundancy", "taxonomy"):
        lookup[old] = {**(conf.pop(old, None) or {}), **(lookup.get(old) or {})}
    for key in LOOKUP_KEYS:
        if key in conf and key not in ("redundancy", "taxonomy"):
            lookup[key] = conf[key]
    renamed = {"redundancy_identity": "identity", "redundancy_filter": "identity", "redundancy_coverage": "coverage", "alignment_coverage": "coverage", "threads": "threads"}
    for flat, key in renamed.items():
        if conf.get(flat) is not None:
            lookup["redundancy"][key] = conf[flat]
    for flat, key in (("taxonomy_ids_to_exclude", "exclude"), ("taxonomy_ids_included_exclusively", "include_only"), ("get_descendants", "get_descendants")):
        if conf.get(flat) is not None:
            lookup["taxonomy"][key] = conf[flat]
    for flat, key in (("device", "device"), ("length_filter", "max_sequence_length"), ("sequence_queue_package", "queue_batch_size")):
        if conf.get(flat) is not None:
            embedding[key] = conf[flat]
    red, tax = lookup["redundancy"], lookup["taxonomy"]
    if red.get("threads") is not None:
        red["threads"] = int(red["threads"])
    red["identity"], red["coverage"] = float(red.get("identity") or 0), float(red.get("coverage") if red.get("coverage") is not None else 0.7)
    if not 0 <= red["identity"] <= 1:
        raise ValueError("redundancy identity must lie in [0, 1]")
    if not 0 < red["coverage"] <= 1:
        raise ValueError("redundancy coverage must lie in (0, 1]")
    tax["exclude"], tax["include_only"] = taxa(tax.get("exclude")), taxa(tax.get("include_only"))
    if boolean(tax.get("get_descendants")):
        raise ValueError("expansion to descendants is disabled; list the taxonomy ids, or expand them with operators.taxonomy.descendants")
    lookup["distance_metric"] = metric(lookup.get("distance_metric"))
    lookup["limit_per_entry"] = int(lookup.get("limit_per_entry") or 1)
    lookup["precision"] = int(lookup.get("precision") if lookup.get("precision") is not None else 4)
    lookup["topgo"] = bool(boolean(lookup.get("topgo"))) if lookup.get("topgo") is not None else True
    conf["limit_execution"] = int(conf.get("limit_execution") or 0)
    if embedding.get("max_sequence_length") is not None:
        embedding["max_sequence_length"] = int(embedding["max_sequence_length"])
    models = embedding.get("models") or {}
    embedding["types"] = [name for name, m in models.items() if boolean((m or {}).get("enabled", False))]
    conf["only_lookup"], conf["only_embedding"] = bool(boolean(conf.get("only_lookup"))), bool(boolean(conf.get("only_embedding")))
    if conf["only_lookup"] and conf["only_embedding"]:
        raise ValueError("only_lookup and only_embedding exclude each other")
    if models and not embedding["types"]:
        raise ValueError("no model is enabled")
    return conf | {"lookup": lookup, "embedding": embedding}


@dataclass(frozen=True)
class Summary:
    """Which aggregates the summary holds, under which names and weights."""

    metrics: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"reliability_index": ("max",), "identity": ("min", "max", "mean"), "identity_sw": ("min", "max", "mean")})
    aliases: Mapping[str, str] = field(default_factory=lambda: {"reliability_index": "ri", "identity": "id_g", "identity_sw": "id_l"})
    weights: Mapping[str, Any] = field(default_factory=lambda: {"reliability_index": {"max": 0.4}, "max_id_g": 0.2, "max_id_l": 0.2, "count": 0.2})
    include_counts: bool = True
    normalize_count: bool = True
    raw_count: bool = False
    prefix: str = "w_"
    k: int = 1
    precision: int = 4

    def columns(self) -> list[tuple[str, str, str]]:
        """(output name, metric, aggregate) of every metric aggregate; unknown aggregates are ignored."""
        out = []
        for name, aggs in self.metrics.items():
            for agg in aggs:
                agg = _aggregate(agg)
                if agg in ("min", "max", "mean"):
                    out.append((f"{agg}_{self.aliases.get(name, name)}", name, agg))
        return out

    def weight_of(self, metric: str, agg: str) -> float | None:
        """The weight of an aggregate, or None if it has none and takes no part.

        The full output name comes first, then the metric, then its alias; the
        latter two may hold a number or a number per aggregate. A name that says
        nothing of this aggregate passes on to the next.
        """
        alias = self.aliases.get(metric, metric)
        for name, by_aggregate in ((f"{agg}_{alias}", False), (metric, True), (alias, True)):
            found = self.weights.get(name)
            if by_aggregate and isinstance(found, Mapping):
                found = next((w for a, w in found.items() if _aggregate(a) == agg and _number(w)), None)
            if _number(found):
                return float(found)
        return None

    def active(self) -> dict[str, float]:
        """Normalised weight by output column, zero weights included; empty if they do not sum to more than 0."""
        found = {name: self.weight_of(m, agg) for name, m, agg in self.columns()}
        if self.include_counts:
            found["count"] = float(self.weights["count"]) if _number(self.weights.get("count")) else None
        weights = {c: w for c, w in found.items() if w is not None}
        total = sum(weights.values())
        return {c: w / total for c, w in weights.items()} if total > 0 else {}


def _number(x: Any) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def _aggregate(name: Any) -> str:
    return {"avg": "mean"}.get(_spelled(name), _spelled(name))


def summary_of(conf: Mapping[str, Any]) -> Summary:
    """The summary that resolved settings ask for."""
    post = (conf.get("postprocess") or {}).get("summary") or {}
    named = {c: c for c in ("metrics", "aliases", "weights", "include_counts")}
    named |= {"normalize_count": "normalize_count_by_limit_per_entry", "raw_count": "export_raw_count", "prefix": "weighted_prefix"}
    given = {ours: post[theirs] for ours, theirs in named.items() if post.get(theirs) is not None}
    if "metrics" in given:
        given["metrics"] = {m: tuple(aggs) for m, aggs in given["metrics"].items()}
    return Summary(**given, k=max(1, conf["lookup"]["limit_per_entry"]), precision=conf["lookup"]["precision"])


def models_of(conf: Mapping[str, Any]) -> dict[str, list[int]]:
    """Enabled models and their layers."""
    models = conf["embedding"].get("models") or {}
    return {name: layers((models[name] or {}).get("layer_index")) for name in conf["embedding"]["types"]}


def thresholds_of(conf: Mapping[str, Any]) -> dict[str, float | None]:
    """Distance threshold of every model that names one."""
    return {name: threshold(m["distance_threshold"]) for name, m in (conf["embedding"].get("models") or {}).items() if m and "distance_threshold" in m}
