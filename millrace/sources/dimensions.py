"""Small dimension tables from YAML or JSON files, run manifests, and per-domain state."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # JSON files are read all the same
    yaml = None

from .sinks import write_document


def load(spark: SparkSession, path: str) -> object:
    """What a YAML or JSON file holds."""
    row = spark.read.text(path, wholetext=True).first()
    body = row.value if row else ""
    if path.endswith((".yaml", ".yml")):
        if yaml is None:
            raise RuntimeError("reading YAML takes the yaml package; JSON files need none")
        return yaml.safe_load(body)
    return json.loads(body or "null")


def styles(spark: SparkSession, found: dict) -> DataFrame:
    """(style_id, label, instruction) of {id: {label, instruction}}; unknown keys are ignored."""
    return spark.createDataFrame([(k, v.get("label", k), v.get("instruction", "")) for k, v in found.items()], "style_id string, label string, instruction string")


def tools(spark: SparkSession, found: dict) -> DataFrame:
    """(name, description, rule, parameters as JSON)."""
    rows = [(k, v.get("description", ""), v.get("invocation_rule"), json.dumps(v.get("parameters", {}), sort_keys=True)) for k, v in found.items()]
    return spark.createDataFrame(rows, "name string, description string, rule string, parameters string")


def domains(spark: SparkSession, found: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Domains (domain, target, seed_templates, themes) and aliases (category, domain, pos)."""
    rows = [(d["key"], int(d.get("target", 0)), list(d.get("seed_templates", [])), list(d.get("themes", []))) for d in found]
    alias = [(a, d["key"], i) for i, (d, a) in enumerate((d, a) for d in found for a in [d["key"], *d.get("aliases", [])])]
    return spark.createDataFrame(rows, "domain string, target long, seed_templates array<string>, themes array<string>"), spark.createDataFrame(alias, "category string, domain string, pos int")


def fingerprint(section: object) -> str:
    """A stable digest of a configuration section."""
    return "sha256-" + hashlib.sha256(json.dumps(section, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def write_run_manifest(scores: DataFrame, path: str, fingerprints: dict[str, str], versions: dict[str, str], incremental: dict | None = None) -> dict:
    """The manifest of a curation run: counts, keep rate, fingerprints, versions and what was reused. One row reaches the driver."""
    total, kept = scores.agg(F.count(F.lit(1)), F.count_if("accepted")).first()
    body = {"input_records": total, "kept": kept, "rejected": total - kept, "keep_rate": round(kept / total, 4) if total else 0.0, "fingerprints": fingerprints, "signal_versions": versions}
    body["incremental"] = incremental or {"input_records": total, "cache_hits_full": 0, "cache_hits_partial": 0, "newly_evaluated": total}
    write_document(scores.sparkSession, path, body)
    return body


def domain_state(rows: DataFrame) -> DataFrame:
    """(domain, accepted, rejected_dup, rejected_other): counters that a seed run saves; rows (domain, outcome)."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return rows.groupBy("domain").agg(n("accepted").alias("accepted"), n("dup").alias("rejected_dup"), F.count_if(~F.col("outcome").isin("accepted", "dup")).alias("rejected_other"))
