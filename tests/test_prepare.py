"""Preparation from a settings file to written splits."""

import json

import pytest

from tariffspark.plans import prepare
from tariffspark.plans.catalog import _checkpoint
from tariffspark.sources import files


def test_settings_in_groups(spark, tmp_path):
    path = str(tmp_path / "data.yaml")
    (tmp_path / "data.yaml").write_text("sources:\n- {path: a.csv, format: csv}\nsplit: {val: 0.2}\nabstention: {categories: [x]}\n")
    s = files.settings(spark, path, files.DataSettings)
    assert s.sources == (files.SourceSettings("a.csv", "csv"),) and s.split.val == 0.2 and s.split.test == 0.1 and s.abstention.categories == ("x",) and s.frequency_cap.max_per_code == 100
    for bad in ({"split": {"vall": 1}}, {"split": {"val": "x"}}, {"split": 3}, {"sources": {}}, {"sources": [{"path": 1}]}, {"nothing": 1}):
        with pytest.raises(ValueError):
            files.filled(files.DataSettings, bad)


def test_run(spark, tmp_path):
    """Two sources, bad codes, short texts, repeats, a near-duplicate, a glossary; the splits that are written add up and do not leak."""
    body = "steel bolt number {} with a long thread and a round head for use in wooden ships of the northern fleet"
    rows = [{"description": f"{body.format(k)} {k * k} {k % 7} x{k} y{k}", "hts_code": f"{k % 5 + 1:02d}01.21.0010", "ruling_number": f"N{k // 2}", "materials": "steel" if k % 2 else ""} for k in range(60)]
    rows += [rows[0], {"description": "short", "hts_code": "0101.21"}, {"description": body, "hts_code": "none"}, rows[1] | {"description": rows[1]["description"].upper()}]
    long = " ".join(f"word{k}" for k in range(60))
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    (tmp_path / "b.json").write_text(json.dumps({"records": [{"text": long, "code": "0909.10"}, {"text": f"{long} more", "code": "0909.20"}]}))
    (tmp_path / "terms.jsonl").write_text("\n".join(json.dumps({"term": t, "definition": f"on {t}"}) for t in ("Steel Bolt", "ship", "round head")))
    settings = files.filled(files.DataSettings, {
        "sources": [{"path": str(tmp_path / "a.jsonl")}, {"path": str(tmp_path / "b.json"), "format": "json", "text_field": "text", "code_field": "code"}],
        "abstention": {"rate": 0.25}, "split": {"val": 0.2, "test": 0.2}, "glossary_path": str(tmp_path / "terms.jsonl"), "output_dir": str(tmp_path / "out"), "formatted_dir": str(tmp_path / "formatted"),
    })
    found = prepare.run(spark, settings, _checkpoint(spark))
    assert found["leaking_rulings"] == 0 and found["splits"]["total"] == 61
    assert sum(found["splits"][k] for k in ("train", "valid", "test")) == 61 and min(found["splits"].values()) > 0
    assert json.loads((tmp_path / "out/audit.json").read_text()) == found
    written = spark.read.json(settings.formatted_dir).collect()
    assert len(written) == 61 and sum(r.abstain for r in written) == 15 == found["abstentions"]["n_abstain"]
    assert all([m.role for m in r.messages] == ["system", "user", "assistant"] for r in written)
    asked = [r.messages[1].content for r in written if r.input_variant == "glossary_enriched" and not r.abstain]
    assert asked and any("- steel bolt: on Steel Bolt" in a and "- round head" in a and "- ship" not in a for a in asked), asked[:2]
    assert all((r.hts_code == "__ABSTAIN__") == r.abstain for r in written)
