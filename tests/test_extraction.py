"""Answers of models: parsing against Python's json, and calls that are made once though workers die."""

import json
import os
import re

import pytest
from py4j.protocol import Py4JJavaError

from tariffspark.operators import extraction


def plain(content):
    """The rows of one answer by Python's parser, None where there is no answer."""
    try:
        data = json.loads(content)
    except json.JSONDecodeError:
        block = re.search(r"\{.*\}", content, re.DOTALL)
        if not block:
            return None
        try:
            data = json.loads(block.group())
        except json.JSONDecodeError:
            return None
    if not isinstance(data, dict) or not isinstance(data.get("products"), list):
        return None
    country = (data.get("country") or "").strip() or None
    rows = []
    for i, p in enumerate(data["products"]):
        if isinstance(p, dict) and len((p.get("description") or "").strip()) >= 15:
            rows.append((i, p["description"].strip(), (p.get("hts_text") or "").strip() or None, country))
    return rows or None


def test_answers(spark):
    good = json.dumps({"products": [{"description": "a description that is long"}, 3, {"description": "short"}, {"description": " another one, just as long ", "hts_text": " Other "}, None], "country": " Peru ", "more": {"x": [1]}})
    said = [good, f"5 {good}", f"Sure!\n{good}\nbye", f"{good} {good}", f"{good}, {good}", f"[{good}]", f"[note] {good}", json.dumps(good), good[:-1], "{}", '{"products":{}}', '{"products":[]}', '{"products":null}', "", "none", "7", "[1, 2]", f"\n\t{good} \n", f"{{}} {good}", '{"a": 1', good.replace("Peru", "P\\u00e9rou")]
    answers = spark.createDataFrame([(str(k), c) for k, c in enumerate([*said, None])], "ruling_number string, content string")
    found = {}
    for r in extraction.products(answers).collect():
        assert r.tokens_used is None and json.loads(r.raw_response)["products"]
        found.setdefault(int(r.ruling_number), []).append((r.product_idx, r.description, r.hts_text, r.country))
    assert {k: sorted(v) for k, v in found.items()} == {k: plain(c) for k, c in enumerate(said) if plain(c)}
    assert set(found) == {0, 1, 2, 6, 17, 20}


def test_nul_and_tokens(spark):
    rows = [("1", json.dumps({"products": [{"description": "with a \x00 in the middle", "materials": r"a\u0000b"}]}), 12), ("2", "{", 5)]
    found = extraction.products(spark.createDataFrame(rows, "ruling_number string, content string, tokens_used int")).collect()
    assert [(r.description, r.materials, r.tokens_used) for r in found] == [("with a  in the middle", r"a\u0000b", 12)]


@pytest.mark.parametrize("chunk", [1, 4])
def test_calls_are_made_once(spark, tmp_path, chunk):
    """A worker dies in the middle; the second run makes the calls that were not committed, and a third none."""
    log, store = str(tmp_path / "calls"), (tmp_path / "store").as_uri()

    def calls():
        with open(log) as f:
            return f.read().split()

    def client(prompt):
        if os.path.exists(log) and not os.path.exists(log + ".died") and os.path.getsize(log) > 60:
            open(log + ".died", "w").close()
            os._exit(1)
        if prompt == "p13":
            raise OSError("refused")
        with open(log, "a") as f:
            f.write(f"{prompt}\n")
        return f"said {prompt}", 7

    rulings = spark.createDataFrame([(f"r{k}", f"p{k % 30}") for k in range(40)], "ruling_number string, prompt string").coalesce(1)
    args = {"chunk": chunk, "concurrency": 1, "retries": 1}
    with pytest.raises(Py4JJavaError):
        extraction.completed(rulings, client, store, **args)
    first = len(calls())
    assert 0 < first < 29
    rows = extraction.completed(rulings, client, store, **args).collect()
    assert sorted((r.ruling_number, r.content, r.tokens_used) for r in rows) == sorted((f"r{k}", None if k % 30 == 13 else f"said p{k % 30}", None if k % 30 == 13 else 7) for k in range(40))
    repeated = len(calls()) - len(set(calls()))
    assert len(set(calls())) == 29 and repeated < chunk
    extraction.completed(rulings, client, store, **args).count()
    assert len(calls()) == 29 + repeated
