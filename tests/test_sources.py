"""Record files, settings, sinks, the stream and the clients of external models, on small files of their own."""

import http.server
import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tariffspark.operators import extraction, rulings, suffix
from tariffspark.sources import files, sinks
from tariffspark.streaming import queue

ROWS = [{"description": " Bolt, steel ", "hts_code": "7318.15.20", "materials": "steel", "weight": 3}, {"description": "", "hts_code": "1", "materials": None, "weight": 4}, {"description": "No code", "hts_code": None, "materials": "x", "weight": 5}]


def put(path, body):
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_record_files(spark, tmp_path):
    """SC1-SC7: four formats give the same record; blanks go; other fields are metadata."""
    paths = [
        put(tmp_path / "a.jsonl", "\n".join(map(json.dumps, ROWS))), put(tmp_path / "b.json", json.dumps(ROWS)), put(tmp_path / "c.json", json.dumps({"records": ROWS})),
        put(tmp_path / "d.csv", '\ufeffdescription,hts_code,materials,weight\n" Bolt, steel ",7318.15.20,steel,3\n,1,,4\nNo code,,x,5\n'), put(tmp_path / "e.yaml", json.dumps({"items": ROWS})),
    ]
    for p in paths:
        r = files.load(spark, p).collect()
        assert [(x.description, x.hts_code, x.materials, x.source) for x in r] == [("Bolt, steel", "7318.15.20", "steel", p.rsplit("/", 1)[-1])]
        assert str(json.loads(r[0].metadata)["weight"]) == "3"
    assert files.ingest(spark, paths).count() == len(paths)
    one = files.load(spark, paths[0], schema="description string, hts_code string").collect()
    assert [(x.description, x.materials, x.metadata) for x in one] == [("Bolt, steel", None, "{}")]


def test_other_fields_and_missing_files(spark, tmp_path):
    p = put(tmp_path / "x.jsonl", '{"text": "a thing", "code": "0101.21"}')
    assert [(x.description, x.hts_code) for x in files.load(spark, p, "text", "code").collect()] == [("a thing", "0101.21")]
    gone = files.load(spark, str(tmp_path / "gone.jsonl"))
    assert gone.count() == 0 and gone.columns == files.load(spark, p, "text", "code").columns
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load(spark, put(tmp_path / "bad.jsonl", '{"description": "a", "hts_code": "1"}\n{broken')).collect()


def test_settings_and_glossary(spark, tmp_path, monkeypatch):
    """SC8, SC10, SC11."""
    p = put(tmp_path / "s.yaml", "split:\n  val: 0.2\n  seed: 7\n")
    assert files.settings(spark, p, files.SplitSettings, "split") == files.SplitSettings(val=0.2, seed=7)
    for bad in ("split:\n  vall: 1\n", "split:\n  seed: often\n"):
        with pytest.raises(ValueError):
            files.settings(spark, put(tmp_path / "t.yaml", bad), files.SplitSettings, "split")
    rows = spark.createDataFrame([(0, " Bolt", "old"), (1, "bolt", "new"), (2, "", "x"), (3, "nut", None)], "line int, term string, definition string")
    assert [tuple(r) for r in files.glossary(rows).collect()] == [("bolt", "new")]
    monkeypatch.delenv("DATABASE_URL", raising=False)
    with pytest.raises(ValueError):
        files.database_url()
    monkeypatch.setenv("DATABASE_URL", "jdbc:x")
    assert files.database_url() == "jdbc:x"


def test_sinks(spark, tmp_path):
    """SK1-SK3, SK6-SK9, SK11."""
    df = spark.createDataFrame([(1, None, "train"), (2, "b", "test")], "id int, t string, split string")
    out = str(tmp_path / "out")
    assert sinks.lines(spark, out) is None
    sinks.jsonl(df, out)
    assert sinks.lines(spark, out) == 2 and '"t":null' in "".join(r.value for r in spark.read.text(out).collect())
    with pytest.raises(AnalysisException):
        sinks.jsonl(df, out)
    sinks.jsonl(df, out, mode="append")
    assert sinks.lines(spark, out) == 4
    sinks.jsonl(df, f"{out}2", by="split")
    assert sorted(r.split for r in spark.read.json(f"{out}2").collect()) == ["test", "train"]
    sinks.small(spark, df, f"{out}.json")
    assert json.loads((tmp_path / "out.json").read_text()) == [{"id": 1, "t": None, "split": "train"}, {"id": 2, "t": "b", "split": "test"}]
    sinks.small(spark, {"a": ["é"]}, f"{out}.yaml")
    assert (tmp_path / "out.yaml").read_text(encoding="utf-8") == "a:\n- é\n"
    with pytest.raises(ValueError):
        sinks.small(spark, df, f"{out}.json", rows=1)
    first = sinks.run_dir(spark, str(tmp_path / "runs"), {"seed": 1}, now=datetime(2024, 1, 2, 3, 4, 5))
    assert first.endswith("runs/run_20240102_030405") and sinks.latest(spark, str(tmp_path / "runs")) == first
    assert json.loads((tmp_path / "runs/run_20240102_030405/config_snapshot.json").read_text()) == {"seed": 1}
    table = str(tmp_path / "table")
    assert rulings.ensured(spark, table).count() == 0
    row = spark.createDataFrame([("N1", 0)], "ruling_number string, product_idx int")
    rulings.upserted(rulings.ensured(spark, table), row, ["ruling_number", "product_idx"], "extracted_at").write.mode("overwrite").parquet(f"{table}2")
    kept = rulings.ensured(spark, f"{table}2").collect()
    assert len(kept) == 1 and kept[0].extracted_at is not None and kept[0].description is None


def test_report(spark):
    """SK8, WN11, ST31."""
    body = sinks.report(spark.createDataFrame([(1200, 0.5)], "total long, exact_match double"), spark.createDataFrame([("a", 1), ("b", 2000)], "bucket string, n int"), spark.createDataFrame([("01", 5, 0.25), ("02", 9, 1.0)], "chapter string, total int, exact_match double"))
    assert "| total | 1,200 |" in body and "| exact_match | 0.500 |" in body and body.index("| b | 2,000 |") < body.index("| a | 1 |") and body.index("| 02 | 9 | 100.0% |") < body.index("| 01 | 5 | 25.0% |")


def test_stored_index(spark, tmp_path):
    """SC12, FL12."""
    rows = spark.createDataFrame([("8544.30.0010", False), ("8544300010", False), ("854430", False), ("0101210010", True)], "gold_code string, gold_abstain boolean")
    suffix.store(suffix.index(rows), str(tmp_path / "idx"))
    idx = suffix.load(spark, str(tmp_path / "idx"))
    assert [tuple(r) for r in idx.collect()] == [("8544300010", 2)]
    assert tuple(suffix.skipped(rows).first()) == (2, 1, 1)
    preds = spark.createDataFrame([("8544.30.0099", False), ("8544.30.9999", False), ("8544.30.0010", False), (None, False), ("x", True)], "pred string, pred_abstain boolean")
    assert {(r.pred, r.reason, r.pred_after) for r in suffix.complete(preds, idx).collect()} == {
        ("8544.30.0099", "completed", "8544.30.0010"), ("8544.30.9999", "no_8digit_match", "8544.30.9999"), ("8544.30.0010", "valid", "8544.30.0010"), (None, "skipped_no_code", None), ("x", "skipped_abstain", "x"),
    }


def test_queue(spark, tmp_path):
    """What arrives is processed once; keys that are there stay as they are; a batch tried again replaces itself."""
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    step = lambda b: b.withColumn("twice", F.col("k") * 2)
    put_rows = lambda rows: spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").parquet(source)
    run = lambda: queue.process_new(spark, source, "k int, v string", sink, checkpoint, step, ["k"])
    read = lambda: sorted((r.k, r.v, r.twice) for r in spark.read.parquet(sink).collect())
    put_rows([(1, "a"), (2, "b"), (2, "b")])
    run()
    assert read() == [(1, "a", 2), (2, "b", 4)]
    run()
    put_rows([(2, "other"), (3, "c")])
    run()
    assert read() == [(1, "a", 2), (2, "b", 4), (3, "c", 6)]
    import shutil

    shutil.rmtree(checkpoint)  # all files come again, as batch 0: it replaces batch 0, and what batch 1 has is not repeated
    run()
    assert sorted(k for k, *_ in read()) == [1, 2, 3]


class Service(http.server.BaseHTTPRequestHandler):
    def _say(self, body):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def do_GET(self):
        self._say({"data": []})

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        text = asked.get("prompt") or asked["messages"][-1]["content"]
        self._say({"choices": [{"text": f"said {text}", "message": {"content": f"chat {text}"}}]})

    def log_message(self, *args):
        pass


def test_client_and_inference(spark, tmp_path):
    """Section 2.13: the client, calls from UDFs with retries, batches of a model."""
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = extraction.CompletionClient(f"http://127.0.0.1:{server.server_port}", "m")
    assert client.is_reachable() and client.complete([{"role": "user", "content": "x"}])[0] == "chat x" and client.complete_prompt("y")[0] == "said y"
    asked = spark.createDataFrame([("N1", "a"), ("N2", "b")], "ruling_number string, prompt string")
    assert {(r.ruling_number, r.content) for r in extraction.completed(asked, client, (tmp_path / "a").as_uri()).collect()} == {("N1", "said a"), ("N2", "said b")}
    server.shutdown()
    server.server_close()
    assert not client.is_reachable()

    def flaky(p):
        flaky.tries = getattr(flaky, "tries", 0) + 1
        if p == "b" or flaky.tries < 2:
            raise OSError
        return p.upper()

    done = extraction.completed(asked.coalesce(1), flaky, (tmp_path / "b").as_uri(), concurrency=1, wait=0.0)
    assert {(r.ruling_number, r.content) for r in done.collect()} == {("N1", "A"), ("N2", None)}
    assert [tuple(r) for r in rulings.failure_rows(asked, done.where("content is not null")).collect()] == [("N2", 0, rulings.FAILED)]

    def model(prompts):
        assert len(prompts) <= 4 and prompts == sorted(prompts, key=len, reverse=True)
        return [f"<{p}>" for p in prompts]

    records = spark.createDataFrame([(i, "p" * (i * 7 % 11)) for i in range(30)], "id int, prompt string")
    assert {(r.id, r.raw) for r in extraction.predicted(records, model, batch_size=4).collect()} == {(i, "<" + "p" * (i * 7 % 11) + ">") for i in range(30)}
