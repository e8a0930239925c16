"""External models (ST6-ST11, AG18, FL9, FL13, section 2.13): prompts out, JSON in, rows or a failure; completion client and batch inference."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tariffspark.functions import codes, text

#: The fields of a product in an answer, and the prices of a million tokens read and written.
FIELDS = ("description", "hts_code", "product_use", "materials", "reasoning", "hts_text")
PRICES = (0.20, 1.25)
_PRODUCTS = "array<struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">>"


def prompt(number: Column, tariffs: Column, body: Column) -> Column:
    """ST11."""
    return F.concat(F.lit("Ruling: "), number, F.lit("\nTariffs: "), F.array_join(tariffs, ", "), F.lit("\n\n"), body)


class CompletionClient:
    """An HTTP completion service: messages or a raw prompt in, (text, milliseconds) out. Calls can be pickled, so it goes into UDFs."""

    def __init__(self, base_url: str, model: str, timeout: float = 60.0):
        self.base_url, self.model, self.timeout = base_url.rstrip("/"), model, timeout

    def _post(self, path: str, body: dict) -> tuple[dict, int]:
        began = time.perf_counter()
        request = urllib.request.Request(f"{self.base_url}/{path}", json.dumps(body | {"model": self.model}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer), int((time.perf_counter() - began) * 1000)

    def complete(self, messages: list[dict], max_tokens: int = 512, temperature: float = 0.0) -> tuple[str, int]:
        """By chat messages; the service applies its own template."""
        found, took = self._post("chat/completions", {"messages": messages, "max_tokens": max_tokens, "temperature": temperature})
        return found["choices"][0]["message"].get("content") or "", took

    def complete_prompt(self, prompt: str, max_tokens: int = 512, temperature: float = 0.0) -> tuple[str, int]:
        """By a prompt that is rendered already."""
        found, took = self._post("completions", {"prompt": prompt, "max_tokens": max_tokens, "temperature": temperature})
        return found["choices"][0].get("text") or "", took

    def is_reachable(self) -> bool:
        try:
            with urllib.request.urlopen(f"{self.base_url}/models", timeout=self.timeout):
                return True
        except OSError:
            return False

    def __call__(self, prompt: str) -> tuple[str, int]:
        """The text and the tokens that the service counts for prompt and text together."""
        found, _ = self._post("completions", {"prompt": prompt, "max_tokens": 512, "temperature": 0.0})
        return found["choices"][0].get("text") or "", int((found.get("usage") or {}).get("total_tokens") or 0)


_COMMITTED = "key string, content string, tokens_used long"


def _committed(spark, store: str) -> DataFrame:
    """What the store holds already: files of the chunks that are done."""
    files, root = fs.FileSystem.from_uri(store)
    files.create_dir(root, recursive=True)
    return spark.read.schema(_COMMITTED).parquet(store)


def completed(rulings: DataFrame, client: Callable[[str], str | tuple[str, int]], store: str, chunk: int = 500, concurrency: int = 100, retries: int = 3, wait: float = 4.0, longest: float = 30.0) -> DataFrame:
    """rulings(ruling_number, prompt) with `content` and `tokens_used`, null where the client failed `retries` times.

    Calls cost money, so their results are committed to `store`, a shared folder, `chunk` prompts at a time, under the prompts'
    hash. A task that is tried again takes what is committed, and so does a later run; equal prompts are one call. Within a
    partition prompts are in order of their hash, so that a second try has the same chunks. A lost executor repeats the chunk
    it was at, at most; keep speculation off for such jobs. Failed calls are not committed: the next run tries them.
    One pool a partition; between tries it waits `wait` seconds, doubled each time, `longest` at most.
    """
    spark = rulings.sparkSession
    keyed = rulings.select("ruling_number", "prompt", F.sha2(F.coalesce("prompt", F.lit("")), 256).alias("key"))
    done = _committed(spark, store)
    todo = keyed.select("key", "prompt").dropDuplicates(["key"]).join(done, "key", "left_anti").sortWithinPartitions("key")

    def attempt(p: str) -> tuple[str | None, int | None]:
        for k in range(retries):
            try:
                said = client(p or "")
                return said if isinstance(said, tuple) else (said, None)
            except Exception:  # noqa: BLE001 - whatever the service raises is one more failed try
                if k + 1 < retries:
                    time.sleep(min(wait * 2**k, longest))
        return None, None

    def commit(rows: list[tuple[str, str]], pool: ThreadPoolExecutor) -> int:
        files, root = fs.FileSystem.from_uri(store)
        place = f"{root}/{hashlib.sha256(''.join(k for k, _ in rows).encode()).hexdigest()}.parquet"
        if files.get_file_info(place).type == fs.FileType.NotFound:
            answers = list(pool.map(attempt, [p for _, p in rows]))
            good = [(k, c, n) for (k, _), (c, n) in zip(rows, answers, strict=True) if c is not None]
            table = pa.table([pa.array(x, t) for x, t in zip(zip(*good, strict=True) if good else ([], [], []), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["key", "content", "tokens_used"])
            part = f"{root}/.{uuid.uuid4().hex}"  # no reader sees a half-written file
            pq.write_table(table, part, filesystem=files)
            files.move(part, place)
        return len(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            waiting: list[tuple[str, str]] = []
            for b in batches:
                waiting.extend(zip(b["key"], b["prompt"], strict=True))
                while len(waiting) >= chunk:
                    yield pd.DataFrame({"n": [commit(waiting[:chunk], pool)]})
                    waiting = waiting[chunk:]
            if waiting:
                yield pd.DataFrame({"n": [commit(waiting, pool)]})

    todo.mapInPandas(run, "n long").write.format("noop").mode("overwrite").save()
    found = _committed(spark, store).dropDuplicates(["key"])
    return keyed.join(found, "key", "left").select("ruling_number", "prompt", "content", "tokens_used")


def predicted(records: DataFrame, model: Callable[[list[str]], list[str]], batch_size: int = 16, prompt: str = "prompt") -> DataFrame:
    """Batch inference: records with `raw`, what the model says to their prompts, `batch_size` of them at a time, longest first within an
    Arrow batch so that prompts of like length are padded together. Shape with chat.parsed, which is native."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            order = b[prompt].str.len().fillna(0).sort_values(ascending=False, kind="stable").index
            raw = pd.Series(index=b.index, dtype=object)
            for at in range(0, len(order), batch_size):
                own = order[at : at + batch_size]
                raw.loc[own] = model(b.loc[own, prompt].fillna("").tolist())
            yield b.assign(raw=raw)

    return records.mapInPandas(run, StructType([*records.schema.fields, StructField("raw", StringType())]))


def _parsed(content: Column) -> Column:
    """The answer's object as a variant, NULs gone. Strict JSON if the whole is an object, else the greedy outermost braces; a whole that is
    a list or a string is no answer. The braces are parsed as the one element of a list, since the parser passes over what follows a value."""
    raw = text.stripped(F.replace(F.regexp_replace(content, r"(?<!\\)((?:\\\\)*)\\u0000", "$1"), F.lit("\0"), F.lit("")))
    listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    other = raw.rlike(r'(?s)^(\[.*\]|".*")$') & listed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    block = F.try_parse_json(F.concat(F.lit("["), F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit("")), F.lit("]")))
    alone = F.try_variant_get(block, "$[1]", "variant").isNull()
    return F.when(~F.coalesce(other, F.lit(False)) & alone, F.try_variant_get(block, "$[0]", "variant"))


def products(answers: DataFrame) -> DataFrame:
    """ST6-ST10: a row for each product of answers(ruling_number, content[, tokens_used]) with a description of 15 characters or more.

    The country is the answer's, the other fields are the product's; values that are no strings count by their JSON text. The index
    of skipped products stays; codes that are none become null; tokens and the answer are repeated on each row.
    """
    tokens = F.col("tokens_used") if "tokens_used" in answers.columns else F.lit(None)
    parsed = answers.select("ruling_number", tokens.cast("long").alias("tokens_used"), _parsed(F.col("content")).alias("answer"))
    rows = parsed.select("ruling_number", "tokens_used", "answer", F.posexplode(F.try_variant_get("answer", "$.products", _PRODUCTS)).alias("product_idx", "p"))
    clean = lambda c: F.nullif(text.stripped(c), F.lit(""))
    found = rows.select("ruling_number", "product_idx", *[clean(F.col(f"p.{f}")).alias(f) for f in FIELDS], clean(F.try_variant_get("answer", "$.country", "string")).alias("country"), "tokens_used", F.to_json("answer").alias("raw_response"))
    return found.where(F.length("description") >= 15).withColumn("hts_code", F.when(codes.is_valid(F.col("hts_code")), F.col("hts_code")))


def benchmark(rows: DataFrame) -> DataFrame:
    """FL13: benchmark rows(messages) with two messages or more and a gold code in the second; `hts_code` holds its codes."""
    gold = text.gold_codes(F.col("messages")[1]["content"])
    return rows.where(F.size("messages") >= 2).withColumn("hts_code", gold).where(F.size("hts_code") > 0)


def totals(rows: DataFrame) -> DataFrame:
    """AG18: cost of tokens, four fifths of them read and one fifth written, whole tokens."""
    t = F.sum("tokens_used")
    return rows.agg(F.countDistinct("ruling_number").alias("rulings"), F.count("*").alias("products"), t.alias("tokens"), F.round(F.floor(t * 0.8) * PRICES[0] / 1e6 + F.floor(t * 0.2) * PRICES[1] / 1e6, 2).alias("cost"))
