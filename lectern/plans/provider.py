"""Model calls behind a keyed cache table, with a deterministic fake for tests."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.budget import backoff_seconds
from lectern.session import materialize

ANSWER = "cache_key string, response_text string, finish_reason string, input_tokens int, output_tokens int"
RETRIES = 3


class ModelError(RuntimeError):
    """A model service refused a call, or answered nothing that can be read."""


class Provider(Protocol):
    """What a model service offers. It is built on the executors, one for each partition."""

    def complete(self, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> tuple[str, str, int, int]:
        """Text, finish reason, input and output tokens."""


@dataclass(frozen=True)
class FakeProvider:
    """Answers that depend on the prompt alone."""

    answer: Callable[[str, str], str]

    def complete(self, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> tuple[str, str, int, int]:
        text = self.answer(system, user)
        cut = text[: max_tokens * 4]
        return cut, "stop" if cut == text else "length", len(user) // 2, len(cut) // 2


def redacted(text: str, secret: str, most: int = 200) -> str:
    """Safe to log: no key, no bearer token, not long."""
    import re

    return re.sub(r"(?i)bearer\s+\S+", "Bearer ***", text.replace(secret, "***") if secret else text)[:most]


@dataclass(frozen=True)
class HttpProvider:
    """A chat completion endpoint. Transport errors, 429 and server errors are tried again, others fail at once. The key is not shown."""

    base_url: str
    model: str
    api_key: str = ""
    timeout: float = 300.0

    def __repr__(self) -> str:
        return f"HttpProvider(base_url={self.base_url!r}, model={self.model!r})"

    def request(self, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> urllib.request.Request:
        messages = [{"role": "system", "content": system}] if system else []
        body: dict = {"model": self.model, "messages": [*messages, {"role": "user", "content": user}], "temperature": temperature, "max_tokens": max_tokens}
        if json_mode:
            body["response_format"] = {"type": "json_object"}
        return urllib.request.Request(f"{self.base_url.rstrip('/')}/v1/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"})

    def complete(self, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> tuple[str, str, int, int]:
        request = self.request(system, user, temperature, max_tokens, json_mode)
        for attempt in range(RETRIES + 1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:  # noqa: S310
                    return record_of(json.load(reply))
            except urllib.error.HTTPError as error:
                if attempt == RETRIES or (error.code != 429 and error.code < 500):
                    raise ModelError(redacted(f"{error.code}: {error.read().decode(errors='replace')}", self.api_key)) from None
            except (urllib.error.URLError, TimeoutError):
                if attempt == RETRIES:
                    raise
            time.sleep(backoff_seconds(attempt))
        raise AssertionError


def record_of(data: dict) -> tuple[str, str, int, int]:
    if not data.get("choices"):
        raise ModelError("no choices in the answer")
    choice, usage = data["choices"][0], data.get("usage") or {}
    return (choice.get("message") or {}).get("content") or "", choice.get("finish_reason") or "stop", int(usage.get("prompt_tokens") or 0), int(usage.get("completion_tokens") or 0)


def cache_key(stage: Column, model: Column, prompt_hash: Column, params: Column, input_hashes: Column) -> Column:
    """SHA-256 of the canonical JSON of a request: keys in order, no spaces, hashes sorted."""
    key = F.struct(F.array_sort(input_hashes).alias("input_hashes"), model.alias("model"), params.alias("params"), prompt_hash.alias("prompt_hash"), stage.alias("stage"))
    return F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256)


def calls_made(requests: DataFrame, provider: Provider) -> DataFrame:
    """One call for each row of ``(cache_key, system, user_text, temperature, max_tokens, json_mode)``; repartition to bound the calls in flight."""

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["cache_key"], *provider.complete(r["system"] or "", r["user_text"] or "", r["temperature"], r["max_tokens"], r["json_mode"])) for r in batch.to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()), strict=True)],
                names=["cache_key", "response_text", "finish_reason", "input_tokens", "output_tokens"],
            )

    return requests.select("cache_key", "system", "user_text", "temperature", "max_tokens", "json_mode").mapInArrow(call, ANSWER)


def completed(requests: DataFrame, cache: DataFrame, provider: Provider, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(answers, new)``: every request with its answer, and the rows to append to the cache.

    Only misses reach the provider. Their answers are written once before they
    are used, so a lost executor doesn't call again for what is there already;
    equal requests are called once. With ``force`` all are called.
    """
    hits = cache.select("cache_key", "response_text", "finish_reason", "input_tokens", "output_tokens").dropDuplicates(["cache_key"])
    distinct = requests.dropDuplicates(["cache_key"])
    misses = distinct if force else distinct.join(hits.select("cache_key"), "cache_key", "left_anti")
    new = materialize(calls_made(misses, provider), "answers")
    known = new if force else hits.unionByName(new)
    return requests.join(known, "cache_key", "left"), new.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def compacted(cache: DataFrame) -> DataFrame:
    """One row for each key, the latest; times in several ISO forms are compared as times."""
    at = F.coalesce(F.try_to_timestamp(F.col("created_at")), F.try_to_timestamp(F.col("created_at"), F.lit("yyyy/MM/dd HH:mm:ss")), F.lit("1970-01-01").cast("timestamp"))
    others = [c for c in cache.columns if c != "cache_key"]
    return cache.groupBy("cache_key").agg(F.max_by(F.struct(*others), F.struct(at, F.xxhash64("response_text"))).alias("row")).select("cache_key", "row.*")


def filled(template: str, **values: Column) -> Column:
    """A template with its ``{names}`` replaced, literally."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def template_sections(text: str) -> dict[str, str]:
    """Templates of one file by name; a line ``---NAME---`` begins each, a later one of a name wins."""
    out: dict[str, list[str]] = {}
    name = None
    for line in text.splitlines():
        bare = line.strip()
        if bare.startswith("---") and bare.endswith("---") and bare.strip("-").isupper():
            name = bare.strip("-")
            out[name] = []
        elif name:
            out[name].append(line)
    return {k: "\n".join(v).strip() for k, v in out.items()}
