"""Calls to a text generator from executors, with retries, resume and reports.

A provider is any picklable object with ``generate(prompt) -> Reply``. Calls run in ``mapInPandas`` with a small thread pool per
task, so the number of calls in flight is tasks at a time x threads. Replies are written to a table before anything reads
them: no later stage can cause a second call.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Reply:
    success: bool
    text: str = ""
    error: str = ""
    latency_ms: int = 0


class Provider(Protocol):
    def generate(self, prompt: str) -> Reply: ...


@dataclass(frozen=True)
class MockProvider:
    """Deterministic replies for tests: by the md5 of the prompt, one in fail_every fails and one in broken_every is no JSON."""

    fail_every: int = 10
    broken_every: int = 7

    def generate(self, prompt: str) -> Reply:
        h = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16)
        if self.fail_every and h % self.fail_every == 0:
            return Reply(False, error="mock failure")
        if self.broken_every and h % self.broken_every == 0:
            return Reply(True, "the model answers: 42", latency_ms=h % 500)
        return Reply(True, json.dumps({"reasoning": f"seed {h}", "final_answer": str(h % 1000), "score": h % 2, "is_consistent": h % 3 == 0, "mismatch_type": "rounding" if h % 5 == 0 else "value_error"}), latency_ms=h % 500)


def stream_text(lines: Iterator[str]) -> str:
    """Text of a server-sent-event stream of either message or delta events; [DONE] ends it, unreadable events are skipped."""
    out = []
    for line in lines:
        if not line.startswith("data:"):
            continue
        data = line[5:].strip()
        if data == "[DONE]":
            break
        try:
            e = json.loads(data)
        except ValueError:
            continue
        if isinstance(e.get("delta"), str):
            out.append(e["delta"])
        for c in e.get("choices") or []:
            part = (c.get("delta") or c.get("message") or {}).get("content")
            if part:
                out.append(part)
    return "".join(out)


def body_text(payload: dict) -> str:
    """Text of a complete reply of a chat-completions or a responses endpoint."""
    if isinstance(payload.get("output_text"), str):
        return payload["output_text"]
    for c in payload.get("choices") or []:
        got = (c.get("message") or {}).get("content")
        if isinstance(got, str):
            return got
        if isinstance(got, list):
            return "".join(p.get("text", "") for p in got if isinstance(p, dict))
    return "".join(p.get("text", "") for o in payload.get("output") or [] for p in o.get("content") or [] if isinstance(p, dict))


@dataclass(frozen=True)
class HttpProvider:
    """Chat-completions or (with effort) responses endpoint; tries again after min(2^k, 8) seconds, tries + 1 times in all."""

    url: str
    key: str
    model: str
    timeout: float = 120
    retries: int = 3
    temperature: float = 0.2
    max_tokens: int = 4096
    effort: str | None = None
    extra: dict = field(default_factory=dict)

    def payload(self, prompt: str) -> dict:
        if self.effort:
            return {"model": self.model, "input": prompt, "reasoning": {"effort": self.effort}, "max_output_tokens": self.max_tokens, **self.extra}
        return {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens, **self.extra}

    def generate(self, prompt: str) -> Reply:
        error, began = "", time.monotonic()
        for k in range(self.retries + 1):
            if k:
                time.sleep(min(2 ** (k - 1), 8))
            began = time.monotonic()
            try:
                req = urllib.request.Request(self.url, json.dumps(self.payload(prompt)).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
                with urllib.request.urlopen(req, timeout=self.timeout) as r:
                    ms = int((time.monotonic() - began) * 1000)
                    raw = r.read().decode("utf-8", "replace")
                text = stream_text(iter(raw.splitlines())) if raw.lstrip().startswith("data:") else body_text(json.loads(raw))
                if text:
                    return Reply(True, text, latency_ms=ms)
                error = "empty reply"
            except Exception as e:  # noqa: BLE001 - any failure of a call is a row, not a failed job
                body = getattr(e, "read", lambda: b"")()
                error = f"{e} {body[:4000].decode('utf-8', 'replace')}".strip()
        return Reply(False, error=error, latency_ms=int((time.monotonic() - began) * 1000))


_REPLY = "success boolean, text string, error string, latency_ms int"


def call(prompts: DataFrame, provider: Provider, key: str = "id", prompt: str = "prompt", threads: int = 4, tasks: int | None = None) -> DataFrame:
    """(key, success, text, error, latency_ms) of one call per row, written once. NULL prompts are not sent and fail."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in frames:
                got = list(pool.map(lambda p: provider.generate(p) if isinstance(p, str) else Reply(False, error="no prompt"), pdf["_p"]))
                yield pd.concat([pdf[[key]].reset_index(drop=True), pd.DataFrame([asdict(r) for r in got], columns=["success", "text", "error", "latency_ms"])], axis=1)

    src = prompts.select(key, F.col(prompt).alias("_p"))
    if tasks:
        src = src.repartition(tasks)
    kind = dict(src.dtypes)[key]
    return materialise(src.mapInPandas(run, f"`{key}` {kind}, {_REPLY}"))


def filled(answer: str = "model_answer", reasoning: str = "model_reasoning"):
    """Whether a record already has both outputs."""
    some = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) > 0
    return some(answer) & some(reasoning)


def resume_plan(samples: DataFrame, done: DataFrame, splits: tuple[str, ...] = ("train", "val"), overwrite: bool = False) -> DataFrame:
    """samples with action (L4): reuse (a finished output of the same id exists), skip (already filled or not a split to
    process), pending. done: (id, model_answer, model_reasoning)."""
    have = done.where(filled()).select("id").distinct().withColumn("_done", F.lit(True))
    j = samples.join(have, "id", "left")
    action = F.when(~F.col("split").isin(*splits), "skip").when(F.lit(not overwrite) & F.col("_done").isNotNull(), "reuse").when(F.lit(not overwrite) & filled(), "skip").otherwise("pending")
    return j.withColumn("action", action).drop("_done")


def call_report(calls: DataFrame, by: list[str]) -> DataFrame:
    """Calls per group (L5): n, parsed, parse_failed, api_failed, mean latency over positive ones (0 if none)."""
    lat = F.col("api_latency_ms")
    return calls.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.col("parse_status") == "success").alias("parsed"), F.count_if(F.col("parse_status") == "failed").alias("parse_failed"),
        F.count_if(~F.coalesce(F.col("api_success"), F.lit(False))).alias("api_failed"), F.coalesce(F.avg(F.when(lat > 0, lat)), F.lit(0.0)).alias("mean_latency_ms"),
    )
