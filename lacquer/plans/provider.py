"""Model calls as a partition function with a cache: any provider, a deterministic stand-in."""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacquer.sources.texts import read_settings

RESULT_SCHEMA = "request_hash string, content string, finish_reason string, error string"


@dataclass(frozen=True)
class Answer:
    content: str
    finish_reason: str | None = "stop"


@dataclass(frozen=True)
class StubProvider:
    """Answers by rule from the prompt alone, so a repeated task repeats its answers."""

    mode: str = "echo"

    def chat(self, prompt: str, max_tokens: int, temperature: float) -> Answer:
        body = prompt.rsplit("\n---\n", 1)[-1]
        if self.mode == "validate":
            return Answer("PASS")
        if self.mode == "fix" or self.mode == "translate" and body.startswith('{"line":'):  # an object for each object sent, one for a line nobody sent, and talk around them
            sent = [json.loads(x)["line"] for x in body.split("\n") if x.startswith("{")]
            return Answer("\n".join(["Here they are:", *(json.dumps({"line": n, "vi": f" line {n} "}) for n in sent), json.dumps({"line": 10**6, "vi": "nobody asked"})]))
        if self.mode == "jsonl":
            mark = hashlib.sha1(body.encode()).hexdigest()[:8]
            return Answer('{"event_title_zh": "%s", "event_summary_zh": "%s", "entities": ["%s"]}' % (mark, mark * 2, mark[:4]))
        return Answer(f"[{hashlib.sha1(body.encode()).hexdigest()[:8]}] {body}"[: 3 * max_tokens])


#: What the environment may set.
SETTINGS = ("LLM_BASE_URL", "LLM_MODEL", "LLM_API_KEY", "LLM_TIMEOUT_S", "LLM_TIMEOUT", "LLM_MAX_RETRIES", "LLM_SEND_LIMIT")


def switch(settings: dict[str, str], name: str, default: bool, empty: bool | None = None) -> bool:
    """A setting as yes or no: everything but 0, false, no and off is yes; an empty one is ``empty``, or the default."""
    said = settings.get(name)
    if said is None:
        return default
    if not said.strip():
        return default if empty is None else empty
    return said.strip().lower() not in ("0", "false", "no", "off")


@dataclass(frozen=True)
class HttpProvider:
    """A chat endpoint of the common completions form; settings may come from the environment."""

    base: str
    model: str
    key: str = ""
    timeout: float = 120.0
    send_limit: bool = True
    system: str = "You work on long-form texts."

    @classmethod
    def from_settings(cls, settings: dict[str, str]) -> HttpProvider:
        """``LLM_BASE_URL``, ``LLM_MODEL``, ``LLM_API_KEY``, ``LLM_TIMEOUT_S`` (or ``LLM_TIMEOUT``) and ``LLM_SEND_LIMIT`` (0 leaves the limit out)."""
        return cls(
            settings.get("LLM_BASE_URL", "http://127.0.0.1:8000"), settings.get("LLM_MODEL", "local"), settings.get("LLM_API_KEY", ""),
            float(settings.get("LLM_TIMEOUT_S") or settings.get("LLM_TIMEOUT") or 120), switch(settings, "LLM_SEND_LIMIT", True),
        )

    @classmethod
    def from_environment(cls, path: str = ".env", environment: dict[str, str] | None = None) -> HttpProvider:
        """``from_settings`` of a settings file and the environment, which wins."""
        return cls.from_settings(read_settings(path, environment, SETTINGS))

    def chat(self, prompt: str, max_tokens: int, temperature: float) -> Answer:
        """One completion; a blank content gives way to the reasoning text.  An answer without choices is no answer to retry."""
        body = {"model": self.model, "messages": [{"role": "system", "content": self.system}, {"role": "user", "content": prompt}], "temperature": temperature}
        if self.send_limit:
            body["max_tokens"] = max_tokens
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.base.rstrip("/") + "/v1/chat/completions", json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            got = json.loads(reply.read())
        if not got.get("choices"):
            raise RuntimeError("the answer has no choices")
        first = got["choices"][0]
        message = first.get("message") or {}
        texts = (message.get("content"), message.get("reasoning_content"), first.get("reasoning_content"))
        return Answer(next((t for t in texts if isinstance(t, str) and t.strip()), ""), first.get("finish_reason"))


@dataclass(frozen=True)
class Retry:
    """Attempts and waits: ``min(2**k, longest)`` seconds, with jitter."""

    attempts: int = 3
    longest: float = 8.0
    sleep: Callable[[float], None] = field(default=time.sleep)

    @classmethod
    def from_settings(cls, settings: dict[str, str]) -> Retry:
        """``LLM_MAX_RETRIES``: how often a request is tried."""
        return cls(attempts=max(1, int(settings.get("LLM_MAX_RETRIES") or 3)))

    def run(self, call: Callable[[], Answer]) -> Answer:
        for k in range(self.attempts):
            try:
                return call()
            except (OSError, ValueError):
                if k + 1 == self.attempts:
                    raise
                self.sleep(min(2**k, self.longest) * (0.5 + random.random() / 2))
        raise AssertionError


def request_hash(*parts: Column | str) -> Column:
    """The key of a request: equal requests are asked once."""
    return F.sha2(F.to_json(F.array(*[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])), 256)


def ask(requests: DataFrame, provider: object, max_tokens: int, temperature: float = 0.2, cache: DataFrame | None = None, parallel: int | None = None, retry: Retry | None = None) -> DataFrame:
    """``(request_hash, content, finish_reason, error)`` for each distinct prompt.

    ``requests`` has a column ``prompt``.  What the cache holds is not asked again; a failing
    request becomes a row with an error and stops nobody else.
    """
    retry = retry or Retry()
    wanted = requests.where("prompt is not null").select(request_hash("prompt", F.lit(max_tokens), F.lit(temperature)).alias("request_hash"), "prompt").dropDuplicates(["request_hash"])
    if cache is not None:
        kept = cache.where("error is null").select("request_hash", "content", "finish_reason", "error").dropDuplicates(["request_hash"]).join(wanted.select("request_hash"), "request_hash", "left_semi")
        wanted = wanted.join(cache.where("error is null").select("request_hash").distinct(), "request_hash", "left_anti")
    if parallel:
        wanted = wanted.repartition(parallel)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, prompt in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    a = retry.run(lambda p=prompt: provider.chat(p, max_tokens, temperature))
                    rows.append((key, a.content, a.finish_reason, None))
                except Exception as e:  # noqa: BLE001 - the row carries it
                    rows.append((key, None, None, repr(e)[:500]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["request_hash", "content", "finish_reason", "error"])

    fresh = wanted.mapInArrow(run, RESULT_SCHEMA)
    return fresh.unionByName(kept) if cache is not None else fresh
