"""Text generation behind one interface; the default is deterministic and offline.

A provider is built on each executor from a small picklable description and called once per row of a partition, with
retries inside. Cheap native filters and dedup belong before it, in frames of their own.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..shipping import importable
from .scratch import cut


class Provider:
    """Answers a prompt, or None if it can't."""

    workers = 1
    #: Replies that cost money or time are checkpointed, so that neither a further action nor a lost executor asks again.
    keep = True

    def reply(self, prompt: str, model: str) -> str | None:
        raise NotImplementedError


@dataclass
class Offline(Provider):
    """A reply made from the prompt's hash; ``missing`` of a thousand prompts get none."""

    keep = False
    missing: int = 0

    def reply(self, prompt: str, model: str) -> str | None:
        h = int(hashlib.md5(f"{model}|{prompt}".encode()).hexdigest()[:8], 16)
        return None if h % 1000 < self.missing else f"<think>offline {h % 97}</think>\n{h % 1000}"


@dataclass
class Echo(Provider):
    """The prompt itself, for plans whose model step should change nothing."""

    keep = False

    def reply(self, prompt: str, model: str) -> str | None:
        return prompt


def parse_chat(data: dict) -> str | None:
    """Text of a chat completion: content (string or parts), with separate reasoning in think tags."""
    try:
        message = data["choices"][0]["message"]
    except (KeyError, IndexError, TypeError):
        return None
    content = message.get("content") or ""
    if isinstance(content, list):
        content = "".join(p.get("text", "") if isinstance(p, dict) else str(p) for p in content)
    reasoning = message.get("reasoning_content") or message.get("reasoning") or ""
    if reasoning and "<think>" not in content:
        content = f"<think>{reasoning}</think>\n{content}"
    return content.strip() or None


def chat_url(endpoint: str) -> str:
    """The chat-completions address of an endpoint given with or without its path."""
    base = endpoint.rstrip("/")
    if base.endswith("/chat/completions"):
        return base
    return f"{base}/chat/completions" if base.endswith("/v1") else f"{base}/v1/chat/completions"


@dataclass
class Http(Provider):
    """A chat-completion service; the key goes into a bearer header if there is one. A request over the model's token
    limit isn't tried again, other errors are, after exponentially longer waits."""

    endpoint: str
    key: str = ""
    system: str = ""
    temperature: float = 0.7
    max_tokens: int = 8192
    timeout: float = 120.0
    attempts: int = 3
    workers: int = 4
    wait: float = 2.0
    headers: dict = field(default_factory=dict)

    def reply(self, prompt: str, model: str) -> str | None:
        messages = [{"role": "system", "content": self.system}] if self.system else []
        body = json.dumps({"model": model, "messages": [*messages, {"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens}).encode()
        headers = {"Content-Type": "application/json", **self.headers} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        for attempt in range(self.attempts):
            try:
                with urllib.request.urlopen(urllib.request.Request(chat_url(self.endpoint), body, headers), timeout=self.timeout) as r:
                    return parse_chat(json.load(r))
            except urllib.error.HTTPError as e:
                if e.code == 400 and b"token" in e.read().lower():
                    return None
            except (OSError, ValueError):
                pass
            if attempt + 1 < self.attempts:
                time.sleep(self.wait * 2**attempt)
        return None


def complete(df: DataFrame, provider: Provider, prompt: str, to: str, model: str | None = None) -> DataFrame:
    """The rows with a column of replies; null where there is none. ``model`` names a column."""
    importable(df.sparkSession)
    names = df.columns
    rows = df.withColumn("_prompt", F.col(prompt)).withColumn("_model", F.col(model) if model else F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(provider.workers) as pool:
            for batch in batches:
                asked = zip(batch.column("_prompt").to_pylist(), batch.column("_model").to_pylist())
                said = list(pool.map(lambda x: provider.reply(x[0] or "", x[1] or ""), asked))
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(said, pa.string())], names=[*names, to])

    said = rows.mapInArrow(run, StructType([*df.schema.fields, StructField(to, StringType())]))
    return cut(said) if provider.keep else said


def trials(df: DataFrame, k: int) -> DataFrame:
    """k numbered trials of every row."""
    return df.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def seeded_pick(options: list[str], *keys: str):
    """One of a fixed list by the hash of the keys: a shuffle that comes out alike every time."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64(*keys), F.lit(len(options))) + 1).cast("int"))
