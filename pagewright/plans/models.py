"""The model boundary: protocols, deterministic offline models, retries, JSON decoding, and the operators that call models.

Calls happen in ``mapInPandas`` with one client per partition. Their results should be written before they are read twice, as a
retried task calls again.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from pagewright.functions.untrusted import NotJson, loads, structure, within

#: Statuses after which a call is made again, and reasons to stop that leave an answer whole.
RETRIED = (408, 409, 425, 429, 500, 502, 503, 504)
WHOLE = (None, "stop", "tool_calls", "function_call")


class PageModel(Protocol):
    def read(self, page: dict) -> str: ...


class StructuredModel(Protocol):
    #: What it takes: a JSON schema, what the source allows, and the evidence in order.
    def generate(self, schema: dict, prompt: str, evidence: list[dict]) -> str: ...


class EmbeddingModel(Protocol):
    def embed(self, texts: list[str], query: bool = False) -> list[list[float]]: ...


class Transport(Protocol):
    def post(self, url: str, headers: dict, payload: dict, timeout: float) -> tuple[int, dict]: ...


class HttpTransport:
    """JSON over HTTP with the standard library."""

    def post(self, url: str, headers: dict, payload: dict, timeout: float) -> tuple[int, dict]:
        body = json.dumps(payload).encode()
        request = urllib.request.Request(url, body, {"Content-Type": "application/json", "Accept": "application/json", **headers}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, _object(answer.read())
        except urllib.error.HTTPError as e:
            return e.code, _object(e.read())


def _object(raw: bytes) -> dict:
    text = raw.decode("utf-8", "replace")
    try:
        found = loads(text)
    except NotJson:
        return {"error": excerpt(text)}
    return found if isinstance(found, dict) else {"value": found}


def excerpt(value, tail: bool = False, limit: int = 240) -> str:
    """The head or tail of a text, or of a value as JSON, for an audit; NUL characters are shown."""
    text = (value if isinstance(value, str) else json.dumps(value, sort_keys=True, ensure_ascii=False, default=str)).replace("\0", "\\0")
    return text.rstrip()[-limit:] if tail else text[:limit]


def data_url(image: bytes, mime: str = "image/png") -> str:
    return f"data:{mime};base64,{base64.b64encode(image).decode()}"


@dataclass(frozen=True)
class Retry:
    attempts: int = 4
    first: float = 1.0
    factor: float = 2.0
    most: float = 30.0

    def __post_init__(self):
        if self.attempts < 1 or self.first < 0 or self.factor < 1 or self.most < 0:
            raise ValueError("at least one attempt, and delays that do not shrink")

    def delay(self, attempt: int) -> float:
        """Seconds before an attempt, the first being number 1."""
        return 0.0 if attempt < 2 else min(self.most, self.first * self.factor ** (attempt - 2))


class CallFailed(RuntimeError):
    def __init__(self, attempts: list[dict]):
        super().__init__(f"no usable answer in {len(attempts)} attempts: {attempts[-1]['outcome'] if attempts else 'none'}")
        self.attempts = attempts


@dataclass
class ChatClient:
    """Chat completions over a transport; transport errors, some statuses and answers that a validator refuses are tried again."""

    transport: Transport
    url: str
    model: str
    retry: Retry = field(default_factory=Retry)
    headers: dict = field(default_factory=dict)
    timeout: float = 60.0
    sleep: Callable[[float], None] = time.sleep

    def complete(self, messages: list[dict], validator: Callable[[dict], Any] | None = None, **body) -> tuple[Any, list[dict]]:
        attempts: list[dict] = []
        for n in range(1, self.retry.attempts + 1):
            self.sleep(self.retry.delay(n))
            try:
                status, answer = self.transport.post(self.url, self.headers, merged({"model": self.model, "messages": messages}, body), self.timeout)
            except OSError as e:
                attempts.append({"attempt": n, "outcome": "transport_error", "detail": str(e)})
                continue
            if status != 200:
                attempts.append({"attempt": n, "outcome": "status", "status": status})
                if status in RETRIED:
                    continue
                break
            try:
                value = validator(answer) if validator else answer
            except ValueError as e:
                attempts.append({"attempt": n, "outcome": "unusable", "status": status, "detail": str(e)})
                continue
            attempts.append({"attempt": n, "outcome": "ok", "status": status})
            return value, attempts
        raise CallFailed(attempts)


def unsupported_content(error: CallFailed) -> bool:
    """Whether every attempt was answered, but with nothing that can be used."""
    return bool(error.attempts) and all(a["outcome"] == "unusable" and a.get("status") == 200 for a in error.attempts)


def merged(a: dict, b: dict) -> dict:
    """Both maps; where both have maps under one key those are merged too, otherwise the second wins."""
    return a | {k: merged(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}


def contents(answer: dict) -> Iterator[Any]:
    """What may hold an answer's content, the likeliest first, without repetitions."""
    found: list[Any] = []
    for choice in answer.get("choices") or []:
        m = choice.get("message") or {}
        found += [m.get("parsed"), m.get("content")]
        found += [(c.get("function") or {}).get("arguments") for c in m.get("tool_calls") or []]
        found += [(m.get("function_call") or {}).get("arguments"), m.get("reasoning_content"), choice.get("text")]
    found.append(answer.get("output_text"))
    for part in answer.get("output") or []:
        found += [c.get("text") for c in part.get("content") or [] if isinstance(c, dict)] if isinstance(part, dict) else [part]
    found.append(answer.get("content"))
    seen = set()
    for x in found:
        if isinstance(x, list):
            x = "".join(c.get("text", "") if isinstance(c, dict) else str(c) for c in x)
        key = hashlib.sha256(json.dumps(x, sort_keys=True, default=str).encode()).hexdigest()
        if x not in (None, "") and key not in seen:
            seen.add(key)
            yield x


def parse_json(content) -> Any:
    """The JSON value of an answer: whole, fenced, after thinking, or alone within prose. Nothing is ever repaired."""
    if isinstance(content, dict | list):
        return content
    text = re.sub(r"(?s)<think>.*?</think>", "", str(content or "")).strip()
    text = re.sub(r"<\|[a-z_]+\|>", "", text).strip()
    if m := re.fullmatch(r"(?s)```[A-Za-z]*\s*(.*?)\s*```", text):
        text = m[1]
    return within(text)


def decode(answer: dict) -> Any:
    """The first candidate that is JSON, from an answer that was not cut off."""
    reasons = [c.get("finish_reason") for c in answer.get("choices") or []]
    if any(r not in WHOLE for r in reasons):
        raise NotJson("truncated")
    error = NotJson("empty")
    for x in contents(answer):
        try:
            return parse_json(x)
        except NotJson as e:
            error = e
    raise error


def offline_value(schema: dict) -> Any:
    """The least value of a schema, the same each time."""
    for key in ("const", "default"):
        if key in schema:
            return schema[key]
    if schema.get("enum"):
        return schema["enum"][0]
    for key in ("oneOf", "anyOf"):
        if schema.get(key):
            return offline_value(schema[key][0])
    kind = schema.get("type")
    if kind == "object":
        return {k: offline_value(schema["properties"][k]) for k in schema.get("required", []) if k in schema.get("properties", {})}
    return {"array": [], "string": "", "integer": 0, "number": 0.0, "boolean": False}.get(kind)


def usable_text(answer: dict) -> str:
    """The first content of an answer, as text."""
    if any(c.get("finish_reason") not in WHOLE for c in answer.get("choices") or []):
        raise ValueError("the answer was cut off")
    found = next(contents(answer), None)
    if found is None:
        raise ValueError("an answer without content")
    return found if isinstance(found, str) else json.dumps(found, sort_keys=True, ensure_ascii=False)


@dataclass
class ImagePages:
    """A model that reads a page's image: one for documents, or one for OCR, by what it is told to do."""

    client: ChatClient
    instruction: str
    body: dict = field(default_factory=dict)
    attempts: list[dict] = field(default_factory=list)

    def read(self, page: dict) -> str:
        if not page.get("image"):
            raise ValueError("the page has no image")
        shown = {"type": "image_url", "image_url": {"url": data_url(bytes(page["image"]), page.get("image_mime_type") or "image/png")}}
        text, self.attempts = self.client.complete([{"role": "user", "content": [{"type": "text", "text": self.instruction}, shown]}], usable_text, **self.body)
        return text


#: How a schema is sent: by a field of its own, as a response format, or both.
GUIDED = ("field", "response_format", "both")


@dataclass
class GuidedStructured:
    """A model that answers in JSON of a schema, which also gets the evidence. What is no JSON is asked for again by ``generate``; every attempt is kept."""

    client: ChatClient
    system: str = "Answer with one JSON object that fits the schema. Use only what the evidence says, and cite element ids."
    mode: str = "response_format"
    field_name: str = "guided_json"
    max_tokens: int = 8192
    attempts: list[dict] = field(default_factory=list)

    def __post_init__(self):
        if self.mode not in GUIDED:
            raise ValueError(f"the mode is one of {', '.join(GUIDED)}")

    def generate(self, schema: dict, prompt: str, evidence: list[dict]) -> str:
        listed = "\n".join(json.dumps(e, ensure_ascii=False) for e in evidence)
        body: dict = {"max_tokens": self.max_tokens, "temperature": 0}
        if self.mode in ("field", "both"):
            body[self.field_name] = schema
        if self.mode in ("response_format", "both"):
            body["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "schema": schema, "strict": True}}
        messages = [{"role": "system", "content": self.system}, {"role": "user", "content": f"{prompt}\n\nEvidence, one element a line:\n{listed}"}]
        text, self.attempts = self.client.complete(messages, usable_text, **body)
        return text


@dataclass
class HttpEmbeddings:
    """Embeddings of a service; passages and queries have prefixes of their own."""

    transport: Transport
    url: str
    model: str
    headers: dict = field(default_factory=dict)
    retry: Retry = field(default_factory=Retry)
    timeout: float = 60.0
    passage: str = "passage: "
    query: str = "query: "
    sleep: Callable[[float], None] = time.sleep

    def embed(self, texts: list[str], query: bool = False) -> list[list[float]]:
        prefix = self.query if query else self.passage
        attempts: list[dict] = []
        for n in range(1, self.retry.attempts + 1):
            self.sleep(self.retry.delay(n))
            try:
                status, answer = self.transport.post(self.url, self.headers, {"model": self.model, "input": [prefix + t for t in texts]}, self.timeout)
            except OSError as e:
                attempts.append({"attempt": n, "outcome": "transport_error", "detail": str(e)})
                continue
            if status == 200:
                return reordered(answer.get("data") or [], len(texts))
            attempts.append({"attempt": n, "outcome": "status", "status": status, "detail": excerpt(answer)})
            if status not in RETRIED:
                break
        raise CallFailed(attempts)


@dataclass(frozen=True)
class Clients:
    """What makes the models of a run, once for each partition; None where OCR is not configured."""

    page: Callable[[], PageModel]
    ocr: Callable[[], PageModel] | None
    structured: Callable[[], StructuredModel]
    embedding: Callable[[], EmbeddingModel]


def clients(config, transport: Callable[[], Transport] = HttpTransport) -> Clients:
    """The models that a configuration names; offline ones unless its mode is live."""
    if config.mode != "live":
        return Clients(OfflinePages, None, OfflineStructured, HashedEmbeddings)

    def chat(e) -> ChatClient:
        return ChatClient(transport(), e.url, e.model, headers=_key(e), timeout=e.timeout)

    def _key(e) -> dict:
        return {"Authorization": f"Bearer {e.api_key}"} if e.api_key else {}

    page, ocr, structured, embedding = config.page_model, config.ocr_model, config.structured_model, config.embedding_model
    return Clients(
        lambda: ImagePages(chat(page), "Give the elements of this page in reading order as JSON, each with its text, type and box."),
        (lambda: ImagePages(chat(ocr), "Give every line of text on this page as JSON, each with its text and box.")) if ocr.url else None,
        lambda: GuidedStructured(chat(structured)),
        (lambda: HttpEmbeddings(transport(), embedding.url, embedding.model, _key(embedding), timeout=embedding.timeout)) if embedding.url else HashedEmbeddings,
    )


class OfflinePages:
    def read(self, page: dict) -> str:
        return "{}"


class OfflineStructured:
    def generate(self, schema: dict, prompt: str, evidence: list[dict]) -> str:
        return json.dumps(offline_value(schema), sort_keys=True)


@dataclass
class HashedEmbeddings:
    """Word counts hashed into a vector of unit length: deterministic, and like for like texts."""

    size: int = 64

    def embed(self, texts: list[str], query: bool = False) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.size
            for w in re.findall(r"\w+", t.lower()):
                h = hashlib.sha256(w.encode()).digest()
                v[h[0] % self.size] += 1.0 if h[1] % 2 else -1.0
            n = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / n for x in v])
        return out


def checked(vectors: list[list[float]], texts: int) -> list[list[float]]:
    """Vectors as many as texts, of one length, not empty, finite."""
    if len(vectors) != texts or len({len(v) for v in vectors}) > 1 or any(not v or not all(map(math.isfinite, v)) for v in vectors):
        raise ValueError("an embedding per text, all of one length and finite")
    return vectors


def reordered(data: list[dict], texts: int) -> list[list[float]]:
    """Vectors in the order of their ``index``."""
    if sorted(d["index"] for d in data) != list(range(texts)):
        raise ValueError("an embedding for each text is missing or doubled")
    return checked([d["embedding"] for d in sorted(data, key=lambda d: d["index"])], texts)


def embed(rows: DataFrame, model: Callable[[], EmbeddingModel] = HashedEmbeddings, text_col: str = "text", batch: int = 16) -> DataFrame:
    """Adds ``embedding``, calling the model in batches; rows and vectors never part, so nothing has to be joined."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", embedding array<double>"

    def run(frames):
        client = model()
        for frame in frames:
            vectors: list[list[float]] = []
            for i in range(0, len(frame), batch):
                texts = [t or "" for t in frame[text_col].iloc[i : i + batch]]
                vectors += checked(client.embed(texts), len(texts))
            yield frame.assign(embedding=vectors)

    return rows.mapInPandas(run, schema)


def read_pages(pages: DataFrame, model: Callable[[], PageModel] = OfflinePages, name: str = "offline") -> DataFrame:
    """Answers of a page model: ``document_id, page_number, content, model, error, unsupported, attempts``. A page that fails is a row, not the end of the run.

    The model gets all of a page's columns, its image among them. ``unsupported`` tells that every attempt was answered, but never with anything usable.
    """
    columns = ["document_id", "page_number", "content", "model", "error", "unsupported", "attempts"]

    def run(frames):
        client = model()
        for frame in frames:
            out = []
            for page in frame.to_dict("records"):
                content, error, unsupported, attempts = None, None, False, []
                try:
                    content = client.read(page)
                    attempts = getattr(client, "attempts", [])
                except CallFailed as e:
                    error, unsupported, attempts = str(e), unsupported_content(e), e.attempts
                except Exception as e:  # noqa: BLE001  a model that breaks on one page must not end the others
                    error = str(e) or type(e).__name__
                out.append((page["document_id"], page["page_number"], content, getattr(getattr(client, "client", None), "model", name), error, unsupported, json.dumps(attempts, sort_keys=True)))
            yield pd.DataFrame(out, columns=columns)

    return pages.mapInPandas(run, "document_id string, page_number int, content string, model string, error string, unsupported boolean, attempts string")


def generate(
    hints: DataFrame, model: Callable[[], StructuredModel] = OfflineStructured, chunk: tuple[str, ...] = ("document_id",), regenerate: int = 1, evidence: DataFrame | None = None
) -> DataFrame:
    """A structured answer for each chunk of hints: ``payload``, ``attempts``, ``error``, ``audit``. An answer that is no JSON is asked for once more.
    A chunk whose hints have an ``error`` keeps it and is not asked for.

    ``evidence`` are the chunks' elements; a model gets those of its chunk in order of page and sequence.
    """
    from pyspark.sql import functions as F

    from pagewright.operators.hints import batch_schema, prompt

    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hints.select(*chunk).schema)
    item = ["page_number", "sequence_number", "element_id", "element_type", "text"]
    if "error" not in hints.columns:
        hints = hints.withColumn("error", F.lit(None).cast("string"))
    if evidence is not None:
        own = evidence.groupBy(*chunk).agg(F.array_sort(F.collect_list(F.struct(*item))).alias("evidence"))
        hints = hints.join(own, list(chunk), "left")

    def run(frames):
        client = model()
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                hint = {"mode": row["mode"], "reason": row["reason"], "identifiers": list(row["identifiers"]), "evidence_element_ids": list(row["evidence_element_ids"]), "manufacturers": list(row["manufacturers"])}
                cited = row.get("evidence")
                cited = [{k: e[k] for k in item if k != "sequence_number"} for e in cited] if cited is not None and not isinstance(cited, float) else []
                payload, error, attempts, audit = None, row.get("error"), 0, []
                while payload is None and attempts <= regenerate and not isinstance(row.get("error"), str):
                    attempts += 1
                    try:
                        answer = client.generate(batch_schema(hint), prompt(hint), cited)
                        audit += getattr(client, "attempts", [])
                        payload = json.dumps(parse_json(answer), sort_keys=True)
                    except CallFailed as e:
                        error, audit = str(e), audit + e.attempts
                    except NotJson as e:
                        error, audit = str(e), [*audit, {"generation": attempts, "outcome": e.kind, "head": excerpt(answer), "tail": excerpt(answer, tail=True)}]
                    except Exception as e:  # noqa: BLE001  a model that breaks on one chunk must not end the others
                        error = str(e) or type(e).__name__
                out.append([*(row[c] for c in chunk), payload, attempts, None if payload is not None else error, json.dumps(audit, sort_keys=True)])
            yield pd.DataFrame(out, columns=[*chunk, "payload", "attempts", "error", "audit"])

    return hints.mapInPandas(run, f"{keys}, payload string, attempts int, error string, audit string")
