"""Calls made once: answers of models are written down as they come, so a task that is tried again, or a run that was ended, asks only for what it has no answer to.

``remembered`` puts a journal between an operator and a model. A journal is a folder that the driver and all executors share, with one small file for each answer, named by a
digest of the request; a model takes far longer to answer than a file takes to write. It has to live only until the operator's result is a table: ``parked`` results are written once, and ``forget`` then
removes the files. Failed calls are not kept, nor structured answers that are no JSON: both are asked for again.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from typing import Any

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from pagewright.functions.untrusted import NotJson
from pagewright.plans import models

#: Answers as rows.
FORM = "key string, kind string, answer string, attempts string"


def _plain(value: Any) -> Any:
    """A request's value for JSON: bytes by their digest, what NumPy or pandas made as plain lists and numbers."""
    if isinstance(value, (bytes, bytearray, memoryview)):
        return {"sha256": hashlib.sha256(bytes(value)).hexdigest()}
    return value.tolist() if hasattr(value, "tolist") else value.item() if hasattr(value, "item") else str(value)


def request_key(kind: str, model: str, request: Any) -> str:
    """A digest of all that an answer depends on. Fields are in alphabetical order."""
    return hashlib.sha256(json.dumps([kind, model, request], sort_keys=True, default=_plain).encode()).hexdigest()


def identity(client: Any) -> str:
    """What tells models apart: type, address, name and instructions, as far as they are there."""
    inner = getattr(client, "client", client)
    told = [getattr(inner, a, None) for a in ("url", "model", "size")] + [getattr(client, a, None) for a in ("instruction", "instructions")]
    return json.dumps([f"{type(client).__module__}.{type(client).__qualname__}", *told], default=str)


class Journal:
    """Answers by key in a folder: a path or a URI that pyarrow can open on every machine."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.files, self.path = fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{os.path.abspath(self.folder)}")

    def _place(self, key: str) -> str:
        return f"{self.path}/{key[:2]}/{key}.json"

    def get(self, key: str) -> dict | None:
        """The answer to a request, or None. A file that is damaged counts as none."""
        try:
            with self.files.open_input_stream(self._place(key)) as stream:
                found = json.loads(stream.read())
        except (FileNotFoundError, ValueError):
            return None
        return found if isinstance(found, dict) and "answer" in found else None

    def put(self, key: str, kind: str, answer: Any, attempts: Any) -> None:
        """Writes an answer beside its place and moves it there: readers see it whole or not at all. Of two tasks with one request either's answer stands."""
        place = self._place(key)
        new = f"{place}.{uuid.uuid4().hex}"
        self.files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with self.files.open_output_stream(new) as stream:
            stream.write(json.dumps({"key": key, "kind": kind, "answer": answer, "attempts": attempts}, sort_keys=True, default=str).encode())
        self.files.move(new, place)


class _Remembered:
    """A model whose answers are looked up before it is asked. It is made when the first request without an answer comes."""

    def __init__(self, make: Callable[[], Any], folder: str, name: str | None):
        self.journal, self.model, self.attempts = Journal(folder), make(), []
        self.name = name if name is not None else identity(self.model)

    @property
    def client(self):
        """What operators read a model's name from."""
        return getattr(self.model, "client", None)

    def _ask(self, kind: str, request: Any, call: Callable[[], Any], usable: Callable[[Any], bool] = lambda a: True) -> Any:
        key = request_key(kind, self.name, request)
        held = self.journal.get(key)
        if held is not None:
            self.attempts = held["attempts"]
            return held["answer"]
        answer = call()
        self.attempts = list(getattr(self.model, "attempts", []))
        if usable(answer):
            self.journal.put(key, kind, answer, self.attempts)
        return answer

    def read(self, page: dict) -> str:
        return self._ask("page", page, lambda: self.model.read(page))

    def generate(self, schema: dict, prompt: str, evidence: list[dict]) -> str:
        return self._ask("structured", [schema, prompt, evidence], lambda: self.model.generate(schema, prompt, evidence), _is_json)

    def embed(self, texts: list[str], query: bool = False) -> list[list[float]]:
        """Each text has an answer of its own, as batches need not fall alike again; those without one are asked for together."""
        keys = [request_key("embedding", self.name, [t, query]) for t in texts]
        held = {k: found["answer"] for k in set(keys) if (found := self.journal.get(k)) is not None}
        asked = {k: t for k, t in zip(keys, texts, strict=True) if k not in held}
        if asked:
            vectors = models.checked(self.model.embed(list(asked.values()), query), len(asked))
            for k, vector in zip(asked, vectors, strict=True):
                self.journal.put(k, "embedding", vector, [])
                held[k] = vector
        return [held[k] for k in keys]


def _is_json(answer: Any) -> bool:
    try:
        models.parse_json(answer)
    except NotJson:
        return False
    return True


def remembered(make: Callable[[], Any], folder: str, name: str | None = None) -> Callable[[], Any]:
    """A maker of models that keep their answers in ``folder``. ``name`` stands for the model in the digests; without it ``identity`` does.

    Equal requests get one answer, and that is the first one: a journal is for models of which one answer to a question is enough.
    """
    return lambda: _Remembered(make, folder, name)


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """The answers of a journal as rows, ``answer`` and ``attempts`` as JSON texts; none where there is no folder."""
    files = Journal(folder)
    if files.files.get_file_info(files.path).type == fs.FileType.NotFound:
        return spark.createDataFrame([], FORM)
    return spark.read.schema(FORM).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(folder)


def forget(folder: str) -> None:
    """Removes a journal whose answers have become tables."""
    journal = Journal(folder)
    if journal.files.get_file_info(journal.path).type != fs.FileType.NotFound:
        journal.files.delete_dir(journal.path)
