"""A remote triple repository over the RDF4J REST protocol: life cycle, queries, updates and uploads.

Uploads run on the executors, a partition at a time in bounded requests. Statements are a set, so a task that runs
again after a lost executor changes nothing.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib import error, parse, request

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RepositoryError(RuntimeError):
    """A refused request: its status (0 without an answer) and what the server says."""

    def __init__(self, status: int, message: str):
        super().__init__(f"{status}: {message}")
        self.status = status


def config(name: str, title: str | None = None) -> str:
    """The Turtle that describes a new in-memory repository."""
    return "\n".join([
        "@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .",
        "@prefix config: <tag:rdf4j.org,2023:config/> .",
        "[] a config:Repository ;",
        f'  config:rep.id "{name}" ;',
        f'  rdfs:label "{title or name}" ;',
        '  config:rep.impl [ config:rep.type "openrdf:SailRepository" ;',
        '    config:sail.impl [ config:sail.type "openrdf:MemoryStore" ] ] .',
    ])


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")


def statement(s: str, p: str, o: str, kind: str, lang: str | None, base: str) -> str:
    """One line of N-Triples; names without a scheme are below the base."""
    iri = lambda x: f"<{x if '://' in x else base + parse.quote(x)}>"
    value = iri(o) if kind == "iri" else f'"{_escaped(o)}"' + (f"@{lang}" if lang else "")
    return f"{iri(s)} {iri(p)} {value} ."


@dataclass(frozen=True)
class Repository:
    """A repository by the server's address and its name."""

    server: str
    name: str
    user: str | None = None
    password: str | None = None
    timeout: float = 30.0

    @property
    def address(self) -> str:
        return f"{self.server.rstrip('/')}/repositories/{parse.quote(self.name)}"

    def _call(self, method: str, url: str, body: bytes | None = None, kind: str | None = None, accept: str | None = None) -> bytes:
        headers = {k: v for k, v in (("Content-Type", kind), ("Accept", accept)) if v}
        if self.user is not None:
            headers["Authorization"] = "Basic " + base64.b64encode(f"{self.user}:{self.password or ''}".encode()).decode()
        try:
            with request.urlopen(request.Request(url, body, headers, method=method), timeout=self.timeout) as r:
                return r.read()
        except error.HTTPError as e:
            raise RepositoryError(e.code, e.read().decode("utf-8", "replace")[:500]) from e
        except OSError as e:
            raise RepositoryError(0, str(e)) from e

    def exists(self) -> bool:
        try:
            self.size()
            return True
        except RepositoryError as e:
            if e.status == 404:
                return False
            raise

    def create(self, title: str | None = None) -> bool:
        """Make the repository; whether it was not there before."""
        if self.exists():
            return False
        self._call("PUT", self.address, config(self.name, title).encode(), "text/turtle")
        return True

    def delete(self) -> None:
        self._call("DELETE", self.address)

    def size(self) -> int:
        return int(self._call("GET", f"{self.address}/size"))

    def _query(self, sparql: str) -> dict:
        body = parse.urlencode({"query": sparql}).encode()
        return json.loads(self._call("POST", self.address, body, "application/x-www-form-urlencoded", "application/sparql-results+json"))

    def select(self, sparql: str) -> list[dict[str, str | None]]:
        """A row a solution; unbound variables are None."""
        got = self._query(sparql)
        return [{v: b.get(v, {}).get("value") for v in got["head"]["vars"]} for b in got["results"]["bindings"]]

    def ask(self, sparql: str) -> bool:
        return bool(self._query(sparql)["boolean"])

    def update(self, sparql: str) -> None:
        self._call("POST", f"{self.address}/statements", parse.urlencode({"update": sparql}).encode(), "application/x-www-form-urlencoded")

    def upload(self, content: bytes, kind: str = "text/turtle") -> None:
        self._call("POST", f"{self.address}/statements", content, kind)

    def health(self) -> dict:
        """State and size; never raises."""
        try:
            n = self.size()
            return {"available": True, "empty": n == 0, "triples": n}
        except RepositoryError as e:
            return {"available": False, "status": e.status, "error": str(e)}

    def publish(self, triples: DataFrame, base: str, rows: int = 5000, fresh: bool = False) -> dict:
        """Upload (s, p, o, kind, lang); ``fresh``: in place of what is there. Gives rows sent and the size after."""
        if fresh:
            self.update("CLEAR ALL")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent = 0
            for batch in batches:
                for lo in range(0, batch.num_rows, rows):
                    lines = [statement(r["s"], r["p"], r["o"], r["kind"], r["lang"], base) for r in batch.slice(lo, rows).to_pylist()]
                    self.upload("\n".join(lines).encode("utf-8", "replace"), "application/n-triples")
                    sent += len(lines)
            yield pa.RecordBatch.from_pydict({"sent": pa.array([sent], pa.int64())})

        sent = triples.select("s", "p", "o", "kind", "lang").mapInArrow(run, "sent long").agg(F.sum("sent")).first()[0]
        return {"sent": sent or 0, "size": self.size()}
