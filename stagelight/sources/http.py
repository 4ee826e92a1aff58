"""Python data source for HTTP sources, fetched on executors. Every URL gives a row, whatever its answer: an error status
comes with its body, a request without an answer with what went wrong. Requests are declared as options; tokens are never
written into plans or logs."""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stagelight.sources.limits import Limits

SCHEMA = "url string, status int, content binary, content_type string, content_length bigint, etag string, last_modified string, error string"


class Urls(InputPartition):
    def __init__(self, urls: list[str], share: float):
        super().__init__(urls)
        self.urls, self.share = urls, share


class HttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = json.loads(options["urls"])
        self.body = options.get("body")
        self.headers = json.loads(options.get("headers", "{}"))
        self.timeout = float(options.get("timeout", 30))
        self.limits = {k: float(v) for k in ("requests_per_min", "bytes_per_min") if (v := options.get(k))}
        # without limits a URL is a partition; with them so many at once as are allowed, each with its share
        self.parts = int(options.get("concurrency", 1)) if self.limits else len(self.urls)

    def partitions(self) -> list[InputPartition]:
        n = max(1, min(self.parts, len(self.urls)))
        return [Urls(self.urls[i::n], 1 / n) for i in range(n)]

    def read(self, partition: Urls) -> Iterator[tuple]:
        limits = Limits(share=partition.share, **self.limits)
        data = self.body.encode() if self.body else None
        for url in partition.urls:
            limits.acquire()
            row = self.one(url, data)
            limits.used(len(row[2] or b""))
            yield row

    def one(self, url: str, data: bytes | None) -> tuple:
        headers = ({"Content-Type": "application/json"} if data else {}) | self.headers
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=headers), timeout=self.timeout) as answer:
                return self.row(url, answer.status, answer.read(), answer.headers)
        except urllib.error.HTTPError as e:
            return self.row(url, e.code, e.read(), e.headers)
        except (OSError, ValueError) as e:  # no answer: refused, timed out, cut short, or no URL at all
            return url, None, None, None, None, None, None, f"{type(e).__name__}: {e}"

    @staticmethod
    def row(url: str, status: int, content: bytes, h) -> tuple:
        told = h.get("Content-Length", "")
        return url, status, content, h.get("Content-Type"), int(told) if told.isdigit() else len(content), h.get("ETag"), h.get("Last-Modified"), None


class HttpSource(DataSource):
    """Options: urls (JSON list), body (for POST, such as a GraphQL query), headers (JSON), timeout in seconds, and
    requests_per_min, bytes_per_min and concurrency of the source."""

    @classmethod
    def name(cls) -> str:
        return "http_payloads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HttpReader:
        return HttpReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpSource)


def fetched(spark: SparkSession, urls: list[str], **options: str | float | None) -> DataFrame:
    register(spark)
    given = {k: str(v) for k, v in options.items() if v is not None}
    return spark.read.format("http_payloads").options(urls=json.dumps(urls), **given).load()


def graphql_body(query: str, variables: dict | None = None, operation: str | None = None) -> str:
    return json.dumps({"operationName": operation, "query": query, "variables": variables or {}})


def named_value(page: str, name: str) -> str | None:
    """A value that a page's script gives under a name, such as a key that its own requests carry in a header."""
    found = re.search(rf"[\"']?{re.escape(name)}[\"']?\s*[:=]\s*[\"']([^\"']+)[\"']", page)
    return found.group(1) if found else None


def graphql(spark: SparkSession, url: str, query: str, variables: dict | None = None, headers: dict[str, str] | None = None) -> DataFrame:
    """One POST of a GraphQL query; its answer is the payload of a paginated plan."""
    return fetched(spark, [url], body=graphql_body(query, variables), headers=json.dumps(headers or {}))
