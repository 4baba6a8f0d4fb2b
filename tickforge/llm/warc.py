"""WARC archives with revisit records, read back into a globally ordered capture index.

Writing: a page's payload digest decides its record: of equal payloads of ``LEAST_BYTES`` or more, the smallest id's is the
response, the others revisit it.  Pages meet their digest's smallest id in a join, which adaptive execution splits when
one digest has very many pages, and every task writes its rows as archive files (one gzip member per record) of bounded
size into the shared folder.  A file is written under a name of its own attempt and its name is returned with the task's
result, so a repeated task leaves at worst an unread file.

Reading: every archive is read record by record and yields its captures as a run sorted by URL key and timestamp.  Runs
are dealt by ranges of (URL key, timestamp, id), so one URL's captures spread over tasks, and every task merges the slices
of the runs that fall into its range with a loser tree.  The range order makes the merged slices one global order.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickforge.session import fresh_path, stage

LEAST_BYTES = 100
FILE_BYTES = 64_000_000        # of payload in one archive
INDEX = ("url_key string, captured string, id string, url string, type string, refers_to string, "
         "payload_bytes bigint, payload_digest string, file string, offset bigint, length bigint")
ORDER = ["url_key", "captured", "id"]
_DOTS = re.compile(r"^www\d*\.")


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, then path and sorted query, in lower case."""
    if not url:
        return ")/"
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return ")/" + url.strip().lower()
    host = ",".join(reversed(_DOTS.sub("", host).split(".")))
    if port and port not in (80, 443):
        host += f":{port}"
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{host}){parts.path or '/'}" + (f"?{query}" if query else "")


def _escaped(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(key: str | None, url: str | None, captured: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record.  Responses hold an HTTP response with the payload; revisits hold none, but its digest and
    length.  A null id or URL has no header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    revisit = refers_to is not None
    block = http + (b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    name = hashlib.md5(f"{key}|{url}|{digest}".encode("utf-8", "surrogatepass")).digest()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.UUID(bytes=name)}>", f"WARC-Date: {captured}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped(url)}")
    if key is not None:
        lines.append(f"X-Page-ID: {_escaped(key)}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-ID: {_escaped(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record (for revisits an empty payload)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if len(block) < int(headers["Content-Length"]):
        raise ValueError("a record is cut short")
    return headers, block.partition(b"\r\n\r\n")[2]


def members(stream, size: int = 1 << 20):
    """(offset, length, bytes) of every gzip member of a stream, read in steps of ``size``."""
    at, held = 0, b""
    while True:
        unzip, parts, start = zlib.decompressobj(31), [], at
        while not unzip.eof:
            held = held or stream.read(size)
            if not held:
                if parts or at > start:
                    raise ValueError("an archive is cut short")
                return
            parts.append(unzip.decompress(held))
            at += len(held) - len(unzip.unused_data)
            held = unzip.unused_data
        yield start, at - start, b"".join(parts)


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _written(name: str, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])


def _write(folder: str):
    def run(batches):
        system, path = _opened(folder)
        system.create_dir(path, recursive=True)
        name, out, size, n = "", None, 0, 0
        for b in batches:
            for key, url, captured, html, digest, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                zipped = zlib.compressobj(5, zlib.DEFLATED, 31)
                payload = (html or "").encode("utf-8", "surrogatepass")
                out.write(zipped.compress(record(key, url, captured, payload, digest, refers_to)) + zipped.flush())
                size, n = size + len(payload) + 512, n + 1
                if size >= FILE_BYTES:
                    out.close()
                    yield _written(name, n)
                    out = None
        if out is not None:
            out.close()
            yield _written(name, n)
    return run


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
          captured: Column | None = None) -> DataFrame:
    """Write the archives; returns file, records (stored).

    A null html is an empty payload.  Equal payloads are those of equal digest and at least ``LEAST_BYTES`` bytes; rows that
    share the smallest id are all responses, as are rows with a null id where no equal payload has one.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"),
                        (F.lit("1970-01-01T00:00:00Z") if captured is None else captured).alias("captured"),
                        body.alias("html"), F.sha2(F.encode(body, "UTF-8"), 256).alias("digest"),
                        F.octet_length(body).alias("bytes"))
    firsts = rows.where(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select(
        F.col("digest").alias("d"), "first")
    joined = rows.join(stage(firsts, "firsts"), F.col("digest") == F.col("d"), "left")
    refers = F.when((F.col("bytes") >= LEAST_BYTES) & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return stage(joined.select(F.col("id").cast("string"), "url", "captured", "html", "digest",
                               refers.cast("string").alias("refers_to"))
                 .mapInArrow(_write(folder), "file string, records bigint"), "archives")


def _captures(name: str, stream):
    """Captures of one archive, in its own order."""
    for offset, length, data in members(stream):
        headers, payload = parse(data)
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
        size = int(headers["X-Payload-Length"])
        if kind == "response":      # a response's figures are those of what is stored
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        field = lambda k: _plain(headers[k]) if k in headers else None
        url = field("WARC-Target-URI")
        yield (url_key(url), headers["WARC-Date"], field("X-Page-ID"), url, kind, field("X-Refers-To-Page-ID"), size,
               digest, name, offset, length)


COLUMNS = [c.split()[0] for c in INDEX.split(", ")]


def _runs(folder: str):
    def run(batches):
        system, path = _opened(folder)
        for pdf in batches:
            for name in pdf["file"]:
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows = sorted(_captures(name, stream), key=lambda r: (r[0], r[1], r[2] or ""))
                for k in range(0, len(rows), 5000):
                    yield pd.DataFrame(rows[k:k + 5000], columns=COLUMNS)
    return run


class LoserTree:
    """Merge of sorted iterators: inner nodes keep the loser of their match, so the next smallest takes one match per
    level."""

    def __init__(self, runs, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.n = max(1, len(self.runs))
        self.heads = [self._next(i) for i in range(len(self.runs))] or [None]
        self.tree = [-1] * self.n
        for i in range(self.n):
            self._play(i)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _less(self, a: int, b: int) -> bool:
        """A run that has ended loses."""
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[:2] <= y[:2])

    def _play(self, i: int) -> None:
        node, winner = (i + self.n) // 2, i
        while node:
            if self.tree[node] < 0:      # the first to come waits for its match
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while True:
            winner = self.tree[0]
            if winner < 0 or self.heads[winner] is None:
                return
            yield self.heads[winner][2]
            self.heads[winner] = self._next(winner)
            node = (winner + self.n) // 2
            while node:
                if self._less(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def _merge(batches):
    """Merge the slices of one key range: rows of a file keep their order, each file's slice is a run."""
    runs: dict[str, list] = {}
    for pdf in batches:
        pdf = pdf.astype(object).where(pdf.notna(), None)
        for row in pdf.itertuples(index=False, name=None):
            runs.setdefault(row[8], []).append(row)
    key = lambda r: (r[0], r[1], r[2] or "", r[8], r[9])
    for rows in runs.values():      # blocks of a run may arrive in any order
        if any(key(a) > key(b) for a, b in zip(rows, rows[1:])):
            rows.sort(key=key)
    out = []
    for row in LoserTree([runs[f] for f in sorted(runs)], key):
        out.append(row)
        if len(out) == 5000:
            yield pd.DataFrame(out, columns=COLUMNS)
            out = []
    if out:
        yield pd.DataFrame(out, columns=COLUMNS)


def index(archives: DataFrame, folder: str, ranges: int | None = None) -> DataFrame:
    """The capture index of stored archives: partitions in global order of URL key, timestamp and id, each in order."""
    spark = archives.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = stage(archives.select("file").repartition(n).mapInPandas(_runs(folder), INDEX), "runs")
    return runs.repartitionByRange(n, *ORDER, "file", "offset").mapInPandas(_merge, INDEX)


def capture(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            captured: Column | None = None) -> DataFrame:
    """Write, read back, and return ``key``, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, file,
    offset, length of every page, in the index's order.

    Repeated rows are records each; a null id or URL comes back null; an empty table gives no rows.
    """
    kind = dict(pages.dtypes)[key]
    folder = fresh_path(pages.sparkSession, "warc")
    folder = folder if "://" in folder else f"file://{folder}"
    found = index(write(pages, folder, key, url, html, captured), folder)
    return found.select(F.col("id").cast(kind).alias(key), "payload_bytes", "payload_digest",
                        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"), "url_key",
                        "captured", "file", "offset", "length")
