"""WARC archives with a global index by external merge.

Tasks write archives of gzip members, one per record, and each keeps the index of its captures as a run sorted by url
key and time. Runs are range-partitioned by that order; every task of the merge gets a range's part of each run, still
sorted, and merges them with a loser tree, so the index as a whole is ordered and a url's captures form its history.
Readers go by the index: one pass over each archive, from member to member.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, parts_of, python_ready

# Payloads from this size on are stored once; a later archive rolls over at so many bytes.
LEAST_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
LEVEL = 1
RUN = (
    "url_key string, time string, page_id long, no_id boolean, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, file string, offset long, size long, run int"
)
_IDS = "urn:page:"


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query in lower case, so that a site's urls lie together; null as empty."""
    whole = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(whole, r"(?s)^[^:/?#]*://([^/?#]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(whole, r"(?s)^[^:/?#]*://[^/?#]*", ""), r"(?s)#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _store(folder: str):
    """The file system of a folder all executors reach, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _header(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record(page_id, no_id, url: str, time: str, digest: str, payload: bytes, refers_to) -> bytes:
    """One record: a response with its HTTP head and payload, or a revisit with the head alone."""
    name = lambda p: f"<{_IDS}{p}>"
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    date = f"{time[:4]}-{time[4:6]}-{time[6:8]}T{time[8:10]}:{time[10:12]}:{time[12:]}Z"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name("none-" + uuid.uuid4().hex if no_id else page_id)),
        ("WARC-Date", date), ("WARC-Target-URI", "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url)),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{b32}"), ("Payload-Length", str(len(payload))),
    ]
    if refers_to is None:
        return _header(fields, head + payload)
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return _header([*fields, ("WARC-Profile", profile), ("WARC-Refers-To", name(refers_to))], head)


def _write(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        number = TaskContext.get().partitionId()
        # A name of its own per attempt: what a lost task leaves behind is in no index.
        mark, k, out, at, entries = uuid.uuid4().hex, 0, None, 0, []
        for b in batches:
            for r in b.itertuples(index=False):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    leaf, at, k = f"{number:06d}-{k:03d}-{mark}.warc.gz", 0, k + 1
                    file, out = f"{folder}/{leaf}", store.open_output_stream(f"{base}/{leaf}", compression=None)
                refers_to = int(r.refers_to) if r.revisit else None
                member = gzip.compress(_record(r.page_id, r.no_id, r.url, r.time, r.payload_digest, bytes(r.payload), refers_to), LEVEL, mtime=0)
                out.write(member)
                entries.append(
                    (r.url_key, r.time, r.page_id, r.no_id, r.url, "revisit" if r.revisit else "response", len(r.payload), r.payload_digest,
                     refers_to or 0, file, at, len(member), number)
                )
                at += len(member)
        if out is not None:
            out.close()
        if entries:
            entries.sort(key=_order)
            yield pd.DataFrame(entries, columns=[c.split()[0] for c in RUN.split(", ")])

    return run


def _order(e) -> tuple:
    """Url key as bytes, as Spark orders text, then time and page."""
    return (e[0].encode("utf-8", "surrogatepass"), e[1], e[2], e[9], e[10])


def captures(pages: DataFrame) -> DataFrame:
    """Pages ready to write: payload, its digest and size, the capture's time and which page a revisit refers to.

    The time is the column ``captured`` where there is one of times, dates or text, and its value reads as a time; else
    ``page_id`` seconds after 2024-01-01.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    page_id = F.col("page_id").cast("long")
    seconds = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000)) + F.lit(1_704_067_200)
    taken = F.timestamp_seconds(seconds)
    if "captured" in pages.columns and pages.schema["captured"].dataType.typeName() in ("timestamp", "timestamp_ntz", "date", "string"):
        taken = F.coalesce(F.col("captured").try_cast("timestamp"), taken)
    return pages.select(
        F.coalesce(page_id, F.lit(0)).alias("page_id"), page_id.isNull().alias("no_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        url_key(F.col("url").cast("string")).alias("url_key"), F.date_format(taken, "yyyyMMddHHmmss").alias("time"),
        payload.alias("payload"), F.sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a WARC record under ``folder``; returns the index runs, one row per record.

    Of pages with equal payloads of at least 1000 bytes, that with the largest page_id is a response, those with a
    smaller one are revisits of it; rows that share the largest id, and rows without id, are responses. Null html is an
    empty payload, a null url an empty one. Other columns are not read, but for ``captured``. Repeated rows are records
    of their own. An empty table writes no archive.
    """
    python_ready(pages.sparkSession)
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    taken = captures(pages)
    big = taken.where((F.col("payload_bytes") >= LEAST_REVISIT) & ~F.col("no_id"))
    copied = big.groupBy(F.col("payload_digest").alias("of")).agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"))
    copied = keep(copied.where(F.col("first") < F.col("last")).select("of", "last"), "warc-copies")
    told = taken.join(copied, F.col("payload_digest") == F.col("of"), "left")
    revisit = F.coalesce(~F.col("no_id") & (F.col("page_id") < F.col("last")), F.lit(False))
    given = told.select(
        "page_id", "no_id", "url", "url_key", "time", "payload", "payload_digest", revisit.alias("revisit"), F.coalesce("last", F.lit(0)).alias("refers_to")
    )
    return keep(given.mapInPandas(_write(folder), RUN), "warc-runs")


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, so a new head replays one path to the top."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * self.k
        self.top = self._play(1) if runs else -1

    def _play(self, node: int) -> int:
        """Winner below a node of the implicit tree whose leaves are k .. 2k - 1."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head goes first; a finished run loses, ties go to the earlier run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def __iter__(self):
        while self.top >= 0 and self.heads[self.top] is not None:
            run = self.top
            rows, i = self.runs[run], self.at[run]
            yield rows[i]
            self.at[run] = i + 1
            self.heads[run] = self.key(rows[i + 1]) if i + 1 < len(rows) else None
            node, win = (run + self.k) // 2, run
            while node >= 1:
                if self._before(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2
            self.top = win


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A range's rows, as sorted stretches of runs, in one order. What a task holds is a range of index rows."""
    stretches: list[list] = []
    last = None
    columns = None
    for b in batches:
        columns = list(b.columns)
        for e in b.itertuples(index=False, name=None):
            now = (e[12], _order(e))
            if last is None or now[0] != last[0] or now[1] < last[1]:
                stretches.append([])
            stretches[-1].append(e)
            last = now
    if stretches:
        merged = pd.DataFrame(list(LoserTree(stretches, _order)), columns=columns)
        merged["range"] = TaskContext.get().partitionId()
        merged["place"] = range(len(merged))
        yield merged


def merge_index(runs: DataFrame) -> DataFrame:
    """All runs in one order by (url_key, time, page_id): the runs' columns, ``range`` and ``place`` in it."""
    python_ready(runs.sparkSession)
    order = ["url_key", "time", "page_id", "file", "offset"]
    dealt = runs.repartitionByRange(parts_of(runs.sparkSession), *order)
    return keep(dealt.mapInPandas(_merge, f"{RUN}, range int, place long"), "warc-index")


def _parse(member: bytes) -> dict:
    """Header fields and payload of one record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    name, source = None, None
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            if r.file != name:
                if source is not None:
                    source.close()
                store, path = _store(r.file)
                name, source = r.file, store.open_input_file(path)
            source.seek(r.offset)
            f = _parse(source.read(r.size))
            digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            kind, size = f["WARC-Type"], int(f["Payload-Length"])
            if kind == "response" and (hashlib.sha1(f["payload"]).hexdigest() != digest or len(f["payload"]) != size):
                raise ValueError(f"record at {r.offset} of {r.file} differs from its digest")
            own = f["WARC-Record-ID"].strip("<>").removeprefix(_IDS)
            refers = f["WARC-Refers-To"].strip("<>").removeprefix(_IDS) if kind == "revisit" else "0"
            no_id = own.startswith("none-")
            out.append((0 if no_id else int(own), no_id, f["WARC-Target-URI"], r.url_key, r.time, size, digest, kind, int(refers), f["payload"], r.range, r.place))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _READ.split(", ")])
    if source is not None:
        source.close()


_READ = (
    "page_id long, no_id boolean, url string, url_key string, time string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary, range int, place long"
)


def read_archives(index: DataFrame) -> DataFrame:
    """The records an index names, read from the archives: page_id, url, url_key, time, payload_bytes, payload_digest,
    record_type, refers_to, payload (empty for a revisit), range, place.

    Responses are held against their digest; a difference is an error.
    """
    spark = index.sparkSession
    python_ready(spark)
    wanted = index.select("file", "offset", "size", "url_key", "time", "range", "place")
    found = wanted.repartition(parts_of(spark), "file").sortWithinPartitions("file", "offset").mapInPandas(_read, _READ)
    return found.select(
        F.when(~F.col("no_id"), F.col("page_id")).alias("page_id"), "url", "url_key", "time", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"), "payload", "range", "place",
    )
