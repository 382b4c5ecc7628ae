"""WARC archives: written with revisit records for repeated payloads, read back by boundary-chain verification.

Writing: payloads are grouped by SHA-256 and length.  Of equal payloads of ``REVISIT_BYTES`` or more, the page with
the smallest id is a ``response``, the others are ``revisit`` records that refer to it.  Tasks write files of about
``FILE_BYTES`` bytes; each record is a gzip member of its own, as is usual, or stands as it is (``compress=False``).

Reading: files are cut into splits of ``SPLIT`` bytes.  A task looks for the magic of a record in its split, parses
what it finds there, and gives each candidate's offset, its successor's offset and where the chain of candidates
leaves the split or stops.  Any well-formed record is a candidate, whatever its type or digest.  Payloads may hold the
magic, even whole records, so a candidate counts only if the chain from the start of the file reaches it.  That is
found by pointer jumping over the offsets at which chains enter splits: in each round the reached set takes one jump
and all jumps double, so a file of n splits takes log2(n) rounds.  Within a split the chain is followed from its
entry.  A chain must end at its file's last byte.  Where one stops before, at a damaged or cut off record, the file and
the offset are reported, and reading fails unless it is asked for what could be reached.

Null html counts as empty.  Pages with a null id are responses and nothing refers to them.  Pages that share the
smallest id of equal payloads are all responses.  Line ends in a url are escaped, a null url is left out.  Payloads
and headers of any length are read whole.  An empty table makes no files, and an empty file holds no records.  Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm.shared import shared_folder, store, stored, whole_file

REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
SPLIT = 8 << 20
#: Rows that refer to one digest are joined in so many parts.
SALT = 32

# Names and values of the WARC 1.1 format (fixed values).
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"

MANIFEST = "file string, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, intact boolean"
CANDIDATE = f"file string, split long, offset long, next long, exit long, {RECORD}"


def record_id(page_id: int | None, digest: str) -> bytes:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>".encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One record; with ``refers_to`` a revisit, which leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + record_id(page_id, digest),
        b"WARC-Date: " + date.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url).encode())
    if page_id is not None:
        lines.append(b"X-Page-Id: %d" % page_id)
    if revisit:
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + record_id(refers_to, digest), b"X-Refers-To-Page-Id: %d" % refers_to]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + END + block + END


def _fields(head: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}


def _agrees(declared: str, payload: bytes) -> bool:
    """Whether a labelled digest, in hexadecimal or base 32, is the payload's; one of an unknown kind is not judged."""
    kind, _, value = declared.partition(":")
    if kind.lower() not in ("md5", "sha1", "sha256", "sha512"):
        return True
    digest = hashlib.new(kind.lower(), payload).digest()
    return value.lower() == digest.hex() or value.upper() == base64.b32encode(digest).decode()


def parsed(data: bytes) -> tuple | None:
    """Columns of ``RECORD`` from a well-formed record of any type, or None if it isn't one.

    The payload is what follows the HTTP header, or else the whole block.  ``payload_digest`` is its SHA-256; of a
    revisit, which has no payload, digest and length are those declared.  ``intact`` is false where the declared
    digest or length is not the payload's.
    """
    head, found, rest = data.partition(END)
    if not found or not head.startswith(b"WARC/1."):
        return None
    fields = _fields(head)
    if not fields.get(b"content-length", b"").isdigit() or len(rest) != int(fields[b"content-length"]) + len(END) or not rest.endswith(END):
        return None
    text = lambda name: fields.get(name, b"").decode("utf-8", "replace")
    number = lambda name: int(fields[name]) if fields.get(name, b"").isdigit() else None
    kind, declared, payload, length = text(b"warc-type"), text(b"warc-payload-digest"), rest[: -len(END)], None
    if text(b"content-type").startswith("application/http"):
        http, _, payload = payload.partition(END)
        length = _fields(http).get(b"content-length", b"").decode("ascii", "replace")
    if kind == "revisit":
        size, digest, intact = int(length) if length and length.isdigit() else None, declared.removeprefix("sha256:") or None, True
    else:
        size, digest, intact = len(payload), hashlib.sha256(payload).hexdigest(), _agrees(declared, payload)
    return number(b"x-page-id"), size, digest, kind, number(b"x-refers-to-page-id"), text(b"warc-target-uri") or None, intact


class _Part:
    """A file from an offset on, read as far as a record needs."""

    def __init__(self, uri: str, start: int, end: int):
        fs, path = store(uri)
        self.source, self.start, self.end = fs.open_input_file(path), start, end
        self.length = self.source.size()
        self.data = b""
        self.extend(end - start + 4096)

    def extend(self, n: int) -> bool:
        self.source.seek(self.start + len(self.data))
        more = self.source.read(min(n, self.length - self.start - len(self.data)))
        self.data += more
        return bool(more)

    def magics(self) -> Iterator[int]:
        pattern = re.compile(re.escape(GZIP) + rb"|WARC/1\.")
        for found in pattern.finditer(self.data, 0, min(len(self.data), self.end - self.start + 8)):
            if found.start() < self.end - self.start:
                yield found.start()

    def record_at(self, at: int) -> tuple[int, bytes] | None:
        """End (from the part's start) and bytes of the record that begins at ``at``, if one does."""
        return self._member(at) if self.data.startswith(GZIP, at) else self._plain(at)

    def _member(self, at: int) -> tuple[int, bytes] | None:
        stream, parts, used = zlib.decompressobj(wbits=31), [], at
        while True:
            try:
                parts.append(stream.decompress(self.data[used : used + (1 << 16)]))
            except zlib.error:
                return None
            if len(parts) == 1 and not VERSION.startswith(parts[0][:7]) and not parts[0].startswith(b"WARC/1."):
                return None
            used = min(used + (1 << 16), len(self.data))
            if stream.eof:
                return used - len(stream.unused_data), b"".join(parts)
            if used == len(self.data) and not self.extend(1 << 20):
                return None

    def _plain(self, at: int) -> tuple[int, bytes] | None:
        searched = at
        while (stop := self.data.find(END, searched)) < 0:
            searched = max(at, len(self.data) - len(END))
            if not self.extend(1 << 16):
                return None
        length = _fields(self.data[at:stop]).get(b"content-length", b"")
        if not length.isdigit():
            return None
        end = stop + 2 * len(END) + int(length)
        if self.start + end > self.length:
            return None
        if end > len(self.data):
            self.extend(end - len(self.data))
        return end, self.data[at:end]


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            part = _Part(row.file, row.start, row.end)
            found: dict[int, tuple] = {}
            for at in part.magics():
                if (whole := part.record_at(at)) and (columns := parsed(whole[1])):
                    found[row.start + at] = (row.start + whole[0], *columns)
            exits: dict[int, int] = {}
            for offset in sorted(found, reverse=True):
                following = found[offset][0]
                exits[offset] = exits.get(following, following)  # beyond the split, or where no record follows
            rows = [(row.file, row.split, o, x[0], exits[o], *x[1:]) for o, x in found.items()]
            table = pd.DataFrame(rows, columns=[x.split()[0] for x in CANDIDATE.split(", ")])
            yield table.astype({"page_id": "Int64", "refers_to": "Int64"})


def _follow(group: pd.DataFrame) -> pd.DataFrame:
    """Records of a split that the chain from its entry reaches."""
    following = dict(zip(group["offset"], group["next"], strict=True))
    reached = set()
    for at in group.loc[group["entry"], "offset"]:
        while at in following and at not in reached:
            reached.add(at)
            at = following[at]
    return group.loc[group["offset"].isin(reached), [x.split()[0] for x in RECORD.split(", ")]]


def _entries(candidates: DataFrame, files: DataFrame, splits: int) -> DataFrame:
    """``file, at``: where the chains from the files' starts enter splits, and where they end."""
    starts = files.select("file", F.lit(0).cast("long").alias("at")).distinct()
    targets = starts.union(candidates.select("file", F.col("exit").alias("at"))).distinct()
    jumps = stored(
        targets.join(candidates.select("file", F.col("offset").alias("at"), F.col("exit").alias("to")), ["file", "at"]), "warc-jumps"
    )
    reached, rounds = starts, 1
    while True:
        step = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stored(reached.union(step).distinct(), "warc-reached")
        rounds *= 2
        if rounds > splits:
            return reached
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jumps = stored(jumps.join(second, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "warc-jumps")


def write_archives(pages: DataFrame, folder: str | None = None, compress: bool = True, file_bytes: int = FILE_BYTES) -> str:
    """Write pages (``page_id, url, html``) as archives with a manifest; returns the folder."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    long = stored(rows.where(F.octet_length("html") >= REVISIT_BYTES).where("page_id IS NOT NULL").select("page_id", "digest"), "warc-digests")
    groups = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).drop("n")
    revisits = (
        long.withColumn("part", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
        .join(parts, ["digest", "part"])
        .where("page_id != refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )
    marked = rows.join(revisits, ["page_id", "digest"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            record(page, url, html.encode(), digest, refers)
            for batch in batches
            for page, url, html, digest, refers in zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "html", "digest", "refers_to")), strict=True)
        )
        part, number = TaskContext.get().partitionId(), 0
        for first in records:
            name = f"{folder}/files/part-{part:06d}-{number:04d}.warc" + ".gz" * compress
            with whole_file(name) as out:
                written = 0
                data: bytes | None = first
                while data is not None:
                    if compress:
                        stream = zlib.compressobj(4, zlib.DEFLATED, 31)
                        data = stream.compress(data) + stream.flush()
                    written += out.write(data)
                    data = next(records, None) if written < file_bytes else None
            number += 1
            yield pa.RecordBatch.from_pydict({"file": [name], "length": [written]})

    marked.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def listed(spark: SparkSession, path: str) -> DataFrame:
    """Archives below a path, made by whomever: ``file, length``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path)
    return files.select(F.col("path").alias("file"), "length")


class Archives(NamedTuple):
    """Records that chains reach, and where chains stop before the end of their file."""

    records: DataFrame
    broken: DataFrame


def scan_archives(files: DataFrame, split: int = SPLIT) -> Archives:
    """Columns of ``RECORD`` for every record that the chains of ``files`` (file, length) reach; ``broken`` has the
    ``file``, its ``length`` and the ``offset`` at which no record could be read."""
    spark = files.sparkSession
    splits = files.where("length > 0").select(
        "file", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start")
    )
    splits = splits.select(
        "file", (F.col("start") / split).cast("long").alias("split"), "start", F.least("length", F.col("start") + split).alias("end")
    )
    most = (splits.agg(F.max("split")).first()[0] or 0) + 1
    dealt = splits.repartition(max(1, min(splits.count(), 4 * spark.sparkContext.defaultParallelism)), "file", "start")
    candidates = stored(dealt.mapInPandas(_candidates, CANDIDATE), "warc-candidates")
    entries = _entries(candidates, files, most)
    marks = entries.select("file", F.col("at").alias("offset"), F.lit(True).alias("entry"))
    flagged = candidates.join(marks, ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    ends = entries.withColumnRenamed("at", "offset").join(candidates.select("file", "offset"), ["file", "offset"], "left_anti")
    broken = ends.join(files.select("file", "length"), "file").where("offset != length").select("file", "length", "offset")
    return Archives(flagged.groupBy("file", "split").applyInPandas(_follow, RECORD), broken)


def read_archives(spark: SparkSession, folder: str, split: int = SPLIT) -> DataFrame:
    """All records of the archives that ``write_archives`` put into a folder; fails where one can't be read."""
    found = scan_archives(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"), split)
    stops = found.broken.orderBy("file", "offset").limit(5).collect()
    if stops:
        raise ValueError("no record at " + ", ".join(f"{r.offset} of {r.length} in {r.file}" for r in stops))
    return found.records


def archive(pages: DataFrame, **how) -> DataFrame:
    """Write pages and read their records back."""
    found = read_archives(pages.sparkSession, write_archives(pages, **how))
    damaged = F.raise_error(F.concat(F.lit("damaged payload of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    checked = F.when(F.col("intact"), F.col("payload_digest")).otherwise(damaged.cast("string"))
    return found.withColumn("payload_digest", checked).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
