"""WARC records in ZIP packages, written and read back by ranges.

A package is a ZIP file with two *stored* members: ``archive/data.warc.gz``, one gzip member per WARC record, and
``indexes/index.cdxj`` with a line per record. The reader finds the end record, follows the ZIP64 locator where there is
one, parses the central directory with its ZIP64 fields, and takes the place of a stored member from its local header.
Records are then read by byte range straight from the package; nothing is unpacked.

Of records with equal payloads of at least ``MIN_BYTES`` bytes the one with the largest ``page_id`` is a response and the
others are revisits that name it. Revisit records hold the HTTP header of the payload and its digest, but no payload.

A null payload is empty. Rows without ``page_id`` are revisits of their payload's response, or responses if no row of
that payload has a number. Rows that repeat the largest number are all responses. Tasks write packages under names of
their own and report them; only reported packages are read, so a lost task leaves nothing that counts.
"""

from __future__ import annotations

import base64
import gzip
import json
import re
import struct
import zipfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import MAX_SENT_IDS, scratch, written
from chronoloom.llm.files import open_in, open_out

MIN_BYTES = 0
PACKAGE_BYTES = 1 << 30
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Records that one task row reads.
RANGE_RECORDS = 500
DATE = "2024-01-01T00:00:00Z"


def digest(payload: Column) -> Column:
    """Base32 SHA-1 of bytes, in upper case."""
    hexed, alphabet = F.sha1(payload), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    # Five hex digits are four signs of base 32.
    quads = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substr(hexed, g * 5 + 1, F.lit(5)), 16, 10).cast("int")
    )
    sign = lambda q, bits: F.substr(alphabet, F.shiftright(q, bits).bitwiseAND(31) + 1, F.lit(1))
    return F.array_join(F.transform(quads, lambda q: F.concat(*[sign(q, b) for b in (15, 10, 5, 0)])), "")


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to``, null for a response."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", digest(F.col("payload")))
    sized = rows.filter(F.length("payload") >= MIN_BYTES)
    shared = sized.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.filter("n > 1 AND response IS NOT NULL").drop("n"), "shared-payloads")
    limit = MAX_SENT_IDS // 6  # a digest is 32 bytes
    shared = F.broadcast(shared) if shared.limit(limit + 1).count() <= limit else shared
    joined = rows.join(shared, "digest", "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("response")), None).otherwise(F.col("response"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _urn(page_id: object) -> str:
    return f"<urn:page:{'' if pd.isna(page_id) else int(page_id)}>"


def _line(text: str | None) -> str:
    """A header value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", text or "")


def record(page_id: object, url: str | None, payload: bytes, name: str, refers_to: object) -> bytes:
    """A WARC record, gzip-compressed by itself."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = not pd.isna(refers_to)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{name}",
    ]
    if revisit:
        head += [
            f"WARC-Refers-To: {_urn(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def _writer(folder: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, opened = [], None

        def start() -> list:
            path = f"{folder}/{uuid4().hex}.wacz"
            out = open_out(path)
            package = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
            return [path, out, package, package.open(DATA, "w", force_zip64=True), 0, []]

        def finish(state: list) -> None:
            path, out, package, data, _, lines = state
            data.close()
            with package.open(INDEX, "w", force_zip64=True) as index:
                index.write("".join(lines).encode())
            package.close()
            out.close()
            done.append((path, len(lines)))

        for batch in batches:
            for row in zip(*[batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                opened = opened or start()
                body = record(*row)
                opened[3].write(body)
                line = {"offset": opened[4], "length": len(body)}
                opened[5].append(f"{_urn(row[0])[1:-1]} {DATE} {json.dumps(line)}\n")
                opened[4] += len(body)
                if opened[4] >= PACKAGE_BYTES:
                    finish(opened)
                    opened = None
        if opened:
            finish(opened)
        yield pd.DataFrame(done, columns=["path", "records"])

    return run


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every row; returns ``path`` and ``records`` of each package."""
    # Ids go as text: pandas would make floats of a column of numbers that has a null.
    ids = {name: F.col(name).cast("string") for name in ("page_id", "refers_to")}
    rows = with_roles(pages).withColumns(ids).mapInPandas(_writer(folder), "path string, records bigint")
    return written(rows, "packages")


# Reading


class Package:
    """A ZIP file read by ranges: its central directory, and where stored members lie."""

    # Fixed values of the format: signatures and lengths of the records.
    END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
    END_SIZE, END64_SIZE, LOCATOR_SIZE, ENTRY_SIZE, LOCAL_SIZE = 22, 56, 20, 46, 30
    FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

    def __init__(self, path: str):
        self.source = open_in(path)
        self.size = self.source.size()

    def _directory(self) -> tuple[int, int]:
        """Place and length of the central directory."""
        span = min(self.size, self.END_SIZE + 0xFFFF)
        tail = self.source.read_at(span, self.size - span)
        at = tail.rfind(self.END)
        while at >= 0:
            if at + self.END_SIZE <= len(tail):
                count, length, place, note = struct.unpack("<HIIH", tail[at + 10 : at + self.END_SIZE])
                if at + self.END_SIZE + note == len(tail):
                    break
            at = tail.rfind(self.END, 0, at)
        if at < 0:
            raise ValueError("not a ZIP file")
        end = self.size - span + at
        if end >= self.LOCATOR_SIZE:
            locator = self.source.read_at(self.LOCATOR_SIZE, end - self.LOCATOR_SIZE)
            if locator[:4] == self.LOCATOR:
                far = self.source.read_at(self.END64_SIZE, struct.unpack("<Q", locator[8:16])[0])
                if far[:4] != self.END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                length, place = struct.unpack("<QQ", far[40:56])
        return place, length

    def members(self) -> list[dict]:
        """Name, method, place of the local header, and lengths of every member."""
        place, length = self._directory()
        raw, at, out = self.source.read_at(length, place), 0, []
        while raw[at : at + 4] == self.ENTRY:
            method, packed, plain = struct.unpack("<H8xII", raw[at + 10 : at + 28])
            name, extra, note = struct.unpack("<HHH", raw[at + 28 : at + 34])
            header = struct.unpack("<I", raw[at + 42 : at + 46])[0]
            fields, first = raw[at + 46 + name : at + 46 + name + extra], 0
            while first + 4 <= len(fields):
                kind, size = struct.unpack("<HH", fields[first : first + 4])
                if kind == 1:
                    wide = iter(struct.unpack(f"<{size // 8}Q", fields[first + 4 : first + 4 + size // 8 * 8]))
                    plain = next(wide) if plain == self.FULL32 else plain
                    packed = next(wide) if packed == self.FULL32 else packed
                    header = next(wide) if header == self.FULL32 else header
                first += 4 + size
            out.append({"name": raw[at + 46 : at + 46 + name].decode(), "method": method, "header": header, "size": packed, "plain": plain})
            at += self.ENTRY_SIZE + name + extra + note
        return out

    def stored(self, name: str) -> tuple[int, int]:
        """Place and length of the bytes of a stored member."""
        member = next(m for m in self.members() if m["name"] == name)
        if member["method"]:
            raise ValueError(f"{name} is compressed")
        local = self.source.read_at(self.LOCAL_SIZE, member["header"])
        if local[:4] != self.LOCAL:
            raise ValueError(f"no local header for {name}")
        return member["header"] + self.LOCAL_SIZE + sum(struct.unpack("<HH", local[26:30])), member["size"]

    def read(self, place: int, size: int) -> bytes:
        return self.source.read_at(size, place)


RANGES = "path string, first bigint, offsets array<bigint>, lengths array<bigint>"
RECORDS = (
    "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, "
    "payload binary"
)


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of the records, from the index of each package."""
    for batch in batches:
        for path in batch["path"]:
            package = Package(path)
            base = package.stored(DATA)[0]
            lines = package.read(*package.stored(INDEX)).decode().splitlines()
            places = [json.loads(line.split(" ", 2)[2]) for line in lines]
            groups = [places[i : i + RANGE_RECORDS] for i in range(0, len(places), RANGE_RECORDS)]
            yield pd.DataFrame(
                {
                    "path": path,
                    "first": [base + g[0]["offset"] for g in groups],
                    "offsets": [[base + p["offset"] for p in g] for g in groups],
                    "lengths": [[p["length"] for p in g] for g in groups],
                }
            )


def parsed(raw: bytes) -> dict:
    """The parts of a record."""
    head, _, block = gzip.decompress(raw).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    number = lambda key: int(m.group(1)) if (m := re.match(r"<urn:page:(-?\d+)>", fields.get(key, ""))) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": size,
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _reader(with_payload: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            for path, offsets, lengths in zip(batch["path"], batch["offsets"], batch["lengths"]):
                package, rows = Package(path), []
                for place, size in zip(offsets, lengths):
                    row = parsed(package.read(int(place), int(size)))
                    if row["payload"] is not None:
                        found = base64.b32encode(hashlib.sha1(row["payload"]).digest()).decode()
                        if found != row["payload_digest"] or len(row["payload"]) != row["payload_bytes"]:
                            raise ValueError(f"damaged record at {place} of {path}")
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                columns = {name: [row[name] for row in rows] for name in rows[0]} if rows else {}
                for name in ("page_id", "refers_to"):
                    columns[name] = pd.array(columns.get(name, []), dtype="Int64")
                yield pd.DataFrame(columns)

    return run


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the packages in ``path``; digests of payloads are checked. Revisits have no payload of their own."""
    parts = max(1, int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = packages.select("path").repartition(parts, "path").mapInPandas(_ranges, RANGES)
    return ranges.repartition(parts, "path", "first").mapInPandas(_reader(with_payload), RECORDS)


def warc_table(pages: DataFrame) -> DataFrame:
    """One row per page, from the records read back."""
    packages = write_packages(pages, scratch(pages.sparkSession, "warc"))
    rows = read_packages(packages, with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
