"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP whose members are stored as they are: `archive/data.warc.gz`,
in which every record is a gzip member of its own, and `indexes/index.jsonl`,
a line for each record with its place. The reader parses the end record, the
ZIP64 records where the plain ones are full, and the central directory; a
stored member is then a range of the package, a record is a range of that, and
nothing is unpacked. Ranges that lie close together are read at once.

Packages go to the shared folder through the file system of its address. A task
writes packages of bounded size under names of its own and reports them only
when they are complete; the report is a table, so packages of a task that was
lost or run twice are never looked at.

Of pages with equal payloads of at least 100 bytes the one with the smallest id
is a response, the others are revisits without a payload. Rows that repeat the
smallest id are all responses; null ids come after all others. A null payload
is empty. Other columns of the table are not looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import chunks, fresh_path, written
from logweir.operators.lookup import lookup_join

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
LEAST_REVISIT = 100
PACKAGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
_HOST = "urn:page:"


# -- the ZIP directory -------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int  # place of its local header


class Ranged:
    """Byte ranges of a file: anything with size() and read_at(length, offset)."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()

    def read(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError(f"file ends inside a range: {offset}+{length}")
        return data


class InMemory:
    def __init__(self, data: bytes):
        self.data = data

    def size(self) -> int:
        return len(self.data)

    def read_at(self, length: int, offset: int) -> bytes:
        return self.data[offset : offset + length]


def directory(file: Ranged) -> dict[str, Member]:
    """Members by name, from the central directory. Layouts are those of the public ZIP format."""
    tail_at = max(0, file.size - 22 - 0xFFFF)
    tail = file.read(tail_at, file.size - tail_at)
    # The last mark from which the note reaches exactly to the end of the file.
    end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP package: no end record")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    end_at = tail_at + end
    if end_at >= 20 and (count == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF):
        locator = file.read(end_at - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            far = file.read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if far[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator points")
            count, size, start = struct.unpack_from("<QQQ", far, 32)
    central = file.read(start, size)
    members, at = {}, 0
    for _ in range(count):
        if central[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", central, at + 8)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", central, at + 20)
        header = struct.unpack_from("<I", central, at + 42)[0]
        name = central[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = central[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, header = _wide(extra, plain, packed, header)
        members[name] = Member(name, method, packed, plain, header)
        at += 46 + n_name + n_extra + n_note
    return members


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values that did not fit four bytes stand in the ZIP64 field, in this order."""
    at, out = 0, list(values)
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            inner = at + 4
            for i, v in enumerate(out):
                if v == 0xFFFFFFFF:
                    out[i] = struct.unpack_from("<Q", extra, inner)[0]
                    inner += 8
        at += 4 + size
    return out


def stored_at(file: Ranged, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed: its records cannot be read by range")
    head = file.read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


# -- records -----------------------------------------------------------------


def _record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += [f"{k}: {v}" for k, v in fields.items()]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    fields = {"WARC-Record-ID": f"<{_HOST}{'' if page_id is None else page_id}>"}
    if url:
        fields["WARC-Target-URI"] = re.sub(r"\s", "%20", url)
    fields["WARC-Payload-Digest"] = f"sha256:{digest}"
    fields["X-Payload-Length"] = str(len(payload))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if revisit:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = f"<{_HOST}{'' if refers_to is None else refers_to}>"
        return _record("revisit", fields, http)
    return _record("response", fields, http + payload)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and HTTP body of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _page(field: str) -> int | None:
    digits = field.strip("<>").removeprefix(_HOST)
    return int(digits) if digits else None


# -- packages ----------------------------------------------------------------


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class Package:
    """One package being written: records go straight to the stored member, the index follows."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id: int | None, data: bytes) -> None:
        packed = gzip.compress(data, 3, mtime=0)
        self.member.write(packed)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> int:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        return len(self.lines)


def write_packages(pages: DataFrame, folder: str, most: int = PACKAGE_BYTES) -> DataFrame:
    """path, records of each package. Needs page_id, url, html, digest, revisit, refers_to."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        package = stream = path = None
        done: list[tuple[str, int]] = []

        def finish() -> None:
            nonlocal package
            if package is not None:
                count = package.close()
                stream.close()
                done.append((path, count))
                package = None

        for part in chunks(batches, "html"):
            for page, url, html, digest, revisit, refers in part.itertuples(index=False):
                if package is None:
                    path = f"{root}/{uuid.uuid4().hex}.zip"
                    stream = system.open_output_stream(path)
                    package = Package(stream)
                page_id = None if pd.isna(page) else int(page)
                payload = (html or "").encode("utf-8", "surrogatepass")
                package.add(page_id, record(page_id, url, payload, digest, None if pd.isna(refers) else int(refers), bool(revisit)))
                if package.size >= most:
                    finish()
        finish()
        yield pd.DataFrame(done, columns=["path", "records"])

    rows = pages.select(F.col("page_id").astype("long"), "url", "html", "digest", "revisit", "refers_to")
    return rows.mapInPandas(run, "path string, records long")


def read_package(file: Ranged) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a package in the order of its index."""
    members = directory(file)
    index = members[INDEX]
    base = stored_at(file, members[ARCHIVE])
    text = file.read(stored_at(file, index), index.size).decode()
    places = [json.loads(line) for line in text.split("\n") if line]
    i = 0
    while i < len(places):
        first, j = places[i]["offset"], i
        while j + 1 < len(places) and places[j + 1]["offset"] + places[j + 1]["length"] - first <= READ_BYTES:
            j += 1
        data = file.read(base + first, places[j]["offset"] + places[j]["length"] - first)
        for place in places[i : j + 1]:
            at = place["offset"] - first
            yield parse_record(gzip.decompress(data[at : at + place["length"]]))
        i = j + 1


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of every record.

    Digests of responses are computed from the payload read and compared with the record's field.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = _open(folder)
        for batch in batches:
            for path in batch["path"]:
                rows, held = [], 0
                with system.open_input_file(path) as opened:
                    for fields, payload in read_package(Ranged(opened)):
                        kind = fields["WARC-Type"]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(fields["X-Payload-Length"])
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
                        refers = _page(fields["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), payload, size, digest, kind, refers))
                        held += len(payload)
                        if held > READ_BYTES:
                            yield _frame(rows)
                            rows, held = [], 0
                yield _frame(rows)

    schema = (
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    # A package for a task at a time; there are few of them for each task that wrote.
    return packages.select("path").mapInPandas(run, schema)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = pd.DataFrame(rows, columns=columns)
    for c in ("page_id", "payload_bytes", "refers_to"):
        out[c] = out[c].astype("Int64")
    return out


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, revisit, refers_to of every page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"),
        F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).alias("size"),
    )
    # Digests that occur more than once; counted before the shuffle.
    again = keyed.where(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    again = written(again.where("n > 1").select(F.col("digest").alias("again"), "first"), "payloads")
    out = lookup_join(keyed, again, "digest", "again")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as records, then read every package back."""
    folder = fresh_path(pages.sparkSession, "packages")
    packages = written(write_packages(with_revisits(pages), folder), "manifest")
    return read_packages(packages.repartition(packages.sparkSession.sparkContext.defaultParallelism), folder)
