"""WARC archives: distributed writing with revisit records, and a reader that salvages damage.

Each writing task keeps its own archive files, one gzip member a record, under
a name that only this attempt uses, and reports a file once it is closed.  The
reports are a table, so what a lost or repeated attempt left behind is never
read.  Reading takes that table, a file a row, in as many tasks as there are
files; no list of files or records passes through the driver.

The reader checks member, version line, header and length of each record, and
the digest of its block.  After a failed check it searches for the next place
where a valid record begins, goes on there, and reports the bytes between as a
gap.  A damaged byte so costs the record that it lies in and no other, also where
a member has several records, as far as the compressed bytes can be read on.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.llm.scratch import Scratch, ship_package

_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
_HEADER_END = re.compile(rb"\r?\n\r?\n")
_MAX_HEADER = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcConfig:
    #: Payloads of at least this many bytes are written once; others always in full.
    min_revisit_bytes: int = 0
    roll_bytes: int = 32 << 20
    compress_level: int = 1
    date: str = "1970-01-01T00:00:00Z"
    #: Record ids are this prefix and the row's id.
    id_prefix: str = "urn:page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- records -------------------------------------------------------------


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record in plain bytes; Block-Digest and Content-Length are added."""
    fields = {"WARC-Type": kind, **fields, "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    offset: int
    length: int
    version: str
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without its HTTP head, where it has one."""
        if self.fields.get("content-type", "").startswith("application/http"):
            m = _HEADER_END.search(self.block)
            return self.block[m.end() :] if m else b""
        return self.block


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    pass


def _parse(data: bytes | memoryview, at: int) -> tuple[Record, int]:
    """The plain record at ``at`` and the place after it."""
    head = bytes(data[at : at + 4096])
    m = _VERSION.match(head)
    if not m:
        raise Damaged("no version line")
    end = _HEADER_END.search(head)
    if not end:
        head = bytes(data[at : at + _MAX_HEADER])
        end = _HEADER_END.search(head)
        if not end:
            raise Damaged("header without an end")
    fields = {}
    for line in re.split(rb"\r?\n", head[m.end() : end.start()]):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no content length")
    n, begin = int(fields["content-length"]), at + end.end()
    block = bytes(data[begin : begin + n])
    if len(block) < n:
        raise Damaged("block cut short")
    tail = bytes(data[begin + n : begin + n + 4])
    if tail not in (b"\r\n\r\n",) and not tail.startswith(b"\n\n"):
        raise Damaged("no blank lines after the block")
    algorithm, _, digest = fields.get("warc-block-digest", "").partition(":")
    if algorithm.lower() == "sha1" and digest.upper() != base32_sha1(block):
        raise Damaged("block digest differs")
    after = begin + n + (4 if tail == b"\r\n\r\n" else 2)
    return Record(at, after - at, head[5 : m.end()].decode("latin-1").strip(), fields, block), after


_STEP = 1 << 16


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """(plain bytes, the place after, what is wrong) of a member; if something is, all that came out up to that place."""
    parts, here, z = [], at, zlib.decompressobj(31)
    step = _STEP
    while here < len(data) and not z.eof:
        try:
            parts.append(z.decompress(data[here : here + step]))
        except zlib.error as e:
            if step == 1:
                return b"".join(parts), here, f"gzip member: {e}"
            # what a failed call had put out is lost: begin again, and go byte by byte where it failed
            z, parts = zlib.decompressobj(31), []
            for k in range(at, here, _STEP):
                parts.append(z.decompress(data[k : k + _STEP]))
            step = 1
            continue
        here = min(here + step, len(data))
    if not z.eof:
        return b"".join(parts), len(data), "gzip member cut short"
    return b"".join(parts), here - len(z.unused_data), None


def _member_records(data: memoryview, at: int) -> Iterator[Record | str | int]:
    """The records of a member, the reason of each damage in it, and at last the place after it, inverted (``~``) if it is cut or damaged.

    In a member that is itself damaged a record counts if its digest is right
    and the output goes on after it, or if damage was found before it.
    """
    plain, after, wrong = _inflate(data, at)
    inner, damaged = 0, False
    while inner < len(plain):
        try:
            one, end = _parse(plain, inner)
            if wrong and (not one.fields.get("warc-block-digest", "").lower().startswith("sha1:") or end == len(plain) and not damaged):
                raise Damaged(wrong)
            yield Record(at, after - at, one.version, one.fields, one.block)
            inner = end
        except Damaged as e:
            if not wrong:
                yield str(e)
            damaged = True
            following = _VERSION.search(plain, inner + 1)
            inner = following.start() if following else len(plain)
            while following and not _is_valid(memoryview(plain), inner):
                following = _VERSION.search(plain, inner + 1)
                inner = following.start() if following else len(plain)
    if wrong:
        yield wrong
    yield ~after if wrong else after


def _is_valid(data: memoryview, at: int) -> bool:
    if bytes(data[at : at + 3]) == _MAGIC:
        return any(isinstance(x, Record) for x in _member_records(data, at))
    try:
        _parse(data, at)
        return True
    except Damaged:
        return False


def _next_start(raw: bytes, data: memoryview, at: int, plain_from: int) -> int:
    """The next place after ``at`` where a valid record begins, or the end; plain ones from ``plain_from``."""
    gz, plain = raw.find(_MAGIC, at + 1), _VERSION.search(raw, plain_from)
    while gz >= 0 or plain:
        here = min(x for x in (gz if gz >= 0 else None, plain.start() if plain else None) if x is not None)
        if _is_valid(data, here):
            return here
        if here == gz:
            gz = raw.find(_MAGIC, here + 1)
        else:
            plain = _VERSION.search(raw, here + 1)
    return len(raw)


def read_records(raw: bytes) -> Iterator[Record | Gap]:
    """The records of an archive's bytes, plain or in gzip members, and the gaps between them."""
    data, at = memoryview(raw), 0
    while at < len(raw):
        plain_from = at + 1
        try:
            if bytes(data[at : at + 3]) == _MAGIC:
                reasons, after = [], 0
                for x in _member_records(data, at):
                    if isinstance(x, Record):
                        yield x
                    elif isinstance(x, str):
                        reasons.append(x)
                    else:
                        after = x
                if after < 0:
                    # what came out has been read: stored bytes are no plain records
                    plain_from = max(at + 1, ~after)
                    raise Damaged(reasons[-1])
                # what lies inside a member has no place of its own in the file
                yield from (Gap(at, after - at, r) for r in reasons)
            else:
                one, after = _parse(data, at)
                yield one
            at = after
        except Damaged as e:
            end = _next_start(raw, data, at, plain_from)
            yield Gap(at, end - at, str(e))
            at = end


# --- Spark jobs ----------------------------------------------------------


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, config: WarcConfig = WarcConfig(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, payload, sha1, refers_to) of each row; ``refers_to`` is null for a response.

    Of rows with equal payloads the one with the least id is the response.  Only
    ids and digests are grouped; a hot payload combines before the shuffle, and
    payloads move at most once, by id.  A null html is an empty payload.  Rows
    without an id revisit the least id of their payload, or are responses.
    Rows that repeat the response's id and payload are responses too.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    keys = rows.where(F.octet_length("payload") >= config.min_revisit_bytes).select("id", "sha")
    first = keys.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("sha", "first")
    later = keys.join(first, "sha").where("not id <=> first").select(F.col("id").alias("i"), F.col("sha").alias("s"), F.col("first").alias("refers_to")).distinct()
    return rows.join(later, F.col("id").eqNullSafe(F.col("i")) & (F.col("sha") == F.col("s")), "left").select("id", "url", "payload", "sha", "refers_to")


def write_archives(pages: DataFrame, folder: str, config: WarcConfig = WarcConfig(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record a row below ``folder`` (a URI that all machines reach).

    The result has a row for each finished file: file, records, bytes.  It does
    the writing whenever it is evaluated, so save it before it is used.
    """
    ship_package(pages.sparkSession)

    def run(batches):
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def finish():
            out.close()
            fs.move(f"{root}/.{name}", f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in zip(*batch.columns):
                id_, url, payload, sha, first = (x.as_py() for x in row)
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/.{name}", compression=None)
                data = member(_page_record(id_, url, payload, sha, first, config), config.compress_level)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= config.roll_bytes:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    return plan_records(pages, config, id_col, url_col, html_col).mapInArrow(run, "file string, records long, bytes long")


def _page_record(id_, url: str | None, payload: bytes, sha: str, first, config: WarcConfig) -> bytes:
    fields = {
        "WARC-Record-ID": f"<{config.id_prefix}{'' if id_ is None else id_}>",
        "WARC-Date": config.date,
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(sha)).decode()}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        fields["WARC-Target-URI"] = url
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        return record("response", fields, head + payload)
    fields |= {"WARC-Refers-To": f"<{config.id_prefix}{first}>", "WARC-Profile": PROFILE, "WARC-Truncated": "length"}
    return record("revisit", fields, head)


ARCHIVE_SCHEMA = "file string, offset long, length long, record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, declared_bytes long, payload binary, gap string"
_ARCHIVE = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), *((n, pa.string()) for n in ("record_type", "record_id", "target_uri", "date", "payload_digest", "refers_to")), ("declared_bytes", pa.int64()), ("payload", pa.binary()), ("gap", pa.string())]
)
_HTTP_LENGTH = re.compile(rb"(?im)^content-length:\s*([0-9]+)\s*$")


def _row(file: str, x: Record | Gap) -> dict:
    out = dict.fromkeys(_ARCHIVE.names) | {"file": file, "offset": x.offset, "length": x.length}
    if isinstance(x, Gap):
        return out | {"gap": x.reason}
    f = x.fields
    declared = _HTTP_LENGTH.search(x.block[: len(x.block) - len(x.payload)])
    digest = f.get("warc-payload-digest", "")
    kind = f.get("warc-type")
    if kind == "revisit":
        payload = None
    else:
        payload, digest = x.payload, f"sha1:{base32_sha1(x.payload)}"
    return out | {
        "record_type": kind, "record_id": f.get("warc-record-id", "").strip("<>"), "target_uri": f.get("warc-target-uri"), "date": f.get("warc-date"),
        "payload_digest": digest.partition(":")[2], "refers_to": f.get("warc-refers-to", "").strip("<>") or None, "declared_bytes": int(declared[1]) if declared else None, "payload": payload,
    }


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the files named in column ``file``, and a row with ``gap`` for each damaged stretch.

    Where ``files`` has a column ``records`` and a file has another number of
    records, a row with ``gap`` at the file's end says so.
    Digests of records with a payload are computed from what was read; those of
    revisits are as declared.  A file that is empty has no rows; one that cannot
    be opened fails the job, for it is missing rather than damaged.
    """
    ship_package(files.sparkSession)

    def run(batches):
        for batch in batches:
            for file, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = _open(file)
                with fs.open_input_file(path) as f:
                    raw = f.read()
                rows, held = [], 0
                for x in _counted(read_records(raw), expected, len(raw)):
                    row = _row(file, x)
                    if row["payload"] is not None and not with_payload:
                        row["declared_bytes"], row["payload"] = len(row["payload"]), None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARCHIVE)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARCHIVE)

    expected = F.col("records") if "records" in files.columns else F.lit(None)
    return files.select("file", expected.cast("long")).mapInArrow(run, ARCHIVE_SCHEMA)


def _counted(found: Iterator[Record | Gap], expected: int | None, size: int) -> Iterator[Record | Gap]:
    seen = 0
    for x in found:
        seen += isinstance(x, Record)
        yield x
    if expected is not None and seen != expected:
        yield Gap(size, 0, f"{seen} records where {expected} were written")


def salvage(files: DataFrame, scratch: Scratch, with_payload: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of ``read_archives``, both written: the quarantine has file, offset, length and gap."""
    found = scratch.save(read_archives(files, with_payload), "read")
    return found.where("gap is null").drop("gap"), found.where("gap is not null").select("file", "offset", "length", "gap")


def archive_round_trip(pages: DataFrame, config: WarcConfig = WarcConfig(), id_col: str = "page_id") -> DataFrame:
    """Write all pages to archives in the shared folder and read them back, without payloads."""
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "warc")
    written = scratch.save(write_archives(pages, scratch.path("archives"), config, id_col), "files")
    # one task a file, as far as there are tasks; a row here stands for some 32 MB
    found, quarantine = salvage(written.repartition(spark.sparkContext.defaultParallelism * 4, "file"), scratch, with_payload=False)
    damage = quarantine.take(10)
    if damage:  # an archive just written has none: a gap is lost rows
        raise ValueError(f"damaged archives, quarantined in {scratch.path('read')}: {damage}")
    scratch.drop("archives")
    kind = pages.schema[id_col].dataType
    number = lambda c: F.nullif(F.substring(c, len(config.id_prefix) + 1, 1 << 30), F.lit("")).cast(kind)
    return found.select(number(F.col("record_id")).alias(id_col), F.col("declared_bytes").alias("payload_bytes"), "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"))
