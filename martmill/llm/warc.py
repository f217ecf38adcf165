"""Derivatives of WARC responses: for each response a metadata record and a plain-text conversion record.

Both name the response in ``WARC-Refers-To`` and keep its target and date. The metadata record (``application/warc-fields``)
carries the WARC headers and digests of its source, the HTTP status and headers in their order, the links of the page and
the id and digest of the conversion; the conversion holds the text of all blocks of the page. Ids follow from the source's
id, so a task that runs again writes the same records. Rows go in and come out; nothing is shuffled.

``read`` and ``write`` turn files into rows and back with Spark's text source: records end in two line ends, and a reader
that cuts there streams plain and gzipped files of any size.

Defined cases
* Records that are no response give nothing. A null block is empty: its conversion is empty too.
* A block without an HTTP head is all payload. Folded header lines are joined. Chunked, gzip and deflate payloads are
  decoded; where that fails, and for media types other than HTML and plain text, there is a metadata record only.
* Without a charset in the header or in a meta tag, or with an unknown one, text is UTF-8; bad bytes become U+FFFD.
* A null id is not referred to; the derived ids then follow from target, date and block. Null targets and dates are left out.
* A source digest is kept as it is, also where it is wrong (``digest-check: mismatch``); a missing one is computed.
* Repeated rows give repeated records with the same ids. An empty table gives no rows. Columns in ``keep`` come first.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martmill.llm.html import RAW, blocks

END = "\r\n\r\n"
RECORD = "record_id string, warc_type string, target_uri string, warc_date string, headers array<struct<name: string, value: string>>, block binary"
DERIVED = (
    "record_id string, warc_type string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, content string"
)
MARKUP = frozenset(("text/html", "application/xhtml+xml"))
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space of URLs
HIDDEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW - {'title'}))})\b[^>]*>.*?(?:</\1\b|\Z)", re.S | re.I)
LINK = re.compile(r"""<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)
CHARSET = re.compile(r"""charset\s*=\s*["']?\s*([\w.:-]+)""", re.I)


def sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def holds(digest: str, data: bytes) -> str:
    """Whether a labelled digest, in hex or base 32, is the one of the data; 'unknown' for other algorithms."""
    label, _, value = digest.partition(":")
    label = label.strip().lower().replace("-", "")
    if label not in ("md5", "sha1", "sha256", "sha512"):
        return "unknown"
    found, value = hashlib.new(label, data).digest(), value.strip()
    return "match" if value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=") else "mismatch"


def header_lines(head: bytes) -> list[tuple[str, str]]:
    """Names and values in their order; a line that starts with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").splitlines():
        if line[:1] in " \t" and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}".strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    cut = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block[: cut.start()], block[cut.end() :]) if cut else (block, b"")
    status, _, rest = head.partition(b"\n")
    return status.decode("utf-8", "replace").strip(), header_lines(rest), payload


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.index(b"\n", at)
        n = int(data[at:end].split(b";")[0].strip(), 16)
        if n == 0:
            return b"".join(out)
        if end + 1 + n > len(data):
            raise ValueError("a chunk is cut short")
        out.append(data[end + 1 : end + 1 + n])
        at = data.index(b"\n", end + 1 + n) + 1


def decoded(payload: bytes, fields: dict[str, str]) -> bytes:
    """The payload without transfer and content encodings; ValueError where it cannot be had."""
    if "chunked" in fields.get("transfer-encoding", "").lower():
        payload = _unchunked(payload)
    for coding in reversed([c.strip().lower() for c in fields.get("content-encoding", "").split(",")]):
        try:
            if coding in ("gzip", "x-gzip", "deflate"):
                raw = coding == "deflate" and not (len(payload) > 1 and payload[0] & 15 == 8 and (payload[0] * 256 + payload[1]) % 31 == 0)
                reader = zlib.decompressobj(-15 if raw else 47)
                payload = reader.decompress(payload) + reader.flush()
            elif coding not in ("", "identity"):
                raise ValueError(f"unknown content encoding {coding}")
        except zlib.error as e:
            raise ValueError(str(e)) from e
    return payload


def as_text(payload: bytes, content_type: str) -> tuple[str, str]:
    """Text and charset."""
    named = CHARSET.search(content_type) or CHARSET.search(payload[:1024].decode("latin-1"))
    charset = named[1].lower() if named else "utf-8"
    try:
        text = payload.decode(charset, "replace")
    except (LookupError, UnicodeError):
        charset, text = "utf-8", payload.decode("utf-8", "replace")
    return text.removeprefix("\ufeff").encode("utf-8", "replace").decode(), charset


def _absolute(base: str | None, link: str) -> str:
    try:
        return urljoin(base or "", link)
    except ValueError:  # not a URL
        return link


def derived_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} of {source}')}>"


def derivatives(record_id: str | None, target: str | None, date: str | None, headers: Sequence[tuple[str, str]], block: bytes) -> list[tuple]:
    """The rows of ``DERIVED`` for one response: metadata, then the conversion if there is text."""
    status, http, payload = http_parts(block)
    own, fields = {n.lower(): v for n, v in headers}, {n.lower(): v for n, v in http}
    source = record_id or f"{target} {date} {sha256(block)}"
    payload_digest = own.get("warc-payload-digest") or sha256(payload)
    lines = [("source-" + n.lower(), v) for n, v in headers]
    if "warc-payload-digest" in own:
        lines.append(("digest-check", holds(own["warc-payload-digest"], payload)))
    else:
        lines.append(("source-warc-payload-digest", payload_digest))
    lines += [("http-status-line", status)] * bool(status) + [("http-header", f"{n}: {v}") for n, v in http]
    media = fields.get("content-type", "").split(";")[0].strip().lower() or ("text/html" if payload.lstrip()[:1] == b"<" else "text/plain")
    converted = None
    try:
        body = decoded(payload, fields)
        lines.append(("payload-length", str(len(body))))
        if media in MARKUP or media == "text/plain":
            text, charset = as_text(body, fields.get("content-type", ""))
            lines.append(("charset", charset))
            if media in MARKUP:
                seen = HIDDEN.sub(" ", text)
                lines += [("title", m[1]) for m in [TITLE.search(seen)] if m]
                lines += [("outlink", _absolute(target, (m[1] or m[2] or m[3] or "").strip())) for m in LINK.finditer(seen)]
                text = "\n".join(b.text for b in blocks(text))
            converted = text.encode("utf-8", "replace")
    except ValueError as e:
        lines.append(("decoding-error", str(e)))
    out = []
    if converted is not None:
        name, digest = derived_id(source, "conversion"), sha256(converted)
        lines += [("conversion", name), ("conversion-digest", digest)]
        out.append((name, "conversion", record_id, target, date, "text/plain", len(converted), digest, payload_digest, converted.decode()))
    content = "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in lines).encode("utf-8", "replace")
    out.insert(0, (derived_id(source, "metadata"), "metadata", record_id, target, date, "application/warc-fields", len(content), sha256(content), payload_digest, content.decode()))
    return out


def derive(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Metadata and conversion records (``DERIVED``) of all responses in a frame with the columns of ``RECORD``."""
    core = [f.name for f in T.StructType.fromDDL(RECORD).fields]
    kept = [F.col(f"`{c}`") for c in keep]
    schema = T.StructType(records.select(*kept).schema.fields + T.StructType.fromDDL(DERIVED).fields)
    names, k = schema.names, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 128):
                batch = whole.slice(a, 128)
                ids, _, targets, dates, headers, bodies = (batch.column(k + i).to_pylist() for i in range(6))
                rows, at = [], []
                for i in range(batch.num_rows):
                    made = derivatives(ids[i], targets[i], dates[i], [(h["name"] or "", h["value"] or "") for h in headers[i] or [] if h], bodies[i] or b"")
                    rows += made
                    at += [i] * len(made)
                types = [pa.int64() if n == "content_length" else pa.string() for n in names[k:]]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(at)) for i in range(k)] + columns, names)

    responses = records.where(F.lower("warc_type") == "response")
    return responses.select(*kept, *[F.col(c) for c in core]).mapInArrow(run, schema)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records (``RECORD``) after their key and url; pages have no fetch time, so ``date`` names one."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    digest = F.concat(F.lit("sha256:"), F.sha2(payload, 256))
    seed = F.sha2(F.to_json(F.struct(F.col(key).alias("k"), F.col(url).alias("u"), F.sha2(payload, 256).alias("d"))), 256)
    part = lambda a, n: F.substring("_seed", a, n)
    name = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(payload).cast("string"), F.lit(END))
    block = F.concat(head.cast("binary"), payload)
    field = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    # The date is a source header like the others; id, type and target are columns and are written from there.
    headers = F.array(
        field("Content-Type", F.lit("application/http; msgtype=response")), field("WARC-Payload-Digest", F.col("_payload")), field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("_block", 256)))
    )
    made = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), seed.alias("_seed"), digest.alias("_payload"), block.alias("_block"))
    return made.select("page_id", "url", name.alias("record_id"), F.lit("response").alias("warc_type"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("headers"), F.col("_block").alias("block"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))


def _serialised(kind: Column, name: Column, target: Column, date: Column, others: Column, block: Column) -> Column:
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", name), _line("WARC-Target-URI", target), _line("WARC-Date", date), others,
        F.lit("Content-Length: "), F.length(block).cast("string"), F.lit(END),
    )
    return F.concat(head.cast("binary"), block).cast("string").alias("value")


def write(records: DataFrame, path: str) -> None:
    """Records (``RECORD`` or ``DERIVED``) as gzipped WARC files, one per task; Spark's committer makes re-run tasks safe."""
    col = F.col
    if "content" in records.columns:
        block = F.coalesce(col("content"), F.lit("")).cast("binary")
        others = F.concat(_line("WARC-Refers-To", col("refers_to")), _line("Content-Type", col("content_type")), _line("WARC-Block-Digest", col("block_digest")))
    else:
        block = F.coalesce(col("block"), F.lit("").cast("binary"))
        lines = F.transform(F.coalesce("headers", F.array().cast("array<struct<name: string, value: string>>")), lambda h: F.concat(h["name"], F.lit(": "), F.regexp_replace(h["value"], r"[\r\n]+", " "), F.lit("\r\n")))
        others = F.array_join(lines, "")
    row = _serialised(col("warc_type"), col("record_id"), col("target_uri"), col("warc_date"), others, block)
    records.select(row).write.mode("errorifexists").option("lineSep", END).option("compression", "gzip").text(path)


COLUMNS = {"warc-record-id": 0, "warc-type": 1, "warc-target-uri": 2, "warc-date": 3}


def parsed(piece: bytes) -> tuple:
    """One row of ``RECORD`` from what stands between two record starts."""
    head, _, rest = piece.partition(b"\r\n\r\n")
    found, others, length = [None] * 4, [], None
    for name, value in header_lines(head.partition(b"\n")[2]):
        if name.lower() in COLUMNS:
            found[COLUMNS[name.lower()]] = value
        elif name.lower() == "content-length":
            length = int(value)
        else:
            others.append({"name": name, "value": value})
    if length is None or len(rest) < length:
        raise ValueError(f"record {found[0]} is cut short, has no length, or holds the start of another record")
    return (*found, others, rest[:length])


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records (``RECORD``) of plain or gzipped WARC files.

    A block that itself holds two line ends and a version line cannot be told from two records: such a file raises.
    """
    pieces = spark.read.option("lineSep", END + "WARC/").text(path).select(F.col("value").cast("binary").alias("piece"))
    kinds = T.StructType.fromDDL(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        types = [pa.string()] * 4 + [pair, pa.binary()]
        for whole in batches:
            for a in range(0, whole.num_rows, 128):
                rows = [parsed(p) for p in whole.slice(a, 128).column(0).to_pylist() if p.strip()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], kinds.names)

    return pieces.mapInArrow(run, kinds)
