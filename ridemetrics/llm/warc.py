"""Converter from legacy ARC archives to WARC 1.1, and readers and writers of both.

Archives are read as a stream of lines through Spark's text source and written through its text
sink, both of which pass bytes on unchanged, so they may lie on any file system that Spark reaches
and no archive has to fit into memory. They are gzip streams, which Spark does not split: one task
sees a file from its first byte on, and follows the declared lengths.
"""

import hashlib
import re
import uuid
from itertools import accumulate, product
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemetrics.llm.common import set_up, slices, store

# Payloads from this size on are stored once; later copies become revisit records.
LEAST_REVISIT = 100
# Level of the gzip streams: the usual one takes almost three times as long and saves a twentieth.
COMPRESSION = "THREE"
# Field names of the URL-record header line by ARC version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ],
}
# Fixed value: profile of a revisit record by equal payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HTTP = re.compile(rb"HTTP/\d")
# White space and control characters, which would break a header line.
_BREAKS = re.compile(r"[\x00-\x20\x7f]")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line`` of gzip archives, lines without their newline, in file order within a task."""
    set_up(spark)
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))


def _write(records: DataFrame, path: str) -> None:
    """Records without their last newline, which the sink adds."""
    sink = records.select(F.col("record").cast("string")).write.option("compression", "gzip")
    sink.option("zlib.compress.level", COMPRESSION).text(path)


class Blocks:
    """Cuts lines into records: a header, as read by ``head``, and as many bytes as it declares.

    ``head(state, line)`` returns a header when ``line`` ends one, else None; a header has ``length``.
    ``after(state, content)`` is told of each record. A record that breaks its length, or a damaged
    header, is an error; with ``is_head`` it goes to ``rejects`` instead, as file, number, line and reason, and the next
    line for which ``is_head(state, line)`` holds begins the next record, the lines of the damaged one included.
    """

    def __init__(self, head, after=None, is_head=None):
        self.head, self.after, self.is_head = head, after, is_head
        self.file, self.rejects = None, []

    def feed(self, file: str, line: bytes):
        if file != self.file:
            yield from self.close()
            self.file, self.number, self.header, self.state, self.lost = file, 0, None, {}, False
        waiting = [line]
        while waiting:
            yield from self._line(waiting.pop(), waiting)

    def _line(self, line: bytes, waiting: list[bytes]):
        if self.header is None:
            if self.lost and not self.is_head(self.state, line):
                return
            self.lost, self.line = False, line
            try:
                self.header = self.head(self.state, line)
            except ValueError as error:
                self._reject(str(error), [], waiting)
                return
            if self.header is None:
                return
            self.parts, self.size = [], 0
            if self.header["length"]:
                return
        else:
            self.parts.append(line)
            self.size += len(line) + 1
            if self.size < self.header["length"]:
                return
        content = b"\n".join(self.parts) + b"\n"
        length = self.header["length"]
        if content[length:].strip(b"\r\n"):
            self._reject(f"record {self.number} of {self.file} is longer than it declares", self.parts, waiting)
            return
        content = content[:length]
        if self.after:
            self.after(self.state, self.header, content)
        yield self.file, self.number, self.header, content
        self.header, self.parts, self.number = None, [], self.number + 1

    def _reject(self, reason: str, lines: list[bytes], waiting: list[bytes]) -> None:
        if self.is_head is None:
            raise ValueError(reason)
        self.rejects.append((self.file, self.number, self.line, reason))
        self.header, self.lost, self.number = None, True, self.number + 1
        waiting.extend(reversed(lines))

    def close(self):
        """The end of a file, which may come too early."""
        while self.file is not None and self.header is not None:
            waiting: list[bytes] = []
            self._reject(f"record {self.number} of {self.file} is cut short", self.parts, waiting)
            while waiting:
                yield from self._line(waiting.pop(), waiting)


def _records(lines: DataFrame, head, row, schema: str, after=None, is_head=None, rejects=False) -> DataFrame:
    """Rows that ``row(file, number, header, content)`` gives for each record; with ``rejects`` those of what is none."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def read(batches):
        blocks, rows, held = Blocks(head, after, is_head), [], 0

        def records():
            for batch in slices(batches, "line"):
                for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                    yield from blocks.feed(file, line)
            yield from blocks.close()

        for record in records():
            if not rejects:
                rows.append(row(*record))
                held += len(record[3])
            elif blocks.rejects:
                rows.extend(blocks.rejects)
                blocks.rejects.clear()
            if held > 1 << 22 or len(rows) > 10_000:
                yield batch_of(rows)
                rows, held = [], 0
        if rejects:
            rows.extend(blocks.rejects)
        if rows:
            yield batch_of(rows)

    return lines.mapInArrow(read, schema)


# --- ARC ------------------------------------------------------------------------------------------


# What the fields of a header line look like; others may hold anything but blanks, a URL and a file name even these.
_LOOKS = {
    "IP-address": re.compile(r"[0-9A-Fa-f.:]+|-"),
    "Archive-date": re.compile(r"\d{4,14}|\?|-"),
    "Result-code": re.compile(r"\d{1,3}|-"),
    "Offset": re.compile(r"\d+|-"),
    "Archive-length": re.compile(r"\d{1,10}"),
}
# Where that leaves a choice, a type of two parts decides; not all archives have such types.
_LOOKS_BETTER = _LOOKS | {"Content-type": re.compile(r"[^/\s]+/\S+")}
_MAY_HOLD_BLANKS = ("URL", "Filename")
_NEEDED = {"URL", "Archive-date", "Archive-length"}


def arc_head(state: dict, line: bytes):
    """Header of an ARC record, by the field list that the version block of its file declares.

    The ``filedesc`` line comes ahead of that block, and of it only the length, its last field, is needed.
    """
    if not line.strip():
        return None
    fields = line.decode("utf-8", "surrogateescape").split(" ")
    if fields[0].startswith("filedesc:"):
        if len(fields) < 3 or not _LOOKS["Archive-length"].fullmatch(fields[-1].strip()):
            raise ValueError(f"damaged ARC header: {line[:200]!r}")
        header = dict.fromkeys(ARC_FIELDS[1], "-") | {"URL": fields[0], "Archive-date": fields[2]}
        header["Archive-length"] = fields[-1].strip()
        state.clear()
    else:
        header = _fields(fields, state.get("names", ARC_FIELDS[1]))
        if header is None:
            raise ValueError(f"damaged ARC header: {line[:200]!r}")
    return header | {"length": int(header["Archive-length"]), "version": state.get("version", 1)}


def _fields(fields: list[str], names: list[str]) -> dict | None:
    """Fields by name; blanks beyond those between fields belong to a URL or a file name."""
    more = len(fields) - len(names)
    wide = [names.index(n) for n in _MAY_HOLD_BLANKS if n in names]
    if more < 0:
        return None
    # All of them in the first of the two, or so many in the other one.
    choices = range(more + 1 if len(wide) > 1 else 1)
    for looks, second in product((_LOOKS_BETTER, _LOOKS), choices):
        sizes = [1] * len(names)
        if wide:
            sizes[wide[0]] += more - second
            sizes[wide[-1]] += second
        ends = list(accumulate(sizes))
        found = {n: " ".join(fields[e - k : e]).strip() for n, k, e in zip(names, sizes, ends)}
        if all(look.fullmatch(found[n]) for n, look in looks.items() if n in found) and (more == 0 or wide):
            return dict.fromkeys(ARC_FIELDS[1], "-") | found
    return None


def arc_version_block(state: dict, header: dict, content: bytes) -> None:
    """Reads version and field list from the block of a ``filedesc`` record; what it leaves out is as of version 1."""
    if not header["URL"].startswith("filedesc:"):
        return
    first, _, rest = content.partition(b"\n")
    number = first.split()[:1]
    version = int(number[0]) if number and number[0].isdigit() else 1
    names = rest.partition(b"\n")[0].decode("utf-8", "replace").split()
    state["version"] = version
    state["names"] = names if set(names) >= _NEEDED else ARC_FIELDS.get(version, ARC_FIELDS[1])
    header["version"] = version


def is_arc_head(state: dict, line: bytes) -> bool:
    """Whether a line found after damage is a header: all fields as they should be, and an address with a scheme."""
    try:
        header = arc_head(dict(state), line)
    except ValueError:
        return False
    return bool(header) and re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", header["URL"]) is not None


_ARC = "file string, number long, version int, url string, ip string, date string, mime string, content binary"


def _arc_row(file, number, header, content):
    return (
        file, number, header["version"], header["URL"], header["IP-address"], header["Archive-date"],
        header["Content-type"], content,
    )


def _arc_records(spark, path, row, schema, damaged):
    if damaged not in ("raise", "skip"):
        raise ValueError(f"damaged must be 'raise' or 'skip', not {damaged!r}")
    return _records(_lines(spark, path), arc_head, row, schema, arc_version_block, is_arc_head if damaged == "skip" else None)


def read_arc(spark: SparkSession, path: str, damaged: str = "raise") -> DataFrame:
    """One row per ARC record, version blocks included; archives without records give none.

    A record that breaks its length or has a damaged header is an error; with ``damaged="skip"`` it is left out, as are
    lines up to the next header, and ``arc_rejects`` lists it.
    """
    return _arc_records(spark, path, _arc_row, _ARC, damaged)


_REJECTS = "file string, number long, header binary, reason string"


def arc_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, header, reason`` of what cannot be read as an ARC record."""
    return _records(_lines(spark, path), arc_head, None, _REJECTS, arc_version_block, is_arc_head, rejects=True)


def _arc_header(version, url, ip, date, mime, length):
    fields = [url, ip, date, mime] + (["200", "-", "-", "0", "-"] if version == 2 else []) + [str(length)]
    return " ".join(fields).encode()


def write_arc(pages: DataFrame, path: str) -> None:
    """Writes ``page_id, url, html`` as ARC archives, of version 1 and 2 by turns of the task.

    Each record is an HTTP response; the page id travels in a header of it. A null URL is written
    as ``-``, null html as an empty payload. The tables hold no crawl time, so the archive date is
    made from the page id.
    """
    set_up(pages.sparkSession)

    def encode(batches):
        from pyspark import TaskContext

        version = 1 + TaskContext.get().partitionId() % 2
        first = True
        for batch in slices(batches, "html"):
            records = []
            if first:
                block = f"{version} 0 corpus\n{' '.join(ARC_FIELDS[version])}\n".encode()
                records.append(_arc_header(version, "filedesc://pages.arc", "0.0.0.0", "20000101000000", "text/plain", len(block)) + b"\n" + block)
                first = False
            for row in batch.to_pylist():
                page, html = row["page_id"], row["html"]
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(html)}"]
                lines += [] if page is None else [f"X-Page-Id: {page}"]
                content = "\r\n".join([*lines, "", ""]).encode() + html
                second = (page or 0) % 10**9
                date = f"{2000 + second // 31536000:04}01{1 + second // 86400 % 28:02}{second // 3600 % 24:02}{second // 60 % 60:02}{second % 60:02}"
                url = _BREAKS.sub(lambda m: quote(m[0]), row["url"] or "-")
                records.append(_arc_header(version, url, "0.0.0.0", date, "text/html", len(content)) + b"\n" + content)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    _write(rows.mapInArrow(encode, "record binary"), path)


# --- conversion -----------------------------------------------------------------------------------


def record_id(file: str, number: int) -> str:
    """The same for each reading of an archive."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{number}')}"


def warc_date(arc_date: str) -> str:
    """14 digits, or fewer in old archives, as ISO 8601; what cannot be read is the epoch."""
    digits = arc_date if arc_date.isdigit() and 4 <= len(arc_date) <= 14 else "19700101000000"
    digits += "19700101000000"[len(digits) :] if len(digits) >= 8 else "0101000000"[len(digits) - 4 :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its blank line, and payload; other content is payload as a whole."""
    if not _HTTP.match(content):
        return b"", content
    head, blank, payload = content.partition(b"\r\n\r\n")
    return (head + blank, payload) if blank else (content, b"")


def _http_field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def _record_type(url: str, content: bytes) -> str:
    if url.startswith("filedesc:"):
        return "warcinfo"
    return "response" if _HTTP.match(content) else "resource"


_SUMMARY = "id string, page_id long, url string, date string, n long, digest binary, type string"


def _summary_row(file, number, header, content):
    head, payload = split_http(content)
    page = _http_field(head, b"X-Page-Id")
    return (
        record_id(file, number), int(page) if page and page.lstrip("-").isdigit() else None, header["URL"],
        warc_date(header["Archive-date"]), len(payload), hashlib.sha256(payload).digest(),
        _record_type(header["URL"], content),
    )


def _revisits(spark: SparkSession, path: str, least: int, damaged: str) -> DataFrame:
    """Records whose payload an earlier one holds: ``id, of, of_url, of_date``, stored.

    The first of equal payloads is the one with the smallest page id, then record id.
    """
    summaries = _arc_records(spark, path, _summary_row, _SUMMARY, damaged)
    large = store(summaries.filter((F.col("type") == "response") & (F.col("n") >= least)), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "id", "url", "date")
    firsts = large.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = store(firsts.filter("copies > 1").select("digest", "first"), "firsts")
    copies = large.join(firsts, "digest").filter(F.col("id") != F.col("first.id"))
    return copies.select("id", F.col("first.id").alias("of"), F.col("first.url").alias("of_url"), F.col("first.date").alias("of_date"))


def warc_record(row: dict) -> bytes:
    """A WARC record without its last newline."""
    content = row["content"]
    head, payload = split_http(content)
    kind = _record_type(row["url"], content)
    digest = hashlib.sha256(payload).hexdigest()
    fields = [("WARC-Record-ID", f"<{record_id(row['file'], row['number'])}>"), ("WARC-Date", warc_date(row["date"]))]
    if kind == "warcinfo":
        fields += [("WARC-Filename", row["url"]), ("Content-Type", "application/warc-fields")]
        content = b"software: ARC converter\r\nconverted-from: ARC/%d\r\n" % row["version"]
    else:
        fields += [("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]), ("WARC-Payload-Digest", f"sha256:{digest}")]
        if row["of"] is not None:
            kind, content = "revisit", head
            fields += [
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", f"<{row['of']}>"),
                ("WARC-Refers-To-Target-URI", row["of_url"]),
                ("WARC-Refers-To-Date", row["of_date"]),
            ]
        fields.append(("Content-Type", row["mime"] if kind == "resource" else "application/http;msgtype=response"))
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(content).hexdigest()}"), ("Content-Length", str(len(content)))]
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + content + b"\r\n\r"


def arc_to_warc(
    spark: SparkSession, arc_path: str, warc_path: str, least_revisit: int = LEAST_REVISIT, damaged: str = "raise"
) -> None:
    """Converts the archives in a folder.

    Version blocks become ``warcinfo``, HTTP responses ``response`` or, for the later ones of equal
    payloads of ``least_revisit`` bytes and more, ``revisit`` with the HTTP header only; the rest is
    ``resource``. Ids come from file and position, dates from the archive date, digests from the
    bytes. The archives are parsed twice: for digests and for content. Records are joined to the
    revisits by id, so many equal payloads make no hot key. Records that repeat a page id or a URL are
    records of their own; ``damaged`` is as for ``read_arc``; no archives give none.
    """
    revisits = _revisits(spark, arc_path, least_revisit, damaged)
    with_id = _arc_records(
        spark, arc_path, lambda *r: (record_id(r[0], r[1]), *_arc_row(*r)), "id string, " + _ARC, damaged
    )

    def encode(batches):
        for batch in slices(batches, "content"):
            records = [warc_record(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    # The revisits are small rows; hashing them spares the sort of the contents.
    joined = with_id.join(revisits.hint("shuffle_hash"), "id", "left").drop("id")
    _write(joined.mapInArrow(encode, "record binary"), warc_path)


# --- WARC -----------------------------------------------------------------------------------------


def warc_head(state: dict, line: bytes):
    """Header of a WARC record, gathered line by line until the blank one."""
    line = line.rstrip(b"\r")
    if not line and not state:
        return None
    if line:
        if not state and not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
        state[name.lower()] = value.strip()
        return None
    header = dict(state)
    state.clear()
    return header | {"length": int(header["content-length"])}


_WARC = (
    "id string, type string, url string, date string, page_id long, payload_bytes long, payload_digest string, "
    "refers_id string, content binary"
)


def _warc_row(file, number, header, content):
    head, payload = split_http(content)
    if (found := header.get("warc-block-digest")) and found != f"sha256:{hashlib.sha256(content).hexdigest()}":
        raise ValueError(f"record {number} of {file} does not match its digest")
    size = len(payload)
    if header["warc-type"] == "revisit":
        size = int(_http_field(head, b"Content-Length") or 0)
    page = _http_field(head, b"X-Page-Id")
    digest = header.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return (
        header["warc-record-id"].strip("<>"), header["warc-type"], header.get("warc-target-uri"), header.get("warc-date"),
        int(page) if page and page.lstrip("-").isdigit() else None, size, digest,
        header["warc-refers-to"].strip("<>") if "warc-refers-to" in header else None, content,
    )


def read_warc(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """One row per WARC record. For a revisit, size and digest are those of the payload it refers to."""
    if content:
        return _records(_lines(spark, path), warc_head, _warc_row, _WARC)
    return _records(_lines(spark, path), warc_head, lambda *r: _warc_row(*r)[:-1], _WARC.rpartition(",")[0])


def page_records(spark: SparkSession, warc_path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of responses and revisits."""
    records = store(read_warc(spark, warc_path, content=False).filter("type in ('response', 'revisit')"), "records")
    targets = records.filter("type = 'response'").select(F.col("id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    return records.join(targets, "refers_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )
