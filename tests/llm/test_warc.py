import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ridemetrics.llm.warc import ARC_FIELDS, Blocks, arc_head, arc_rejects, arc_to_warc, page_records, read_arc, read_warc, warc_date, write_arc

SCHEMA = "page_id long, url string, html string"
BIG = "<p>é</p>" * 20


def _pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _round_trip(spark, pages, folder):
    write_arc(pages, f"{folder}/arc")
    arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc")
    return f"{folder}/arc", f"{folder}/warc"


def test_equal_payloads_become_revisits(spark, folder):
    rows = [(4, "http://a", BIG), (2, "http://b/ x", BIG), (9, "http://c", BIG), (5, None, "short"), (6, "http://d", "short")]
    rows += [(7, "http://e", None), (8, "http://f", "line\r\n\r\n\nline\n\n"), (None, "http://g", BIG), (3, "http://h", "x" * 99), (1, "u", "x" * 99)]
    pages = _pages(spark, rows).repartition(3).withColumns({"id": F.lit(1), "digest": F.lit("d")})
    arc, warc = _round_trip(spark, pages, folder)
    got = {r.page_id: r for r in page_records(spark, warc).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        payload = (html or "").encode()
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        copy = html == BIG and page != 2
        assert (r.record_type, r.refers_to) == (("revisit", 2) if copy else ("response", None))
    records = read_warc(spark, warc).collect()
    assert {r.type for r in records} == {"warcinfo", "response", "revisit"}
    assert len({r.id for r in records}) == len(records)
    full = {r.page_id: r.content.partition(b"\r\n\r\n")[2].decode() for r in records if r.type == "response"}
    assert full == {p: h or "" for p, _, h in rows if not (h == BIG and p != 2)}
    assert {r.version for r in read_arc(spark, arc).collect()} == {1, 2}
    assert {r.url for r in records if r.page_id == 2} == {"http://b/%20x"}


def _archive(path, version, records):
    names = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    block = f"{version} 0 Org\n{names[version]}\n".encode()
    middle = " 200 - - 0 f.arc" if version == 2 else ""
    data = f"filedesc://f.arc 0.0.0.0 19970923 text/plain{middle} {len(block)}\n".encode() + block + b"\n"
    for url, date, mime, content in records:
        data += f"{url} 1.2.3.4 {date} {mime}{middle} {len(content)}\n".encode() + content + b"\n"
    with gzip.open(path, "wb") as f:
        f.write(data)


@pytest.mark.parametrize("version", [1, 2])
def test_foreign_archives(spark, tmp_path, folder, version):
    """Other record kinds, blanks in a URL, short dates, content that looks like a header line."""
    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhttp://x 1.2.3.4 19970101000000 text/html 5\nbody\n\n\n"
    records = [("http://a b/c", "19970923120000", "text/html", http), ("dns:a", "199709", "text/dns", b"a 1.2.3.4"), ("http://e", "?", "text/html", b"")]
    (tmp_path / "in").mkdir()
    _archive(tmp_path / "in" / "f.arc.gz", version, records)
    arc_to_warc(spark, str(tmp_path / "in"), f"{folder}/out")
    got = {r.url: r for r in read_warc(spark, f"{folder}/out").collect()}
    assert got["http://a b/c"].content == http and got["http://a b/c"].date == "1997-09-23T12:00:00Z"
    assert (got["dns:a"].type, got["dns:a"].content, got["dns:a"].date) == ("resource", b"a 1.2.3.4", "1997-09-01T00:00:00Z")
    assert (got["http://e"].type, got["http://e"].payload_bytes) == ("resource", 0)
    assert got[None].type == "warcinfo"


def test_broken_lengths_are_errors():
    blocks = Blocks(arc_head)
    assert not list(blocks.feed("f", b"http://a 1.1.1.1 19970101000000 text/html 3"))
    with pytest.raises(ValueError, match="longer"):
        list(blocks.feed("f", b"abcdef"))
    blocks = Blocks(arc_head)
    list(blocks.feed("f", b"http://a 1.1.1.1 19970101000000 text/html 30"))
    with pytest.raises(ValueError, match="short"):
        list(blocks.feed("g", b"x"))
    with pytest.raises(ValueError, match="damaged"):
        arc_head({}, b"http://a 1.1.1.1 text/html")


def test_dates():
    assert warc_date("19970923120509") == "1997-09-23T12:05:09Z"
    assert warc_date("1997") == "1997-01-01T00:00:00Z"
    assert warc_date("19970923") == "1997-09-23T00:00:00Z"
    assert warc_date("x") == warc_date("") == "1970-01-01T00:00:00Z"


def test_long_page_repeats_and_empty_table(spark, folder):
    rows = [(1, "http://a", "y\n" * 300_000), (1, "http://a", BIG), (1, "http://a", BIG)]
    _, warc = _round_trip(spark, _pages(spark, rows), folder)
    got = sorted((r.payload_bytes, r.record_type, r.refers_to or 0) for r in page_records(spark, warc).collect())
    n = len(BIG.encode())
    assert got == [(n, "response", 0), (n, "revisit", 1), (600_000, "response", 0)]
    _, warc = _round_trip(spark, _pages(spark, []), f"{folder}/none")
    assert page_records(spark, warc).count() == 0


def _gz(folder, name, data):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / name, "wb") as f:
        f.write(data)


def _with_block(first, names, records):
    block = f"{first}\n{names}\n".encode()
    return f"filedesc://f.arc 0.0.0.0 19970923 text/plain {len(block)}\n".encode() + block + b"\n" + b"".join(records)


def test_the_version_block_names_the_fields(spark, tmp_path):
    """A field list in another order, with a field that no version has."""
    names = "Archive-date URL Content-type Crawler Filename IP-address Result-code Archive-length"
    lines = [b"19990101000000 http://a/b c.html text/html bot my file.arc 1.2.3.4 200 3\nabc\n", b"19990102000000 http://d text/css - f.arc 4.3.2.1 404 0\n\n"]
    _gz(tmp_path / "in", "f.arc.gz", _with_block("2 7 Org", names, lines))
    rows = sorted(read_arc(spark, str(tmp_path / "in")).collect(), key=lambda r: r.number)[1:]
    assert [(r.version, r.url, r.ip, r.date, r.mime, r.content) for r in rows] == [
        (2, "http://a/b c.html", "1.2.3.4", "19990101000000", "text/html", b"abc"),
        (2, "http://d", "4.3.2.1", "19990102000000", "text/css", b""),
    ]


@pytest.mark.parametrize("url, name", [("http://a b", "f.arc"), ("http://a", "my f.arc"), ("http://a b c", "my own f.arc")])
def test_blanks_in_a_url_and_a_file_name(url, name):
    state = {"names": ARC_FIELDS[2], "version": 2}
    header = arc_head(state, f"{url} 1.2.3.4 19990101000000 text/html 200 - - 0 {name} 7".encode())
    assert (header["URL"], header["Filename"], header["IP-address"], header["length"]) == (url, name, "1.2.3.4", 7)


def test_a_block_without_a_list_is_as_of_its_version(spark, tmp_path):
    line = b"http://a 1.2.3.4 19990101000000 text/html 200 - - 0 f.arc 3\nabc\n"
    _gz(tmp_path / "in", "f.arc.gz", _with_block("2 0 Org", "", [line]))
    assert [r.content for r in read_arc(spark, str(tmp_path / "in")).filter("number = 1").collect()] == [b"abc"]


def test_damaged_records_are_listed_and_left_out(spark, tmp_path, folder):
    def record(k, content, length=None):
        return f"http://p{k} 1.2.3.4 19990101000000 text/html {len(content) if length is None else length}\n".encode() + content + b"\n"

    short, long = record(1, b"abcdef\nxy", 4), record(3, b"abc", 60)
    parts = [record(0, b"zero"), short, record(2, b"two\n"), long, record(4, b"four"), b"http://p5 nonsense\n", record(6, b"six"), record(7, b"cut", 999)]
    _gz(tmp_path / "in", "f.arc.gz", _with_block("1 0 Org", " ".join(ARC_FIELDS[1]), parts))
    _gz(tmp_path / "in", "g.arc.gz", _with_block("1 0 Org", " ".join(ARC_FIELDS[1]), [record(8, b"eight")]))
    _gz(tmp_path / "in", "empty.arc.gz", b"")
    path = str(tmp_path / "in")
    with pytest.raises(Exception, match="longer than it declares"):
        read_arc(spark, path).collect()
    kept = {r.url: r.content for r in read_arc(spark, path, damaged="skip").filter("url not like 'filedesc%'").collect()}
    assert kept == {"http://p0": b"zero", "http://p2": b"two\n", "http://p4": b"four", "http://p6": b"six", "http://p8": b"eight"}
    rejects = arc_rejects(spark, path).orderBy("number").collect()
    assert [bytes(r.header).split()[0] for r in rejects] == [b"http://p1", b"http://p3", b"http://p5", b"http://p7"]
    assert ["longer" in rejects[0].reason, "longer" in rejects[1].reason, "damaged" in rejects[2].reason, "short" in rejects[3].reason] == [True] * 4
    arc_to_warc(spark, path, f"{folder}/out", damaged="skip")
    assert {r.url for r in read_warc(spark, f"{folder}/out").filter("type != 'warcinfo'").collect()} == set(kept)
    with pytest.raises(ValueError, match="damaged must be"):
        read_arc(spark, path, damaged="drop")
