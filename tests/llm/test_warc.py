"""WARC derivatives: every record against a plain reading of its response, and a round trip through files."""

import base64
import gzip
import hashlib
import zlib

from html.parser import HTMLParser

from martmill.llm import warc
from martmill.llm.queries import QUERIES
from martmill.llm.ship import shipped
from martmill.sources.tables import scan_source

PAGE = "<html><head><title>A &amp; B</title><script>'<a href=no>'</script></head><body><a class=x href='/one'>One</a><!-- <a href=hidden> --><p>Grüße<a href=\"http://[bad\">!</a></body></html>"


def sha(data):
    return "sha256:" + hashlib.sha256(data).hexdigest()


def http(payload, *headers):
    return b"\r\n".join([b"HTTP/1.1 200 OK", *headers]) + b"\r\n\r\n" + payload


def rows_of(spark, records):
    df = shipped(spark).createDataFrame([(i, 7, *r) for i, r in enumerate(records)], f"page_id int, size int, {warc.RECORD}")
    return warc.derive(df, keep=("page_id", "size")).collect()


def fields(row):
    return [tuple(line.split(": ", 1)) for line in row["content"].split("\r\n") if line]


def test_linked_pair(spark):
    payload = PAGE.encode("latin-1")
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = http(payload, b"Content-Type: text/html; charset=ISO-8859-1", b"X-Folded: a", b"  b", b"Set-Cookie: 1", b"Set-Cookie: 2")
    source = ("<urn:uuid:1>", "response", "http://h/x/y", "2020-01-01T00:00:00Z", [("WARC-Payload-Digest", digest), ("WARC-IP-Address", "1.2.3.4")], block)
    meta, text = rows_of(spark, [source])
    assert (meta["warc_type"], text["warc_type"]) == ("metadata", "conversion")
    for row in (meta, text):
        assert (row["page_id"], row["size"], row["refers_to"], row["target_uri"], row["warc_date"], row["source_payload_digest"]) == (0, 7, "<urn:uuid:1>", "http://h/x/y", "2020-01-01T00:00:00Z", digest)
        assert row["block_digest"] == sha(row["content"].encode()) and row["content_length"] == len(row["content"].encode())
    assert text["content"] == "One\nGrüße!"
    assert fields(meta) == [
        ("source-warc-payload-digest", digest), ("source-warc-ip-address", "1.2.3.4"), ("digest-check", "match"), ("http-status-line", "HTTP/1.1 200 OK"),
        ("http-header", "Content-Type: text/html; charset=ISO-8859-1"), ("http-header", "X-Folded: a b"), ("http-header", "Set-Cookie: 1"), ("http-header", "Set-Cookie: 2"),
        ("payload-length", str(len(payload))), ("charset", "iso-8859-1"), ("title", "A &amp; B"), ("outlink", "http://h/one"), ("outlink", "http://[bad"),
        ("conversion", text["record_id"]), ("conversion-digest", text["block_digest"]),
    ]
    assert meta["record_id"] != text["record_id"]


def test_odd_responses(spark):
    plain = b"Content-Type: text/plain"
    body = b"long " * 300_000
    packed = gzip.compress(body)
    chunked = b"".join(b"%x;x=1\r\n%s\r\n" % (len(packed[a : a + 999]), packed[a : a + 999]) for a in range(0, len(packed), 999)) + b"0\r\n\r\n"
    deflated = zlib.compress(b"zipped")
    records = [
        (None, "response", None, None, None, None), (None, None, None, None, None, None), ("<a>", "request", "u", "d", [], b"GET"), ("<b>", "RESPONSE", "u", "d", [], http(b"\x89PNG", b"Content-Type: image/png")),
        ("<c>", "response", "u", "d", [], http(chunked, plain, b"Transfer-Encoding: chunked", b"Content-Encoding: gzip")), ("<d>", "response", "u", "d", [], http(b"zz", plain, b"Content-Encoding: gzip")),
        ("<e>", "response", "u", "d", [("WARC-Payload-Digest", "sha256:00")], http(b"a\xffb", plain + b"; charset=nonsense")), ("<e>", "response", "u", "d", [("WARC-Payload-Digest", "sha256:00")], http(b"a\xffb", plain + b"; charset=nonsense")),
        ("<f>", "response", "u", "d", [], b"<p>no head</p>"), ("<g>", "response", "u", "d", [], http(deflated, plain, b"Content-Encoding: deflate")), ("<h>", "response", "u", "d", [], http(deflated[2:-4], plain, b"Content-Encoding: deflate")),
    ]
    found = {}
    for r in rows_of(spark, records):
        found.setdefault(r["page_id"], []).append(r)
    texts = {i: [r["content"] for r in rows if r["warc_type"] == "conversion"] for i, rows in found.items()}
    assert texts == {0: [""], 3: [], 4: [body.decode()], 5: [], 6: ["a�b"], 7: ["a�b"], 8: ["no head"], 9: ["zipped"], 10: ["zipped"]}
    assert found[0][0]["refers_to"] is None and found[0][0]["record_id"]
    assert [n for n, _ in fields(found[5][0])][-1] == "decoding-error"
    assert ("digest-check", "mismatch") in fields(found[6][0])
    assert [r["record_id"] for r in found[6]] == [r["record_id"] for r in found[7]]
    assert rows_of(spark, records[1:3]) == []


def test_round_trip(spark, tmp_path):
    records = [(f"<urn:uuid:{i}>", "response", f"http://h/{i}", "2020-01-01T00:00:00Z", [("Content-Type", "application/http")], http(b"\xff\x00<p>" + b"x\r\n\r\n" * i, b"A: b")) for i in range(40)] + [("<e>", "resource", None, None, [], b"")]
    df = shipped(spark).createDataFrame(records, warc.RECORD).repartition(3)
    warc.write(df, f"{tmp_path}/source")
    back = warc.read(spark, f"{tmp_path}/source")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    for f in (tmp_path / "source").glob("*.gz"):  # one stream of records, as any other reader sees it
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    derived = warc.derive(back)
    warc.write(derived, f"{tmp_path}/derived")
    again = {r["record_id"]: r for r in warc.read(spark, f"{tmp_path}/derived").collect()}
    wanted = derived.collect()
    assert len(wanted) == len(again) == 80
    for r in wanted:
        stored = again[r["record_id"]]
        assert bytes(stored["block"]).decode() == r["content"] and (stored["warc_type"], stored["target_uri"]) == (r["warc_type"], r["target_uri"])
        assert {h["name"]: h["value"] for h in stored["headers"]} == {"WARC-Refers-To": r["refers_to"], "Content-Type": r["content_type"], "WARC-Block-Digest": r["block_digest"]}


def test_read_members_and_short_records(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record % (i, 4, b"a\r\nb")) for i in range(5)))
    (tmp_path / "b.warc").write_bytes(b"".join(record % (i, 3, b"xyz") for i in range(5, 9)))
    found = warc.read(shipped(spark), str(tmp_path / "*.warc*")).collect()
    assert sorted((r["record_id"], bytes(r["block"])) for r in found) == [(f"<{i}>", b"a\r\nb" if i < 5 else b"xyz") for i in range(9)]
    (tmp_path / "c.warc").write_bytes(record % (1, 99, b"short"))
    try:
        warc.read(spark, str(tmp_path / "c.warc")).collect()
        raise AssertionError("a short record was read")
    except Exception as e:
        assert "cut short" in str(e)


class Words(HTMLParser):
    """All text outside raw elements and the head."""

    def __init__(self):
        super().__init__()
        self.out, self.raw, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        self.raw += tag in ("script", "style", "title")
        self.links += [v for n, v in attrs if tag == "a" and n == "href"]

    def handle_endtag(self, tag):
        self.raw -= tag in ("script", "style", "title") and self.raw > 0

    def handle_data(self, data):
        if not self.raw:
            self.out.append(data)


def test_query_against_plain_reading(spark):
    root = "/root/testdata/sf0.001"
    found = {}
    for r in QUERIES["op5_warc_derivatives"](spark, root).collect():
        found.setdefault(r["page_id"], {})[r["warc_type"]] = r
    pages = scan_source(spark, root, "pages").collect()
    assert len(found) == len(pages) and all(len(pair) == 2 for pair in found.values())
    for p in pages:
        pair = found[p["page_id"]]
        meta, text = pair["metadata"], pair["conversion"]
        data = (p["html"] or "").encode()
        assert meta["refers_to"] == text["refers_to"] and meta["target_uri"] == p["url"] and meta["source_payload_digest"] == sha(data)
        lines = fields(meta)
        assert ("conversion", text["record_id"]) in lines and ("conversion-digest", sha(text["content"].encode())) in lines and ("digest-check", "match") in lines
        plain = Words()
        plain.feed(p["html"] or "")
        plain.close()
        assert "".join(text["content"].split()) == "".join("".join(plain.out).split())
        assert sum(n == "outlink" for n, _ in lines) == len(plain.links)
