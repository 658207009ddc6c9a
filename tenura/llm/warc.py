"""WARC derivatives: metadata and plain-text conversion records linked to their responses (operator 7).

For every response record the builder makes two records that refer to it: ``metadata`` (``application/warc-fields``:
the source's status, media type, character set, length, digests and outgoing links) and ``conversion`` (its text).
Both keep the source's target URI, date and digests, carry ``WARC-Refers-To`` and digests of their own block, and have
identifiers that follow from the source's, so a repeated run makes the same records.

Records are built one by one, nothing is shuffled.

Edge cases: a null or empty response block, or one without a header end, counts as a body without HTTP headers; a null
identifier is replaced by one made from the target URI and the block; null headers, URI or date leave their line out.
Repeated rows give repeated records. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.arrow import map_batches, text_column

RECORD = (
    "source_id string, warc_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, block string, block_digest string, payload_digest string, source_digest string, warc string"
)

_HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)\b.*?(?:</\1\s*>|\Z)")
_TITLE, _TITLE_END = re.compile(r"(?i)<title\b"), re.compile(r"(?i)</title\s*>")
# Elements that stand on lines of their own.
_BREAK = re.compile(
    r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre|dl|dt|dd|hr|main|aside)\b"
)
_TAG = re.compile(r"<[a-zA-Z/!?]")
_ANCHOR = re.compile(r"(?i)<a\b")
_HREF = re.compile(r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_SPACES = re.compile(r"[ \t\r\f\v]+")
_LINES = re.compile(r" ?\n[ \n]*")
_CHARSET = re.compile(r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def tags(page: str):
    """Start and end of each tag: from a ``<`` before a letter or one of ``/!?`` to the next ``>``, one look ahead for each.

    What is never closed is text.
    """
    match = _TAG.search(page)
    while match:
        end = page.find(">", match.end()) + 1
        if not end:
            return
        yield match.start(), end
        match = _TAG.search(page, end)


def _without_tags(page: str) -> str:
    """The page with a line end for each block element's tag and nothing for the others."""
    out, done = [], 0
    for start, end in tags(page):
        out.append(page[done:start])
        if _BREAK.match(page, start, end):
            out.append("\n")
        done = end
    return "".join([*out, page[done:]])


def _title(page: str) -> str:
    """What stands in the first title element."""
    found = _TITLE.search(page)
    begin = page.find(">", found.end()) + 1 if found else 0
    last = _TITLE_END.search(page, begin) if begin else None
    return page[begin : last.start()] if last else ""


def links(page: str) -> list[str]:
    """Targets of the anchors, entities resolved."""
    found = (_HREF.search(page, start, end) for start, end in tags(page) if _ANCHOR.match(page, start, end))
    return [html.unescape(m.group(1) or m.group(2) or m.group(3) or "").strip() for m in found if m]


def plain_text(page: str) -> str:
    """Visible text: title and body, a line for each block element, entities resolved."""
    body = _without_tags(_HIDDEN.sub(" ", page))
    body = _LINES.sub("\n", _SPACES.sub(" ", html.unescape(body))).strip()
    head = _SPACES.sub(" ", html.unescape(_title(page))).strip()
    return f"{head}\n{body}".strip()


def split_response(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, header fields and body of an HTTP response block."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, [], block
    lines = head.decode("latin-1").split("\r\n")
    status = lines[0].split(" ", 2)
    fields = [(n.strip(), v.strip()) for n, mark, v in (line.partition(":") for line in lines[1:]) if mark]
    return int(status[1]) if len(status) > 1 and status[1].isdigit() else None, fields, body


def decoded(body: bytes, content_type: str) -> tuple[str, str]:
    """Text and character set; the declared one, else the page's own, else UTF-8."""
    declared = _CHARSET.search(content_type) or _CHARSET.search(body[:2048].decode("latin-1"))
    for name in ([declared.group(1)] if declared else []) + ["utf-8"]:
        try:
            return body.decode(name, "replace"), name.lower()
        except LookupError:
            continue
    raise AssertionError("utf-8 is always known")


def _one_line(value) -> str:
    return " ".join(str(value).split())


def _identifier(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {source}')}>"


def _record(kind, source, uri, date, content_type, block, more, source_digest, payload) -> dict:
    data = block.encode("utf-8")
    own = {
        "WARC-Type": kind, "WARC-Record-ID": _identifier(kind, source), "WARC-Refers-To": source,
        "WARC-Target-URI": uri, "WARC-Date": date, "Content-Type": content_type, "WARC-Block-Digest": digest(data),
        **more, "Content-Length": str(len(data)),
    }
    lines = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in own.items() if value is not None)
    return {
        "source_id": source, "warc_type": kind, "record_id": own["WARC-Record-ID"], "refers_to": source,
        "target_uri": uri, "date": date, "content_type": content_type, "block": block,
        "block_digest": own["WARC-Block-Digest"], "payload_digest": payload, "source_digest": source_digest,
        "warc": f"WARC/1.1\r\n{lines}\r\n{block}",
    }


def derive(record_id, uri, date, headers, block: bytes | None) -> list[dict]:
    """The two records of one response."""
    block = block or b""
    headers = dict(headers or {})
    source = record_id or _identifier("response", f"{uri or ''} {digest(block)}")
    status, fields, body = split_response(block)
    first = {name.lower(): value for name, value in reversed(fields)}
    text, charset = decoded(body, first.get("content-type", ""))
    source_digest = headers.get("WARC-Block-Digest") or digest(block)
    payload = headers.get("WARC-Payload-Digest") or digest(body)
    told = [("source-status", status), ("source-charset", charset), ("source-length", len(body))]
    told += [("source-block-digest", source_digest), ("source-payload-digest", payload)]
    told += [(f"source-{name.lower()}", value) for name, value in fields]
    told += [("outlink", link) for link in links(text)]
    fields_block = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in told if value is not None)
    return [
        _record("metadata", source, uri, date, "application/warc-fields", fields_block, {}, source_digest, payload),
        _record(
            "conversion", source, uri, date, "text/plain; charset=UTF-8", plain_text(text),
            {"WARC-Source-Payload-Digest": payload}, source_digest, payload,
        ),
    ]


def build_derivatives(
    responses: DataFrame,
    record_id: str = "record_id",
    target_uri: str = "target_uri",
    date: str = "date",
    headers: str = "headers",
    block: str = "block",
) -> DataFrame:
    """A metadata and a conversion record for each response.

    ``headers`` is a map of the source's WARC fields; its digests are preserved, absent ones computed. ``warc`` is the
    whole record; written by :func:`write_records` it ends with the two line ends that the format wants.
    """
    source = responses.select(
        *[F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate((record_id, target_uri, date))],
        F.col(headers).cast("map<string,string>").alias("_3"),
        F.col(block).cast("binary").alias("_4"),
    )

    def run(batch):
        rows = zip(*(text_column(batch, f"_{i}") for i in range(5)))
        made = [record for row in rows for record in derive(*(v.as_py() for v in row))]
        names = [part.split()[0] for part in RECORD.split(", ")]
        return {name: pa.array([r[name] for r in made], type=pa.string()) for name in names}

    return map_batches(source, run, RECORD)


def responses_of(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of stored pages: identifier from id and url, a plain HTTP header before the page's bytes."""
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    key = F.sha2(F.concat_ws(" ", F.col(id_col).cast("string"), F.col(url_col)), 256)
    # A name-based identifier in the usual grouping.
    grouped = F.regexp_replace(F.substring(key, 1, 32), "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-5$3-8$4-$5")
    return pages.select(
        F.col(id_col).alias("page_id"),
        F.concat(F.lit("<urn:uuid:"), grouped, F.lit(">")).alias("record_id"),
        F.col(url_col).alias("target_uri"),
        F.lit(date).alias("date"),
        F.create_map(F.lit("WARC-Type"), F.lit("response")).alias("headers"),
        F.concat(head.cast("binary"), body).alias("block"),
    )


def write_records(records: DataFrame, path: str) -> None:
    """Records as WARC files, one per partition."""
    records.select("warc").write.option("lineSep", "\r\n\r\n").text(path)
