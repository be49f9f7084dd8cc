"""Derivatives of web-archive responses: linked metadata and plain-text conversion records.

Each response yields a metadata record (JSON of all its header lines, digests, title and links) and a conversion
record (its text). Both refer to the response, repeat its target, date and headers, and carry digests
of source and own block. Record ids are derived from the source's, so a second run gives the same.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
BLANK = "[\\t\\n\\x0B\\f\\r ]"

# fixed values: elements whose content is no text, and elements that break a line
HIDDEN = ("script", "style", "head", "noscript", "template", "svg")
BREAKS = "address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
# the named references of HTML 4 and the apostrophe; a non-breaking blank counts as a blank
NAMED = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'", "nbsp": " "}


def unescape(c: Column) -> Column:
    """Named and numeric references decoded once; what is no reference stays as it is."""
    names = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))

    # in three steps: what a function of an array's elements refers to twice is computed twice
    def named(piece: Column) -> Column:
        return F.struct(piece.alias("piece"), F.substring_index(piece, ";", 1).alias("name"))

    def with_char(x: Column) -> Column:
        piece, name = x["piece"], x["name"]
        code = F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)).cast("int")).when(
            name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("int")
        )
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        char = F.when(
            F.contains(piece, F.lit(";")) & (F.length(name) <= 10),
            F.when(name.startswith("#"), F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))).otherwise(
                F.try_element_at(names, name)
            ),
        )
        return F.struct(piece.alias("piece"), name.alias("name"), char.alias("char"))

    def decoded(x: Column) -> Column:
        rest = F.concat(x["char"], F.substr(x["piece"], F.length(x["name"]) + 2))
        return F.when(x["char"].isNotNull(), rest).otherwise(F.concat(F.lit("&"), x["piece"]))

    parts = F.split(c, "&")
    first, rest = F.element_at(parts, 1), F.slice(parts, 2, F.size(parts))
    return F.when(F.contains(c, F.lit("&")), F.concat(first, F.array_join(F.transform(F.transform(F.transform(rest, named), with_char), decoded), ""))).otherwise(c)


def without_tags(html: Column) -> Column:
    """Hidden elements, comments and tags go, blocks end lines; references stay."""
    c = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    for tag in HIDDEN:
        c = F.regexp_replace(c, f"(?is)<{tag}(?:{BLANK}[^>]*)?>.*?</{tag}{BLANK}*>", "")
    c = F.regexp_replace(c, f"(?i)</?(?:{BREAKS})(?:{BLANK}[^>]*|/)?>", "\n")
    return F.regexp_replace(c, "<[A-Za-z/!?][^>]*>", "")


def visible_text(html: Column) -> Column:
    """Text of a page: hidden elements, comments and tags go, blocks end lines, blanks are squeezed."""
    return decoded_text(without_tags(html))


def decoded_text(bare: Column) -> Column:
    """Text of a page ``without_tags``: references are decoded, blanks squeezed.

    ``bare`` should be a column and no expression: decoding refers to it several times, and Spark would
    compute it as often.
    """
    c = unescape(bare)
    c = F.regexp_replace(c, "[\\t\\x0B\\f\\r ]+", " ")
    c = F.regexp_replace(c, " ?\\n[\\n ]*", "\n")
    return F.regexp_replace(c, "^[\\n ]+|[\\n ]+$", "")


def raw_title(html: Column) -> Column:
    return F.regexp_extract(html, f"(?is)<title(?:{BLANK}[^>]*)?>(.*?)</title", 1)


def title_of(found: Column) -> Column:
    """Of a ``raw_title``, which should be a column."""
    return F.trim(F.regexp_replace(unescape(found), f"{BLANK}+", " "))


def links_of(html: Column) -> Column:
    """Targets of anchors in order, as written: in double, single or no quotes."""
    found = F.regexp_extract_all(
        html, F.lit(f"(?i)<a{BLANK}(?:[^>]*{BLANK})?href{BLANK}*={BLANK}*(\"[^\"]*\"|'[^']*'|[^\"'>\\t\\n\\x0B\\f\\r ][^>\\t\\n\\x0B\\f\\r ]*)"), F.lit(1)
    )
    quoted = lambda x: F.substr(x, F.lit(1), F.lit(1)).isin('"', "'")
    return F.transform(found, lambda x: F.when(quoted(x), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x))


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:…>`` of a digest, marked as a name-based one."""
    h = F.sha2(F.concat_ws("\n", *parts), 256)
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3),
        F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of fetched pages: id, record_id, target_uri, date, http_headers, payload.

    Null addresses and bodies count as empty. ``date`` stands for pages that carry none.
    """
    url, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (url_col, body_col))
    length = F.octet_length(body).cast("string")
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length, F.lit(CRLF)
    )
    return pages.select(
        F.col(id_col),
        record_id(F.lit("response"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), url).alias("record_id"),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("http_headers"),
        body.alias("payload"),
    )


def derivatives(source: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Two rows per response: id, record_type, record_id, refers_to, target_uri, content_length, header, block.

    ``header`` and ``block`` are a whole WARC record (``record`` joins them). A page without text gets an
    empty conversion, repeated responses get the same records; other columns are not read.
    """
    source = source.select(
        F.col(id_col), "record_id", "target_uri", "date", "http_headers", "payload", digest(F.col("payload")).alias("payload_digest"),
        without_tags(F.col("payload")).alias("bare"),
        raw_title(F.col("payload")).alias("raw_title"),
    )
    payload, lines = F.col("payload"), F.split("http_headers", CRLF)
    content_type = F.regexp_extract("http_headers", "(?i)\r\nContent-Type: ([^\r\n]*)", 1)
    metadata = F.to_json(
        F.struct(
            F.col("target_uri").alias("target"),
            F.element_at(lines, 1).alias("status"),
            content_type.alias("type"),
            F.filter(F.slice(lines, 2, F.size(lines)), lambda x: x != "").alias("headers"),  # noqa: PLC1901
            F.octet_length(payload).cast("long").alias("length"),
            F.col("payload_digest"),
            digest(F.concat(F.col("http_headers"), F.lit(CRLF), payload)).alias("block_digest"),
            title_of(F.col("raw_title")).alias("title"),
            links_of(payload).alias("links"),
        )
    )
    of = lambda kind, block: F.struct(F.lit(kind).alias("record_type"), block.alias("block"))
    body = source.select(
        F.col(id_col),
        "record_id", "target_uri", "date", "payload_digest",
        content_type.alias("source_type"),
        F.explode(F.array(of("metadata", metadata), of("conversion", decoded_text(F.col("bare"))))).alias("made"),
    ).select(
        id_col,
        "made.record_type",
        record_id(F.col("made.record_type"), F.col("record_id")).alias("own_id"),
        "record_id", "target_uri", "date", "payload_digest", "source_type",
        "made.block",
    )
    is_text = F.col("record_type") == "conversion"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    size = F.octet_length("block")
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("own_id")),
        line("WARC-Refers-To", F.col("record_id")),
        line("WARC-Refers-To-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To-Date", F.col("date")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Source-Payload-Digest", F.col("payload_digest")),
        line("WARC-Source-Content-Type", F.col("source_type")),
        line("WARC-Block-Digest", digest(F.col("block"))),
        line("Content-Type", F.when(is_text, F.lit("text/plain; charset=utf-8")).otherwise(F.lit("application/json"))),
        line("Content-Length", size.cast("string")),
    )
    return body.select(
        id_col,
        "record_type",
        F.col("own_id").alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        size.cast("long").alias("content_length"),
        header.alias("header"),
        "block",
    )


def record(header: Column, block: Column) -> Column:
    """The record as it stands in a file."""
    return F.concat(header, F.lit(CRLF), block, F.lit(CRLF + CRLF))
