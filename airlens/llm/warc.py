"""WARC derivatives (operator 5): from response records to linked metadata and plain-text conversion records.

A record is a row ``warc_type, record_id, refers_to, target_uri, warc_date, content_type, block_digest,
payload_digest, headers, block``: the named header fields, every other header of the source in ``headers``
(``name: value`` lines, in their order), and the block as text. A response keeps its HTTP head in ``block``; its
payload is what follows the first empty line.

:func:`derive` makes two records of each response. Their ids are name-based, so a second run gives the same ones;
both name the response in ``refers_to`` and keep its URI, date and other headers. The metadata record lists
what is known of the response as fields; the conversion record holds the payload's text.

Defined cases: a response without a block has an empty payload and an empty text; without an id it gets one from
its URI and date, missing parts being empty; repeated responses give repeated records; other columns are ignored; an empty table
gives an empty result.
"""

import gzip

from pyspark.sql import Column, DataFrame, functions as F

EOL = "\r\n"
FIELDS = {
    "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to",
    "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date", "Content-Type": "content_type",
    "WARC-Block-Digest": "block_digest", "WARC-Payload-Digest": "payload_digest",
}
SCHEMA = ("warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
          "content_type string, block_digest string, payload_digest string, headers string, block string")
#: what an HTML payload loses on its way to text; applied in this order
DROPPED = [
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<(script|style|head)\b.*?</(script|style|head)\s*>", " "),
    (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|blockquote|pre)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"),
            ("&middot;", "·"), ("&amp;", "&")]


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def name_id(*parts: Column) -> Column:
    """A record id that depends on ``parts`` alone, in the form of a UUID."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def plain_text(html: Column) -> Column:
    """Text of a page: no comments, scripts, styles, head or tags; a line per block, no empty lines."""
    for pattern, by in DROPPED:
        html = F.regexp_replace(html, pattern, by)
    for entity, char in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(char))
    html = F.regexp_replace(html, r"[ \t\r]+", " ")
    return F.regexp_replace(F.regexp_replace(html, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of a table ``url, html``: what a crawl at ``date`` would have stored."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(EOL + EOL))
    block = F.concat(head, html)
    return pages.select(
        F.lit("response").alias("warc_type"), name_id(F.lit("response"), F.col("url"), F.lit(date)).alias("record_id"),
        F.lit(None).cast("string").alias("refers_to"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"), digest(block).alias("block_digest"),
        digest(html).alias("payload_digest"), F.lit("WARC-IP-Address: 192.0.2.1").alias("headers"), block.alias("block"))


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all responses in ``records``; one pass, no shuffle."""
    r = records.where(F.col("warc_type") == "response")
    block = F.coalesce("block", F.lit(""))
    end = F.instr(block, EOL + EOL)
    r = r.select(
        F.coalesce("record_id", name_id(F.lit("response"), F.col("target_uri"), F.col("warc_date"))).alias("_id"),
        "target_uri", "warc_date", F.coalesce("headers", F.lit("")).alias("headers"),
        F.coalesce("payload_digest", F.lit("")).alias("_digest"),
        F.when(end > 0, F.substr(block, F.lit(1), end - 1)).otherwise(F.lit("")).alias("_head"),
        F.when(end > 0, F.substr(block, end + 4)).otherwise(block).alias("_payload"))
    r = r.withColumn("_text", plain_text(F.col("_payload")))
    status = F.regexp_extract("_head", r"^HTTP/\S+ (\d+)", 1)
    mime = F.lower(F.regexp_extract("_head", r"(?i)content-type:[ \t]*([^;\r\n]*)", 1))
    fields = F.concat(
        F.lit("http-status: "), status, F.lit(f"{EOL}http-content-type: "), mime,
        F.lit(f"{EOL}payload-length: "), F.octet_length("_payload").cast("string"),
        F.lit(f"{EOL}payload-digest: "), F.col("_digest"),
        F.lit(f"{EOL}text-length: "), F.octet_length("_text").cast("string"), F.lit(EOL))
    made = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("warc_type"), F.lit(mime_type).alias("content_type"), body.alias("block"))
        for kind, mime_type, body in (("metadata", "application/warc-fields", fields),
                                      ("conversion", "text/plain; charset=utf-8", F.col("_text")))]))
    r = r.select("_id", "target_uri", "warc_date", "headers", "_digest", made.alias("_r"))
    return r.select(
        "_r.warc_type", name_id(F.col("_r.warc_type"), F.col("_id")).alias("record_id"), F.col("_id").alias("refers_to"),
        "target_uri", "warc_date", "_r.content_type", digest(F.col("_r.block")).alias("block_digest"),
        F.col("_digest").alias("payload_digest"), "headers", "_r.block")


def as_text(records: DataFrame) -> DataFrame:
    """``record``: each row as a WARC 1.1 record, without the two line ends that close it."""
    named = [F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.concat(F.lit(f"{name}: "), F.col(c))) for name, c in FIELDS.items()]
    own = F.when(F.coalesce("headers", F.lit("")) != "", F.replace(F.col("headers"), F.lit("\n"), F.lit(EOL)))
    size = F.concat(F.lit("Content-Length: "), F.octet_length(F.coalesce("block", F.lit(""))).cast("string"))
    return records.select(F.concat(
        F.concat_ws(EOL, F.lit("WARC/1.1"), *named, own, size), F.lit(EOL + EOL),
        F.coalesce("block", F.lit(""))).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """One file of records per task."""
    as_text(records).write.mode("overwrite").option("lineSep", EOL + EOL).text(path)


def _parsed(content: bytes) -> list[tuple]:
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    found, at = [], 0
    while (start := content.find(b"WARC/1.", at)) >= 0:
        end = content.index(b"\r\n\r\n", start)
        lines = content[start:end].decode("utf-8", "replace").split(EOL)[1:]
        pairs = [line.partition(":")[::2] for line in lines]
        known = {FIELDS[k.strip()]: v.strip() for k, v in pairs if k.strip() in FIELDS}
        size = next((int(v) for k, v in pairs if k.strip().lower() == "content-length"), 0)
        rest = "\n".join(f"{k.strip()}: {v.strip()}" for k, v in pairs
                         if k.strip() not in FIELDS and k.strip().lower() != "content-length")
        block = content[end + 4:end + 4 + size].decode("utf-8", "replace")
        found.append(tuple(known.get(c) for c in FIELDS.values()) + (rest, block))
        at = end + 4 + size
    return found


def read_warc(spark, path: str) -> DataFrame:
    """Records of WARC files, plain or gzip; a file is read by one task, as the format has no index."""
    names = [part.split(" ")[0] for part in SCHEMA.split(", ")]

    def parse(batches):
        import pandas as pd
        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame(_parsed(bytes(content)), columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, SCHEMA)
