"""WARC archives: writing with segmented records, reading, and reassembly of segments.

Archives are written with Spark's text writer, so a lost task leaves no half file: a row is one record
without its last two line ends, which are the writer's line separator. They are read as binary files.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import new_path, pick, stage, table

SEGMENT_CHARS = 16384
CHUNK_CHARS = 4096
EOL = "\r\n"
HEAD = f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"
#: Fixed values of RFC 4648 base32 and of Java's digits for radix 32.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = "record_type string, record_id string, origin_id string, segment_number int, total_length long, page_id string, refers_to string, payload_digest string, target_uri string, block binary"
#: Bytes of blocks that a Python task holds before it hands them on.
BATCH_BYTES = 8 << 20
#: Records of an archive at most: as a segment has at most segment_chars characters, this bounds what one task reads at once.
FILE_RECORDS = 8192


def base32_sha1(c: Column) -> Column:
    """Upper-case base32 of the SHA-1, 40 bits at a time."""
    digest = F.sha1(c)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), DIGITS, BASE32)


def _header(name: str, value: Column) -> Column:
    """The line, or nothing for null; line ends in a value are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(EOL)), F.lit(""))


def write_warc(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit_bytes: int = 0, segment_chars: int = SEGMENT_CHARS, chunk_chars: int = CHUNK_CHARS, file_records: int = FILE_RECORDS) -> None:
    """One record per row as gzip-compressed WARC files of at most file_records records below path.

    Of rows with equal payloads of at least min_revisit_bytes, those with the largest id are responses and
    the others revisits without payload; smaller payloads are all responses. Bodies are framed in chunks;
    blocks of over segment_chars characters go on in continuation records. A null body is an empty payload, a null id or
    URL leaves its header out, repeated rows are written each, other columns are ignored, an empty table gives no records.
    """
    rows = pick(df, id_col, url_col, body_col).toDF("page_id", "url", "body").withColumn("body", F.coalesce(F.col("body").cast("string"), F.lit("")))
    rows = rows.withColumns({"sha": F.sha2("body", 256), "size": F.octet_length("body")})
    best = stage(rows.where(F.col("size") >= min_revisit_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("first_id")), "payloads")
    rows = rows.join(best, ["sha", "size"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    chunks = F.transform(F.regexp_extract_all("body", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0)), lambda c: F.concat(F.hex(F.octet_length(c).cast("long")), F.lit(EOL), c, F.lit(EOL)))
    framed = F.concat(F.lit(f"{HEAD}Transfer-Encoding: chunked{EOL}{EOL}"), F.array_join(chunks, ""), F.lit(f"0{EOL}{EOL}"))
    rows = rows.withColumns({"revisit": revisit, "uid": F.expr("uuid()"), "digest": base32_sha1(F.col("body").cast("binary"))})
    rows = rows.withColumn("block", F.when(F.col("revisit"), F.lit(f"{HEAD}{EOL}")).otherwise(framed)).drop("body")
    parts = F.regexp_extract_all("block", F.lit(f"(?s).{{1,{segment_chars}}}"), F.lit(0))
    rows = rows.withColumns({"total": F.octet_length("block"), "parts": parts}).drop("block")
    rows = rows.select("*", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "part")).drop("parts")
    origin = F.concat(F.lit("<urn:uuid:"), F.col("uid"), F.lit(">"))
    first = F.concat(
        F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit(EOL),
        _header("WARC-Record-ID", origin), _header("WARC-Target-URI", F.col("url")), _header("X-Page-ID", F.col("page_id")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), F.lit(f"Content-Type: application/http;msgtype=response{EOL}"),
        _header("WARC-Segment-Number", F.when(F.col("n") > 1, F.lit(1))),
        F.when(F.col("revisit"), F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{EOL}"), _header("X-Refers-To-Page-ID", F.col("first_id")))).otherwise(""),
    )
    later = F.concat(
        F.lit(f"WARC-Type: continuation{EOL}"), _header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("uid"), F.lit(":"), F.col("at") + 1, F.lit(">"))), _header("WARC-Segment-Origin-ID", origin),
        _header("WARC-Segment-Number", F.col("at") + 1), _header("WARC-Segment-Total-Length", F.when(F.col("at") + 1 == F.col("n"), F.col("total"))),
    )
    record = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Date: 2024-01-01T00:00:00Z{EOL}"), F.when(F.col("at") == 0, first).otherwise(later),
        _header("Content-Length", F.octet_length("part")), F.lit(EOL), F.col("part"),
    )
    rows.select(record.alias("value")).write.option("lineSep", EOL + EOL).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def parse_records(content: bytes) -> Iterator[dict]:
    """The records of one archive, plain or gzip-compressed, found by their Content-Length."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record should start here: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(size := int(fields["content-length"]))
        if len(block) < size:
            raise ValueError(f"the archive ends inside {fields.get('warc-record-id')}")
        number = lambda k: int(fields[k]) if k in fields else None  # noqa: E731, B023
        yield {
            "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "origin_id": fields.get("warc-segment-origin-id"), "segment_number": number("warc-segment-number"), "total_length": number("warc-segment-total-length"),
            "page_id": fields.get("x-page-id"), "refers_to": fields.get("x-refers-to-page-id"), "payload_digest": fields.get("warc-payload-digest"), "target_uri": fields.get("warc-target-uri"), "block": block,
        }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records below path, segments apart. Files are read whole, so archives must be of bounded size, as write_warc's are."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        columns = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                for record in parse_records(content):
                    held.append(record)
                    size += len(record["block"])
                    if size > BATCH_BYTES:
                        yield _frame(held, columns)
                        held, size = [], 0
        if held:
            yield _frame(held, columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, RECORD)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns if c in ("segment_number", "total_length")})


def decode_block(block: bytes) -> tuple[bytes | None, str]:
    """Payload of an HTTP response, its chunks joined, and ok or what is wrong."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "no end of headers"
    if b"transfer-encoding: chunked" not in head.lower():
        return body, "ok"
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None, "bad chunk"
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None, "bad chunk"
        at = end + 2
        if size == 0:
            return b"".join(out), "ok"
        if body[at + size : at + size + 2] != b"\r\n":
            return None, "bad chunk"
        out.append(body[at : at + size])
        at += size + 2


def reassemble(records: DataFrame) -> DataFrame:
    """record_type, record_id, page_id, refers_to, payload_digest, target_uri, payload, status per record.

    Continuations are grouped by the id of the record they continue and put in the order of their segment
    numbers; a number missing, repeated with other bytes, or a total length that doesn't match makes the
    status `incomplete` and the payload null. A continuation without its first record is dropped as such:
    its row has record_type null. Bad chunk framing is reported in the status. An empty archive gives no rows.
    """
    keep = ["record_type", "record_id", "page_id", "refers_to", "payload_digest", "target_uri"]
    whole = records.where("segment_number is null").select(*keep, F.col("block"), F.lit("ok").alias("status"))
    origin = F.coalesce("origin_id", "record_id")
    first = F.when(F.col("segment_number") == 1, F.struct(*keep))
    grouped = records.where("segment_number is not null").groupBy(origin.alias("origin")).agg(
        F.max(first).alias("first"), F.max("total_length").alias("total"), F.collect_list(F.struct("segment_number", "block")).alias("parts")
    )

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            blocks, status = [], []
            for parts, total in zip(batch["parts"], batch["total"], strict=True):
                found = {(p["segment_number"], bytes(p["block"])) for p in parts}
                block = b"".join(b for _, b in sorted(found))
                whole = sorted(n for n, _ in found) == list(range(1, len(found) + 1)) and total == len(block)
                blocks.append(block if whole else b"")
                status.append("ok" if whole else "incomplete")
            yield batch[keep].assign(block=blocks, status=status)

    schema = ", ".join(f"{c} string" for c in keep)
    joined = grouped.select("first.*", "total", "parts").mapInPandas(join, f"{schema}, block binary, status string")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            done = [decode_block(bytes(b)) if s == "ok" else (None, s) for b, s in zip(batch["block"], batch["status"], strict=True)]
            yield batch[keep].assign(payload=[p for p, _ in done], status=[s for _, s in done])

    return whole.unionByName(joined).mapInPandas(decode, f"{schema}, payload binary, status string")


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", path: str | None = None, **how) -> DataFrame:
    """Write df as archives, read them back, and report one row per input row.

    page_id, payload_bytes, payload_digest, record_type, refers_to, status; a revisit's figures come from the
    response it refers to. Null bodies are empty payloads. Rows repeated with one id and payload are all
    responses where that id is the largest, and all revisits else. Null ids come back null and are referred to
    by none. Bodies are kept byte for byte, line ends and archive-like text included.
    """
    spark, path = df.sparkSession, path or new_path(df.sparkSession, "warc")
    id_type = pick(df, id_col).schema[0].dataType.simpleString()
    write_warc(df, path, id_col, url_col, body_col, **how)
    read = reassemble(read_warc(spark, path))
    read = read.select(F.col("page_id").cast(id_type).alias("page_id"), "record_type", F.col("refers_to").cast(id_type).alias("refers_to"), "payload_digest", "status", F.octet_length("payload").cast("long").alias("payload_bytes"), F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))).alias("found"))
    read = stage(read, "records")
    status = F.when((F.col("status") == "ok") & (F.col("found") != F.col("payload_digest")), "digest differs").otherwise(F.col("status"))
    responses = read.where("record_type = 'response'").withColumn("status", status)
    named = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("bytes"), F.col("status").alias("of")).distinct()
    revisits = read.where("record_type = 'revisit'").drop("payload_bytes", "status").join(stage(named, "responses"), ["refers_to", "payload_digest"], "left")
    revisits = revisits.select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", F.coalesce("of", F.lit("response missing")).alias("status"))
    out = responses.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").unionByName(revisits)
    return out.withColumn("payload_digest", F.substring("payload_digest", 6, 32))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))
