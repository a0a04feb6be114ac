"""WARC archives: write with revisit records, read back, resolve the revisits.

Writing: payload headers (id, digest) are shuffled by payload digest; the record with the
smallest id of a digest is the response, the others become revisits that refer to it and
carry no payload. Archives are written by Spark's own text sink, one record a row, so they
land wherever Spark can write. A record ends in CR LF CR LF; the sink adds the last LF.

Reading: whole archive files by Spark's binary source, parsed by Content-Length, so that a
payload may hold anything, line ends and WARC headers included.

Defined cases: a null payload is empty. A null id cannot be referred to: such a record is a
response of its own. Rows that repeat an id are records of their own; of equal payloads
with equal ids all are responses. Payloads under ``min_bytes`` are all responses. Line ends
in a URL become spaces; a null URL leaves the header out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.frames import own

#: Records in one archive file, which a reader holds whole.
RECORDS_PER_FILE = 5000
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a payload in base 32: 160 bits are 32 letters, 20 bits at a time."""
    hexa = F.sha1(payload)
    letters = []
    for at in range(0, 40, 5):
        bits = F.conv(F.substring(hexa, at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def resolve(pages: DataFrame, id: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` and: payload_bytes, payload_digest, record_type, refers_to (own names go)."""
    added = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = F.coalesce(F.col(payload), F.lit(""))
    digest_once = own("digest")
    base = (
        pages.drop(*[c for c in added if c not in (id, payload)])
        .withColumn("payload_bytes", F.octet_length(whole).cast("long"))
        .withColumn(digest_once, F.sha1(whole))
    )
    key, first = own("key"), own("first")
    headers = base.where((F.col("payload_bytes") >= min_bytes) & F.col(id).isNotNull())
    firsts = (
        headers.groupBy(F.col(digest_once).alias(key))
        .agg(F.min(id).alias(first), F.max(id).alias(own("last")))
    )
    last = firsts.columns[-1]
    # only payloads that do repeat are joined
    firsts = firsts.where(F.col(first) != F.col(last)).drop(last)
    small = F.col("payload_bytes") < min_bytes
    found = base.join(firsts, base[digest_once] == firsts[key], "left")
    refers = F.when(small | (F.col(first) == F.col(id)) | F.col(id).isNull(), None).otherwise(F.col(first))
    return found.withColumn("refers_to", refers).select(
        *[F.col(f"`{c}`") for c in base.columns if c not in ("payload_bytes", digest_once)],
        "payload_bytes",
        base32_sha1(whole).alias("payload_digest"),
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
        "refers_to",
    )


def records(pages: DataFrame, id: str, url: str, payload: str, date: str = DATE, min_bytes: int = 0) -> DataFrame:
    """One column ``record``: each row's WARC record without its last line feed."""
    r = resolve(pages, id, payload, min_bytes)
    is_response = F.col("record_type") == "response"
    body = F.when(is_response, F.coalesce(F.col(payload), F.lit(""))).otherwise("")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_END * 2),
    )
    uri = F.regexp_replace(F.col(url), "[\\r\\n]+", " ")
    header = F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "),
        F.col("record_type"),
        F.lit(f"{_END}WARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(id).cast("string"), F.lit("")),
        F.lit(f">{_END}WARC-Date: {date}{_END}"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit(_END)), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(is_response, "").otherwise(
            F.concat(
                F.lit(f"{_END}WARC-Profile: {_PROFILE}{_END}WARC-Refers-To: <urn:page:"),
                F.col("refers_to").cast("string"),
                F.lit(f">{_END}WARC-Refers-To-Date: {date}"),
            )
        ),
        F.lit(f"{_END}Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit(_END * 2),
    )
    return r.select(F.concat(header, http, body, F.lit("\r\n\r")).alias("record"))


def write(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = DATE,
    min_bytes: int = 0,
    per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write the deduplicated archives of ``pages`` into a new folder, gzipped."""
    rows = records(pages, id, url, payload, date, min_bytes)
    rows.write.option("lineSep", "\n").option("compression", "gzip").option(
        "maxRecordsPerFile", per_file
    ).text(path)


def _parse(data: bytes):
    """Header fields, HTTP head and payload of each record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        size = int(fields["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) != size or data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        head, _, payload = block.partition(b"\r\n\r\n")
        yield fields, head, payload
        at = stop + 8 + size


_SCHEMA = (
    "record_id string, record_type string, url string, date string, payload_digest string, "
    "refers_to_id string, payload binary, stated_bytes long"
)


def _http_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    return None


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row a record. A response's digest is computed anew from its payload, and a
    digest that differs from the header raises. A revisit's payload is null."""

    def run(batches):
        for batch in batches:
            for blob in batch.column(0):
                data = blob.as_buffer()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else bytes(data)
                rows = {name.split()[0]: [] for name in _SCHEMA.split(", ")}
                for fields, head, payload in _parse(data):
                    response = fields["warc-type"] == "response"
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if response and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                        raise ValueError(f"payload of {fields['warc-record-id']} has another digest")
                    for name, value in (
                        ("record_id", fields["warc-record-id"]),
                        ("record_type", fields["warc-type"]),
                        ("url", fields.get("warc-target-uri")),
                        ("date", fields["warc-date"]),
                        ("payload_digest", digest),
                        ("refers_to_id", fields.get("warc-refers-to")),
                        ("payload", payload if response and with_payload else None),
                        ("stated_bytes", len(payload) if response else _http_length(head)),
                    ):
                        rows[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(v, {"payload": pa.binary(), "stated_bytes": pa.int64()}.get(k, pa.string()))
                        for k, v in rows.items()
                    ],
                    names=list(rows),
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _SCHEMA)


def original_bytes(found: DataFrame) -> DataFrame:
    """Join revisits to their responses: payload_bytes of every record, and a failure if a
    revisit's response is missing or has another digest. Few records are revisits, so only
    they and the responses that may be meant are shuffled, without payloads."""
    slim = found.drop("payload")
    # ids may repeat: one row for each id and digest. Grouped by another key than the join's,
    # so that the join has a shuffle of its own, in which a hot response's revisits can be split
    originals = (
        slim.where("record_type = 'response'")
        .groupBy(F.concat_ws(" ", "record_id", "payload_digest").alias("key"))
        .agg(
            F.first("record_id").alias("refers_to_id"),
            F.first("payload_digest").alias("payload_digest"),
            F.first("stated_bytes").alias("original_bytes"),
        )
        .drop("key")
    )
    revisits = slim.where("record_type = 'revisit'").join(originals, ["refers_to_id", "payload_digest"], "left")
    proven = F.when(F.col("original_bytes").isNotNull(), F.col("original_bytes")).otherwise(F.raise_error(F.concat(F.lit("no response for "), F.col("record_id"))).cast("long"))
    columns = ["record_id", "record_type", "url", "date", "payload_digest", "refers_to_id"]
    return (
        slim.where("record_type = 'response'")
        .select(*columns, F.col("stated_bytes").alias("payload_bytes"))
        .unionByName(revisits.select(*columns, proven.alias("payload_bytes")))
    )
