"""WARC archives: written by Spark's text writer, read back in splits with verified record boundaries."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from riskloom.llm.spans import rows
from riskloom.session import materialize, shared_dir

MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
_PAGE = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
# The digits of base 32 as Spark writes them, and as RFC 4648 does.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1 of a string's UTF-8 bytes: four digits from every five hex digits."""
    h = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fours), _DIGITS, _BASE32)


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """One WARC record per row of ``page_id, url, html`` below ``path``, one archive per task.

    Of rows with equal payloads of at least ``min_bytes`` bytes the smallest page id is a response
    and the others are revisits without payload; shorter payloads are always responses. The text
    writer's line end is the mark that closes a record, so that Spark's own commit makes the files
    whole or absent. Only ids and digests are shuffled; pages are, too, if there are so many
    revisits that the planner does not send their table to every task.

    A null html is empty. A null url gives no target line, control characters in one are
    percent-encoded. A null page id is a revisit of any equal page that has one.
    """
    payload = F.coalesce("html", F.lit(""))
    full = pages.select("page_id", "url", payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    narrow = materialize(full.select("page_id", "digest", "bytes").where(F.col("bytes") >= min_bytes), "page-digests")
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    again = narrow.select("page_id", "digest").join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
    again = materialize(again.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "first").distinct(), "page-revisits")
    told = full.join(again, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")

    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page = lambda c: F.concat(F.lit(f"<{_PAGE}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    clean = F.regexp_replace(F.regexp_replace("url", "\r", quote("\r")), "\n", quote("\n"))
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", page("page_id")),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", clean), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", page("first")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")), F.lit("\r\n"),
        http, F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    told.select(record.alias("value")).write.option("lineSep", END).text(path)


def _page_of(value: bytes | None) -> int | None:
    tail = (value or b"").strip(b"<> ").removeprefix(_PAGE.encode())
    return int(tail) if tail.lstrip(b"-").isdigit() else None


def _header(piece: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header lines and the place of the block after them, if the bytes after a magic can be a record."""
    stop = piece.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in piece[:stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, stop + 4) if fields.get(b"content-length", b"").isdigit() and b"warc-type" in fields else None


def _payload(block: bytes) -> tuple[int, str]:
    """Length and digest of what follows the HTTP header in a record's block."""
    body = block.partition(b"\r\n\r\n")[2]
    return len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()


_PIECE = (
    "file string, block bigint, seq bigint, rel bigint, size bigint, length bigint, whole boolean, page_id bigint, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies between two magics, with its place in the split; ``length`` is null if it cannot be a record."""
    place: tuple[str, int] | None = None
    seq = rel = 0
    names = [c.split()[0] for c in _PIECE.split(", ")]
    kinds = {"file": pa.string(), "payload_digest": pa.string(), "record_type": pa.string(), "whole": pa.bool_()}
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        for value, file, block in zip(batch.column("value").cast(pa.binary()), batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            piece = value.as_py()
            if (file, block) != place:
                place, seq, rel = (file, block), 0, 0
            row = dict.fromkeys(names) | {"file": file, "block": block, "seq": seq, "rel": rel, "size": len(piece)}
            if parsed := _header(piece):
                fields, at = parsed
                length = int(fields[b"content-length"])
                row |= {"length": at + length, "whole": len(piece) >= at + length, "page_id": _page_of(fields.get(b"warc-record-id"))}
                row |= {"record_type": fields[b"warc-type"].decode("utf-8", "replace"), "refers_to": _page_of(fields.get(b"warc-refers-to"))}
                if row["record_type"] == "revisit":
                    http = _header(b"warc-type:\r\n" + piece[at : at + length].partition(b"\r\n")[2])
                    row |= {"payload_bytes": int(http[0][b"content-length"]) if http else None}
                    row |= {"payload_digest": fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")}
                elif row["whole"]:
                    row["payload_bytes"], row["payload_digest"] = _payload(piece[at : at + length])
            for n in names:
                out[n].append(row[n])
            seq, rel = seq + 1, rel + len(piece) + len(MAGIC)
        yield rows({n: (v, kinds.get(n, pa.int64())) for n, v in out.items()})


def _split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """The rows of ``file, off, next`` that a chain from offset 0 of their file runs through.

    Pointer jumping: in each round the reached rows reach where their pointers lead, and every
    pointer doubles its length; the number of rounds is the logarithm of the longest file's
    number of candidates.
    """
    now = materialize(candidates.select("file", "off", "next", (F.col("off") == 0).alias("reached")), "warc-chain")
    longest = now.groupBy("file").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    for _ in range(int(longest).bit_length()):
        led = now.where("reached AND next IS NOT NULL").select("file", F.col("next").alias("off")).distinct().withColumn("led", F.lit(True))
        onward = now.select("file", F.col("off").alias("next"), F.col("next").alias("beyond"))
        step = now.join(led, ["file", "off"], "left").join(onward, ["file", "next"], "left")
        now = materialize(step.select("file", "off", F.col("beyond").alias("next"), (F.col("reached") | F.col("led").isNotNull()).alias("reached")), "warc-chain")
    return now.where("reached").select("file", "off")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Files are read in splits. Every magic in a split is a candidate record, whose header tells the
    offset of its successor; a magic inside a payload is a candidate like any other. Offsets in a
    file follow from the lengths of the splits before. Only candidates on the chain of successors
    that starts at offset 0 are records. A record whose payload holds magics is put together from
    its pieces after that, whatever splits they lie in.
    """
    found = materialize(_split(spark, path).mapInArrow(_pieces, _PIECE), "warc-pieces")
    lengths = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    origin = lengths.select("file", "block", (F.sum("bytes").over(W.partitionBy("file").orderBy("block")) - F.col("bytes")).alias("origin"))
    # A piece begins behind its magic; what lies before the first magic of a file is no record.
    placed = found.join(origin, ["file", "block"]).withColumn("off", F.col("origin") + F.col("rel") - len(MAGIC)).where("off >= 0")
    placed = materialize(placed.withColumn("next", F.col("off") + len(MAGIC) + F.col("length") + len(END)).drop("origin", "rel"), "warc-placed")
    kept = reachable(placed.where("length IS NOT NULL"))
    records = placed.join(kept, ["file", "off"])
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    broken = materialize(records.where("NOT whole AND record_type <> 'revisit'").select("file", "off", "length", "page_id", "record_type", "refers_to"), "warc-broken")
    if broken.isEmpty():
        return records.select(*result)

    chain = placed.join(broken.select("file").distinct(), "file", "left_semi").join(kept.withColumn("head", F.lit(True)), ["file", "off"], "left")
    owner = F.last(F.when(F.col("head"), F.col("off")), ignorenulls=True).over(W.partitionBy("file").orderBy("off"))
    needed = chain.select("file", "block", "seq", F.col("off").alias("at"), owner.alias("off")).join(broken.select("file", "off"), ["file", "off"], "left_semi")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq = None, 0
        for batch in batches:
            out = []
            for here in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
                place, seq = here, seq + 1 if here == place else 0
                out.append(seq)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(out, pa.int64()), batch.column("value").cast(pa.binary())], ["file", "block", "seq", "value"])

    raw = _split(spark, path).mapInArrow(numbered, "file string, block bigint, seq bigint, value binary")
    parts = raw.join(needed, ["file", "block", "seq"]).groupBy("file", "off").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for parts, length in zip(batch.column("parts").to_pylist(), batch.column("length").to_pylist()):
                whole = MAGIC.encode().join(p["value"] for p in parts)[:length]
                size, digest = _payload(whole[_header(whole)[1] :])
                sizes.append(size)
                digests.append(digest)
            yield rows({
                "page_id": (batch.column("page_id").to_pylist(), pa.int64()), "payload_bytes": (sizes, pa.int64()), "payload_digest": (digests, pa.string()),
                "record_type": (batch.column("record_type").to_pylist(), pa.string()), "refers_to": (batch.column("refers_to").to_pylist(), pa.int64()),
            })

    mended = broken.join(parts, ["file", "off"]).select("parts", "length", "page_id", "record_type", "refers_to")
    mended = mended.mapInArrow(join, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    return records.where("whole OR record_type = 'revisit'").select(*result).unionByName(mended)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as archives into the shared folder and reads them back. An empty table gives no records."""
    path = f"{shared_dir(pages.sparkSession)}/riskloom/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, min_bytes)
    return read_archive(pages.sparkSession, path)


WARC_SQL = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
    SELECT page_id, strlen(body)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
