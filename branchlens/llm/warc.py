"""Operator 4: WARC archives of pages, written and read back.

Writing uses Spark's text writer: a record is one text that ends in CR LF CR, and the
writer's own line feed completes it. Reading cuts the files at every occurrence of the
version line, wherever Spark splits them, so some cuts may lie inside a payload. Method:
each task emits, for every cut that looks like a record, its offset and its successor's
offset (the end that its length field claims). Pointer jumping from offset 0 of each file
then keeps the records that the chain reaches; text inside a payload that looks like a
record is never reached. Inside one split the chains are contracted first: a record is given its
exit from the split and the nested interval of the records that lead to it, so jumping takes
log2(splits per file) rounds and not log2(records).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchlens.llm.common import read, small, staged
from branchlens.session import fresh_path

MAGIC = "WARC/1.1\r\n"
MIN_DUPLICATE = 100  # bytes; shorter payloads are always stored
PER_FILE = 100_000  # records per archive file
PIECE = 1 << 20  # bytes per block when a payload is put together from several splits
CUT = (
    "file string, block long, rel long, span long, total long, size long, exit long, root long, lo long, hi long, "
    "succ long, page_id long, kind string, refers_to long, digest string, body_at long, body long, found long, actual string"
)
_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)\r?$", re.M)


def _page(value: bytes) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", value)
    return int(m[1]) if m else None


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\x00-\x20\x7F]", "%20")


def archive_records(pages: DataFrame) -> DataFrame:
    """record: the text of one WARC record per page, without its last line feed.

    Of pages with equal payloads of at least 100 bytes, those with the smallest page_id are
    stored, the others are revisit records without payload; their HTTP header keeps its
    length. Pages without an id come after all others; if there are only such, all are stored.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n"),
        F.sha2(payload, 256).alias("digest"),
    )
    repeated = staged(
        rows.where(F.col("n") >= MIN_DUPLICATE)
        .groupBy("digest", "n")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 and first is not null")
        .select("digest", "n", "first"),
        "repeated-payloads",
    )
    marked = rows.join(small(repeated), ["digest", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    urn = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", urn),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(_header("WARC-Target-URI", _one_line(F.col("url")))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit, _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return marked.withColumn("block", block).select(
        F.concat(header, F.col("block"), F.lit("\r\n\r")).alias("record")
    )


def write_archives(pages: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    archive_records(pages).write.option("maxRecordsPerFile", per_file).text(path)


def _parse(start: int, raw: memoryview, segment: bytes) -> dict | None:
    """The record that may begin with this segment (the bytes after a version line)."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    field = {k.lower(): v for k, v in _FIELD.findall(segment[: end + 2])}
    length = field.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in field or b"warc-record-id" not in field:
        return None
    body_at = start + len(MAGIC) + end + 4
    block_end = body_at + int(length)
    out = {
        "rel": start,
        "succ": block_end + 4,
        "page_id": _page(field[b"warc-record-id"]),
        "kind": field[b"warc-type"].decode("latin-1"),
        "refers_to": _page(field.get(b"warc-refers-to", b"")),
        "digest": field.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha256:"),
        "body_at": body_at,
        "body": int(length),
        "found": None,
        "actual": None,
    }
    if block_end <= len(raw):
        out |= _payload(bytes(raw[body_at:block_end]))
    return out


def _payload(block: bytes) -> dict:
    """Length of the payload that the HTTP header claims, and the digest of the bytes at hand."""
    head = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or head < 0:
        return {"found": len(block), "actual": hashlib.sha256(block).hexdigest()}
    field = {k.lower(): v for k, v in _FIELD.findall(block[: head + 2])}
    claimed = field.get(b"content-length", b"")
    payload = block[head + 4 :]
    return {
        "found": int(claimed) if claimed.isdigit() else len(payload),
        "actual": hashlib.sha256(payload).hexdigest(),
    }


def _contract(records: list[dict], total: int) -> None:
    """Give each record its exit from the split and its interval in the tree of chains.

    Going backwards, a record takes the exit of its successor; depth-first numbers over the
    reversed chains then tell whether one record's chain passes another.
    """
    at = {r["rel"]: r for r in records}
    into: dict[int, list[dict]] = {}
    for r in reversed(records):
        after = at.get(r["succ"]) if r["succ"] < total else None
        r["exit"] = r["succ"] if r["succ"] >= total else after["exit"] if after else None
        r["root"] = after["root"] if after else r["rel"]
        if after:
            into.setdefault(after["rel"], []).append(r)
    number = 0
    for top in (r for r in records if r["root"] == r["rel"]):
        stack = [(top, False)]
        while stack:
            r, done = stack.pop()
            if done:
                r["hi"] = number
                continue
            r["lo"] = number = number + 1
            stack.append((r, True))
            stack.extend((x, False) for x in into.get(r["rel"], ()))


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate records of each file split; a split's bytes are kept until it ends."""
    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in CUT.split(", "))])

    def done(of: tuple, segments: list[bytes]) -> pa.RecordBatch:
        # Only the first cut of a file has no version line before it.
        whole = b"".join(s if not i and not of[1] else MAGIC.encode() + s for i, s in enumerate(segments))
        raw, records, at = memoryview(whole), [], 0
        for i, s in enumerate(segments):
            own = not i and not of[1]
            if not own and (r := _parse(at, raw, s)):
                records.append(r)
            at += len(s) + (0 if own else len(MAGIC))
        _contract(records, at)
        common = {"file": of[0], "block": of[1], "span": len(segments), "total": at, "size": of[2]}
        # One row more per split, for its length.
        rows = [{**common, "rel": -1}, *({**common, **r} for r in records)]
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    of, segments = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "size")), strict=True)
        for key, value in zip(keys, batch.column("value").to_pylist(), strict=True):
            if key != of and segments:
                yield done(of, segments)
                segments = []
            of = key
            segments.append(value)
    if segments:
        yield done(of, segments)


def read_cuts(spark: SparkSession, path: str) -> DataFrame:
    """value: the bytes between version lines, in file order within each file split."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
    )


def _reached(records: DataFrame, entries: DataFrame) -> DataFrame:
    """file, at: the offsets at which chains enter a split, by pointer jumping.

    ``records`` has file, at, exit; ``entries`` the starts of the files. After round k the
    reached set holds all entries up to 2^k splits down the chain.
    """
    hop = staged(
        records.where("exit is not null").select("file", "at", F.col("exit").alias("to")), "hops"
    )
    reached, n = entries.select("file", "at"), None
    while True:
        step = reached.join(hop, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = staged(reached.union(step).distinct(), "reached")
        if (now := reached.count()) == n:
            return reached
        n = now
        twice = hop.select("file", "at", F.col("to").alias("mid")).join(
            hop.select("file", F.col("at").alias("mid"), "to"), ["file", "mid"]
        )
        hop = staged(twice.select("file", "at", "to"), "hops")


def _joined_payloads(spark: SparkSession, path: str, bases: DataFrame, records: DataFrame) -> DataFrame:
    """file, at, found, actual of records whose payload runs on into other splits.

    The pieces are fetched in a second reading, by blocks of the byte range that each needs.
    """
    block = lambda c: F.floor(F.col(c) / PIECE)
    need = records.select(
        "file", "at", "from", (F.col("from") + F.col("body")).alias("to")
    ).withColumn("b", F.explode(F.sequence(block("from"), block("to"))))

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, at = None, 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                key = (r["file"], r["block"])
                at = at if key == of else 0
                data = r["value"] if key != of and not r["block"] else MAGIC.encode() + r["value"]
                of = key
                for cut in range(0, len(data), PIECE):
                    part = data[cut : cut + PIECE]
                    rows.append({"file": r["file"], "block": r["block"], "rel": at + cut, "data": part})
                at += len(data)
            yield pa.RecordBatch.from_pylist(rows, schema=piece)

    piece = pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("data", pa.binary())])
    pieces = (
        read_cuts(spark, path)
        .mapInArrow(located, "file string, block long, rel long, data binary")
        .join(small(bases), ["file", "block"])
        .select("file", (F.col("base") + F.col("rel")).alias("p"), "data")
        .withColumn("q", F.col("p") + F.length("data"))
        .withColumn("b", F.explode(F.sequence(block("p"), block("q"))))
    )
    parts = (
        pieces.join(need, ["file", "b"])
        .where("p < to and q > from")
        .dropDuplicates(["file", "at", "p"])
        .select("file", "at", "from", "to", "p", "data")
    )

    def assembled(table: pa.Table) -> pa.Table:  # one record's payload
        rows = sorted(table.to_pylist(), key=lambda r: r["p"])
        first = rows[0]
        whole = b"".join(r["data"] for r in rows)[first["from"] - first["p"] :][: first["to"] - first["from"]]
        return pa.Table.from_pylist(
            [{"file": first["file"], "at": first["at"], **_payload(whole)}],
            schema=pa.schema([("file", pa.string()), ("at", pa.int64()), ("found", pa.int64()), ("actual", pa.string())]),
        )

    return parts.groupBy("file", "at").applyInArrow(assembled, "file string, at long, found long, actual string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, at, page_id, record_type, refers_to, payload_bytes, payload_digest, intact per record.

    The payload of a response is measured and hashed as read back; a revisit has what its
    headers tell. ``intact`` is false if a response's digest differs from its header. Bytes
    after the end of a broken chain are not read as records. The archives are uncompressed.
    """
    cuts = staged(read_cuts(spark, path).mapInArrow(_cuts, CUT), "record-offsets")
    splits = cuts.where("rel = -1").select("file", "block", "total")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(  # as many rows per file as it has splits
        splits.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"), "total"),
        "split-offsets",
    )
    found = cuts.where("rel >= 0").drop("total").join(small(bases), ["file", "block"]).withColumn("at", F.expr("base + rel"))
    hops = found.select("file", "at", F.expr("base + exit").alias("exit"))
    starts = bases.select("file", F.lit(0).cast("long").alias("at")).distinct()
    entered = _reached(hops, starts)
    doors = found.join(small(entered), ["file", "at"]).select(
        "file", "block", F.col("root").alias("door_root"), F.col("lo").alias("door_lo")
    )
    # A split's door leads through exactly those records whose interval holds it.
    valid = (
        found.join(small(doors), ["file", "block"])
        .where("root = door_root and door_lo between lo and hi")
        .withColumn("from", F.expr("base + body_at"))
    )
    valid = staged(valid.drop("door_root", "door_lo"), "records")
    cut_off = valid.where("found is null")
    if cut_off.isEmpty():
        rest = cut_off.select("file", "at", "found", "actual")
    else:
        rest = _joined_payloads(spark, path, bases, cut_off)
    whole = valid.where("found is not null").unionByName(
        cut_off.drop("found", "actual").join(rest, ["file", "at"])
    )
    revisit = F.col("kind") == "revisit"
    return whole.select(
        "file",
        "at",
        "page_id",
        F.col("kind").alias("record_type"),
        "refers_to",
        F.col("found").alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.col("actual")).alias("payload_digest"),
        (revisit | (F.col("digest") == F.col("actual"))).alias("intact"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back.

    A null html is an empty payload, a null url leaves its header out, a null page_id comes
    back as null. Each row gives one record, repeated rows too: rows that share the smallest
    id are all stored. Other columns are not looked at; an empty table gives no record.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY d, n) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
