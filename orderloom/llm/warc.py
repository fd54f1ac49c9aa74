"""WARC archives: written by Spark, read back by verified chains of records.

Writing: one record per page. Of pages with equal payloads (at least
``min_bytes`` long) the one with the smallest id is a response record, the others are
revisit records that name it. Spark's text writer puts the records out.

Reading: the text source cuts a file at the record magic, in parallel and
anywhere in the file, so a magic inside a payload starts a false candidate.
Each task emits its candidates with the offset of the record that would follow,
and where the chain through each of them leaves the task's split. Pointer
jumping over these exits, from the start of the file, finds the one true entry
of every split; from it the split's reachable records follow. Records whose payload
holds a magic are put together again from their pieces.

Defined cases: a null payload is empty; a null id is written as ``null`` and sorts
last; rows with the smallest id of their payload are all responses; a null URL
has no target header, and control characters or blanks in one are escaped; a chain that breaks in a
damaged file ends there; an empty table writes and reads no records; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import BATCH_ROWS, NULL_ID, id_order, map_texts, stored

MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n\r\n"
MIN_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
BROADCAST_ROWS = 100_000  # of about 60 bytes each; beyond it a shuffle join
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def digest_name(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``df`` (a stored table) as a broadcast side if it is small, else unchanged."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


# -- writing -----------------------------------------------------------------

def _digested(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    rows = pages.select(id_order(F.col(id_col)).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def start():
        return lambda payloads: [pa.array([digest_name(hashlib.sha1(p).digest()) for p in payloads], pa.string()),
                                 pa.array([len(p) for p in payloads], pa.int64())]

    return map_texts(rows, "html", "digest string, n_bytes bigint", start).select("doc.*", "digest", "n_bytes")


def _record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.when(id_ == NULL_ID, "null").otherwise(id_.cast("string")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))


def record_text(date: str = DATE) -> Column:
    """The record of a row with id, url, html, digest, n_bytes, refers_to; without its closing break."""
    revisit = F.col("refers_to").isNotNull()
    head = F.concat(F.lit(HTTP_HEAD), F.col("n_bytes").cast("string"), F.lit(BREAK))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("html")))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    return F.concat(
        F.lit(MAGIC), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("id"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", target), _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _header("X-Payload-Length", F.col("n_bytes").cast("string")),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    digested = _digested(pages, id_col, url_col, html_col)
    # digests travel for this, pages do not
    shared = digested.select("id", "digest", "n_bytes").where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("digest", "first")
    shared = checked_broadcast(stored(shared, "shared-payloads"))
    refers = F.when((F.col("id") != F.col("first")) & (F.col("n_bytes") >= min_bytes), F.col("first"))
    (digested.join(shared, "digest", "left").withColumn("refers_to", refers)
     .select(record_text(date).alias("value")).write.option("lineSep", BREAK).text(path))


# -- reading -----------------------------------------------------------------

def _pieces(spark: SparkSession, path: str, magic: str) -> DataFrame:
    """(file, block, value): what stands between two magics, in file order inside each split."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.option("lineSep", magic).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))


def parse_head(piece: bytes) -> tuple[dict[str, str], int] | None:
    """The named fields of a record and where its block starts in the piece; None if there is no head."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def _payload_start(fields: dict[str, str], piece: bytes, block_at: int) -> int:
    """Where the payload starts in the piece: behind the HTTP head, if the block has one."""
    if fields.get("content-type", "").startswith("application/http"):
        end = piece.find(b"\r\n\r\n", block_at)
        return end + 4 if end >= 0 else len(piece)
    return block_at


CANDIDATE = ("file string, block bigint, seq bigint, rel bigint, length bigint, record_size bigint, exit_rel bigint, "
             "fields map<string,string>, whole boolean, payload_bytes bigint, payload_digest string")


def candidates(pieces: DataFrame, magic: str = MAGIC) -> DataFrame:
    """A row per piece. ``rel``: its magic's offset from the magic of the split's first piece.

    ``record_size``: bytes from its magic to the record that would follow (null: no record
    head). ``exit_rel``: where the chain from it first leaves the split.
    """
    step = len(magic)

    def read(batches):
        held, rows, rel = None, [], 0

        def close():
            exits = {}
            for row in reversed(rows):
                if row["record_size"] is not None:
                    after = row["rel"] + row["record_size"]
                    row["exit_rel"] = exits[row["rel"]] = exits.get(after, after)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows.clear()

        schema = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("block", "seq", "rel", "length", "record_size", "exit_rel")],
                            ("fields", pa.map_(pa.string(), pa.string())), ("whole", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for batch in batches:
            for file, block, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if held != (file, block):
                    yield from close()
                    held, rel = (file, block), 0
                row = {"file": file, "block": block, "seq": len(rows), "rel": rel, "length": len(piece) + step, "record_size": None,
                       "exit_rel": None, "fields": None, "whole": False, "payload_bytes": None, "payload_digest": None}
                if head := parse_head(piece):
                    fields, at = head
                    size = step + at + int(fields["content-length"]) + 4
                    row |= {"record_size": size, "fields": list(fields.items()), "whole": size == len(piece) + step}
                    if row["whole"]:
                        payload = memoryview(piece)[min(_payload_start(fields, piece, at), len(piece) - 4):len(piece) - 4]
                        row |= {"payload_bytes": len(payload), "payload_digest": digest_name(hashlib.sha1(payload).digest())}
                rows.append(row)
                rel += len(piece) + step
        yield from close()

    return pieces.mapInArrow(read, CANDIDATE)


def _placed(found: DataFrame, magic: str) -> DataFrame:
    """Adds ``at``: the offset of the piece's magic in its file."""
    per = found.groupBy("file", "block").agg(F.sum("length").alias("bytes"))
    base = per.select("file", "block", (F.sum("bytes").over(Window.partitionBy("file").orderBy("block")) - F.col("bytes") - len(magic)).alias("base"))
    return found.join(base, ["file", "block"]).withColumn("at", F.col("base") + F.col("rel"))


def _entries(placed: DataFrame) -> DataFrame:
    """(file, at): the reachable candidates at which a chain enters a split, by pointer jumping from offset 0."""
    heads = placed.where("record_size IS NOT NULL").select("file", "at", (F.col("base") + F.col("exit_rel")).alias("to"))
    exits = heads.select("file", F.col("to").alias("at")).distinct()
    starts = heads.where("at = 0").select("file", "at")
    jump = stored(heads.join(exits.union(starts).distinct(), ["file", "at"], "left_semi"), "warc-jumps")
    reached = stored(starts, "warc-reached")
    while not jump.isEmpty():
        landed = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stored(reached.union(landed).distinct(), "warc-reached")
        ahead = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = stored(jump.join(ahead, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "warc-jumps")
    return reached


def _walk(placed: DataFrame, entries: DataFrame) -> DataFrame:
    """The pieces with ``is_record``: whether the chain from the split's entry meets them."""
    entry = placed.select("file", "block", "at").join(entries, ["file", "at"], "left_semi").groupBy("file", "block").agg(F.min("at").alias("entry"))
    rows = placed.select("file", "block", "seq", "at", "record_size").join(entry, ["file", "block"], "left")

    def follow(batches):
        held, due = None, None
        for batch in batches:
            out = []
            for file, block, at, size, entry in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "at", "record_size", "entry"))):
                if held != (file, block):
                    held, due = (file, block), entry
                is_record = due is not None and at == due and size is not None
                due = at + size if is_record else due
                out.append(is_record)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "block", "seq")), pa.array(out)],
                                             names=["file", "block", "seq", "is_record"])

    return (rows.repartition("file", "block").sortWithinPartitions("file", "block", "seq")
            .mapInArrow(follow, "file string, block bigint, seq bigint, is_record boolean"))


RECORD = "file string, at bigint, fields map<string,string>, payload_bytes bigint, payload_digest string"


def _assembled(spark: SparkSession, path: str, owned: DataFrame, magic: str, with_payload: bool) -> DataFrame:
    """Records from all of their pieces. ``owned``: file, block, seq, owner (offset of the record), at."""
    def number(batches):
        held, seq = None, 0
        for batch in batches:
            out = []
            for file, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, seq = ((file, block), 0) if held != (file, block) else (held, seq + 1)
                out.append(seq)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=["file", "block", "value", "seq"])

    def join(batches):
        held, state = None, None

        def close():
            if state is None:
                return
            if state["left"] > 0:  # the file ends inside the record
                return
            arrays = [pa.array([held[0]]), pa.array([held[1]]), pa.array([list(state["fields"].items())], pa.map_(pa.string(), pa.string())),
                      pa.array([state["n"]]), pa.array([digest_name(state["sha1"].digest())])]
            names = ["file", "at", "fields", "payload_bytes", "payload_digest"]
            if with_payload:
                arrays, names = [*arrays, pa.array([b"".join(state["kept"])], pa.binary())], [*names, "payload"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for file, owner, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "owner", "value"))):
                if held != (file, owner):
                    yield from close()
                    held = (file, owner)
                    fields, at = parse_head(piece)
                    begin = _payload_start(fields, piece, at)
                    state = {"fields": fields, "left": int(fields["content-length"]) - (begin - at), "n": 0, "sha1": hashlib.sha1(), "kept": []}
                    part = piece[begin:]
                else:
                    part = magic.encode() + piece
                part = part[:max(0, state["left"])]
                state["left"] -= len(part)
                state["n"] += len(part)
                state["sha1"].update(part)
                if with_payload:
                    state["kept"].append(part)
        yield from close()

    pieces = _pieces(spark, path, magic).mapInArrow(number, "file string, block bigint, value binary, seq bigint")
    joined = pieces.join(checked_broadcast(owned), ["file", "block", "seq"])
    return (joined.select("file", "owner", "at", "value").repartition("file", "owner").sortWithinPartitions("file", "owner", "at")
            .mapInArrow(join, RECORD + (", payload binary" if with_payload else "")))


def read_warc(spark: SparkSession, path: str, *, magic: str = MAGIC, with_payload: bool = False) -> DataFrame:
    """The reachable records: file, at (offset), fields (lower-case names), payload_bytes, payload_digest, and payload if asked for."""
    placed = stored(_placed(stored(candidates(_pieces(spark, path, magic), magic), "warc-pieces"), magic), "warc-placed")
    walked = stored(_walk(placed, _entries(placed)), "warc-walked")
    # a row per piece on both sides; its files shrink so much that their size must not decide on a broadcast
    marked = placed.join(walked.hint("merge"), ["file", "block", "seq"])
    records = marked.where("is_record")
    # pieces of records that go on behind a magic in their payload (all records, if payloads are wanted)
    torn = F.lit(True) if with_payload else ~F.col("whole")
    owner = F.last(F.when(F.col("is_record"), F.struct(F.col("at").alias("owner"), torn.alias("torn"))), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("at"))
    files = records.where(torn).select("file").distinct()
    owned = stored(marked.join(files, "file", "left_semi").select("file", "block", "seq", "at", "is_record", "whole")
                   .withColumn("owned", owner).where("owned.torn").select("file", "block", "seq", "at", "owned.owner"), "warc-owned")
    if with_payload:
        return _assembled(spark, path, owned, magic, True)
    columns = ["file", "at", "fields", "payload_bytes", "payload_digest"]
    return records.where("whole").select(*columns).union(_assembled(spark, path, owned, magic, False).select(*columns))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; of the full payload also for revisits."""
    field = lambda name: F.element_at("fields", F.lit(name))
    revisit = field("warc-type") == "revisit"
    return records.select(
        page_of(field("warc-record-id")).alias("page_id"),
        F.when(revisit, field("x-payload-length").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(field("warc-payload-digest"), ":", -1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        field("warc-type").alias("record_type"), F.when(revisit, page_of(field("warc-refers-to"))).alias("refers_to"))
