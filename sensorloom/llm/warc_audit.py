"""Merkle fixity audit of WARC replicas.

Every record's bytes are hashed where they are read; only digests and places move. Per
segment (one WARC file) a tree stands over ordered offset ranges: a leaf hashes the
records that begin in its range, an inner node its sixteen children in order. Two replicas
compare roots first and then, level by level, only the children of nodes that differ, down
to the records of damaged ranges.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import written

SEGMENT_BYTES = 1 << 24
RANGE_BYTES = 1 << 16
FANOUT = 16


def record(url: Column, html: Column, key: Column) -> Column:
    """The bytes of a WARC/1.1 resource record; a null url or text is empty."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", key.cast("string"), url))
    identity = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), identity,
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def records(pages: DataFrame) -> DataFrame:
    """page_id and record of every row of pages (page_id, url, html)."""
    return pages.select(F.col("page_id").cast("long"), record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"))


def manifest(found: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """page_id, segment, offset, length, digest of records (page_id, record) laid out in files.

    A record's file follows from its id; there are as many files as segment_bytes go into
    all bytes, and one more. In a file records lie by id, then digest; a null id comes
    first and repeated rows lie one after another.
    """
    slim = found.select("page_id", F.length("record").cast("long").alias("length"), F.unhex(F.sha2("record", 256)).alias("digest"))
    slim = written(slim, "warc-digests")
    total = slim.agg(F.sum("length")).first()[0] or 0
    files = total // segment_bytes + 1
    number = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    placed = slim.withColumn("segment", (number % files).cast("int"))
    order = Window.partitionBy("segment").orderBy("page_id", "digest")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.select("page_id", "segment", offset.alias("offset"), "length", "digest")


def _leaf(offset: str = "offset") -> Column:
    return F.expr(f"{offset} DIV {RANGE_BYTES}")


def tree(entries: DataFrame, depth: int, label: str) -> list[DataFrame]:
    """Levels (segment, node, hash) from the leaves up to the roots, each written.

    A leaf has as many records as begin in its range, an inner node FANOUT children at most.
    """
    content = F.concat(F.col("offset").cast("string"), F.lit(":"), F.col("length").cast("string"), F.lit(":"), F.hex("digest"))
    leaves = entries.groupBy("segment", _leaf().alias("node")).agg(
        F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(content))), 256).alias("hash")
    )
    levels = [written(leaves, f"{label}-level0")]
    for level in range(1, depth):
        child = F.concat(F.lpad(F.pmod("node", F.lit(FANOUT)).cast("string"), 2, "0"), F.lit(":"), F.col("hash"))
        up = levels[-1].groupBy("segment", F.expr(f"node DIV {FANOUT}").alias("node")).agg(
            F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(child))), 256).alias("hash")
        )
        levels.append(written(up, f"{label}-level{level}"))
    return levels


def _differing(left: DataFrame, right: DataFrame, within: DataFrame | None) -> DataFrame:
    """Nodes (segment, node) whose hashes differ or that one side lacks, below the nodes `within`."""
    sides = []
    for side, name in ((left, "l"), (right, "r")):
        side = side.select("segment", "node", F.col("hash").alias(name))
        if within is not None:
            above = within.select(F.col("segment").alias("of"), F.col("node").alias("above"))
            side = side.join(above, (F.col("segment") == F.col("of")) & (F.expr(f"node DIV {FANOUT}") == F.col("above")), "left_semi")
        sides.append(side)
    return sides[0].join(sides[1], ["segment", "node"], "full").where("NOT (l <=> r)").select("segment", "node")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """page_id, segment, offset, length, kind of every record in which two manifests differ.

    kind: `changed` (other bytes at the same place), `missing` (not in right) or `extra`
    (only in right). length is left's, or right's for extra records. Manifests must name
    places by the same layout. Equal manifests, empty ones too, give no rows.
    """
    left, right = (written(side, "warc-manifest") for side in (left, right))
    ends = left.select("offset").union(right.select("offset")).agg(F.max("offset")).first()[0]
    depth, width = 1, (ends or 0) // RANGE_BYTES + 1
    while width > 1:
        depth, width = depth + 1, -(-width // FANOUT)
    trees = [tree(side, depth, f"warc-{name}") for side, name in ((left, "left"), (right, "right"))]
    damaged = None
    for level in reversed(range(depth)):
        damaged = written(_differing(trees[0][level], trees[1][level], damaged), f"warc-damaged{level}")
    sides = []
    for side, name in ((left, "l"), (right, "r")):
        hit = side.withColumn("node", _leaf()).join(damaged, ["segment", "node"], "left_semi")
        turn = F.row_number().over(Window.partitionBy("segment", "offset").orderBy("digest", "page_id"))
        sides.append(hit.select("segment", "offset", turn.alias("turn"), *(F.col(c).alias(f"{name}_{c}") for c in ("page_id", "length", "digest"))))
    both = sides[0].join(sides[1], ["segment", "offset", "turn"], "full").where("NOT (l_digest <=> r_digest AND l_length <=> r_length)")
    kind = F.when(F.col("r_digest").isNull(), "missing").when(F.col("l_digest").isNull(), "extra").otherwise("changed")
    return both.select(
        F.coalesce("l_page_id", "r_page_id").alias("page_id"), "segment", "offset",
        F.coalesce("l_length", "r_length").alias("length"), kind.alias("kind"),
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, url, record of the records in WARC files, plain or compressed record by record.

    Files are read one per task at a time; keep them at the usual size of a gigabyte at most.
    Offsets are those of the uncompressed bytes.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame.path, frame.content, strict=True):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)
                rows, stream = [], io.BytesIO(data)
                while True:
                    start = stream.tell()
                    head = {}
                    version = stream.readline()
                    if not version.strip():
                        if not version:
                            break
                        continue
                    while (line := stream.readline()).strip():
                        field, _, value = line.decode("utf-8", "replace").partition(":")
                        head[field.strip().lower()] = value.strip()
                    stream.seek(int(head.get("content-length", 0)) + 4, io.SEEK_CUR)
                    rows.append((name, start, head.get("warc-target-uri", ""), data[start : stream.tell()]))
                yield pd.DataFrame(rows, columns=["file", "offset", "url", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, offset long, url string, record binary")
