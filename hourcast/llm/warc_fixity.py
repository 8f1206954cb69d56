"""Merkle fixity audit of WARC replicas.

Records (``WARC/1.0`` response headers, payload, closing line ends) are numbered in
order of id and cut into archive files of ``FILE_RECORDS`` records; the first
replica's lengths give every record its byte range in its file. Each replica gets a
tree: a leaf is the SHA-256 of a record, a node the SHA-256 of its children in order
of offset. Nodes cover aligned byte ranges (``RANGE_BYTES``, then ``FANOUT`` times as
much a level), so a group holds a bounded number of children; records that only the
second replica has lie in ranges of their own, by number. There are as many levels as
the longest file needs; a file's root covers the whole file. The audit compares the
roots, then only the children of nodes that differ, level by level, down to the records
that are ``changed``, ``missing`` in the second replica, ``extra`` there, or ``repeated``:
held more often by one replica than by the other, in equal copies. A replica may hold a
number any number of times; its leaf then stands for the copies' count and contents, whatever their order.

Null urls give a record without target, null payloads an empty one, a null record an empty one. Rows with equal
id are numbered by their payload's hash; equal rows are records of their own. Very long
payloads are hashed by Spark, row by row. Only the named columns are read, so extra ones may have any
name. Empty tables give no finding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hourcast.llm.common import pick, ranked
from hourcast.sinks.util import materialize

FILE_RECORDS = 4096
RANGE_BYTES = 1 << 16
FANOUT = 16
#: Numbers in a range of records that the first replica doesn't have.
RANGE_RECORDS = 512


def records(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            file_records: int = FILE_RECORDS) -> DataFrame:
    """(file, number, id, url, record) of every row, as bytes; written once and read back."""
    d = pick(df, id=id_col, url=url_col, payload=payload_col)
    d = d.withColumn("payload", F.coalesce("payload", F.lit(""))).withColumn("order", F.xxhash64("url", "payload"))
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = ranked(d, ["id", "order"], "archive", n)
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\n"),
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("WARC-Target-URI: "), "url", F.lit("\r\n"))),
        F.lit("Content-Type: text/html\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    return d.select(F.floor(F.col("_rank") / file_records).alias("file"), "_rank", "id", "url",
                    F.concat(head, "payload", F.lit("\r\n\r\n")).cast("binary").alias("record")).withColumnRenamed("_rank", "number")


def _leaves(first: DataFrame, second: DataFrame) -> DataFrame:
    """(replica, file, number, copies, length, low, high, digest, offset): one row a replica and number.

    Copies are counted before they meet, so a number that is repeated without end is one small sum.
    """
    leaf = lambda r, name: pick(r, file="file", number="number", record="record").select(
        F.lit(name).alias("replica"), "file", "number", F.coalesce("record", F.lit(b"")).alias("record")).select(
        "replica", "file", "number", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"))
    part = lambda k: F.sum(F.conv(F.substring("hash", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"part{k}")
    both = leaf(first, "a").unionByName(leaf(second, "b")).groupBy("replica", "file", "number").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("length").alias("length"), F.min("hash").alias("low"), F.max("hash").alias("high"),
        *[part(k) for k in range(4)])
    many = F.sha2(F.concat_ws(" ", "copies", *[f"part{k}" for k in range(4)]), 256)
    both = both.withColumn("digest", F.when(F.col("copies") == 1, F.col("low")).otherwise(many)).drop(*[f"part{k}" for k in range(4)])
    both = materialize(both, "leaves")
    # offsets by running sums in two steps: within blocks of numbers, and over the blocks of a file
    mine = both.where("replica = 'a'").select("file", "number", "length", F.floor(F.col("number") / FILE_RECORDS).alias("block"))
    blocks = mine.groupBy("file", "block").agg(F.sum("length").alias("total"))
    blocks = blocks.select("file", "block", (F.sum("total").over(Window.partitionBy("file").orderBy("block")) - F.col("total")).alias("base"))
    inner = F.sum("length").over(Window.partitionBy("file", "block").orderBy("number")) - F.col("length")
    index = mine.withColumn("inner", inner).join(blocks, ["file", "block"]).select("file", "number", (F.col("base") + F.col("inner")).alias("offset"))
    return materialize(both.join(index, ["file", "number"], "left"), "placed_leaves")


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT,
          levels: int | None = None) -> DataFrame:
    """(file, number, offset, length, kind) of every record in which the replicas (file, number, record) differ.

    ``offset`` and ``length`` are the first replica's (all copies of a number together); an extra
    record has the second one's length and no offset. ``levels`` of the tree: as many as needed, if not given.
    """
    leaves = _leaves(first, second)
    extra = -1 - F.floor(F.abs("number") / RANGE_RECORDS)
    leaves = leaves.withColumn("node", F.coalesce(F.floor(F.col("offset") / range_bytes), extra))
    if levels is None:
        levels, span = 1, (leaves.agg(F.max(F.abs("node"))).first()[0] or 0) + 1
        while fanout ** levels < span:
            levels += 1
    joined = lambda *key: F.sha2(F.concat_ws("\n", F.transform(
        F.sort_array(F.collect_list(F.struct(*key, "digest"))), lambda c: F.concat_ws(" ", c[key[0]], c["digest"]))), 256)
    tree = [materialize(leaves.groupBy("replica", "file", "node").agg(joined("number").alias("digest")), "tree0")]
    for k in range(1, levels + 1):
        up = F.floor(F.col("node") / fanout) if k < levels else F.lit(0)  # extra ranges stay below zero; the root is 0
        tree.append(materialize(tree[-1].withColumn("up", up.cast("long")).groupBy("replica", "file", "up")
                                .agg(joined("node").alias("digest")).withColumnRenamed("up", "node"), f"tree{k}"))
    digests = lambda t, *key: t.groupBy("file", *key).agg(
        F.max(F.when(F.col("replica") == "a", F.col("digest"))).alias("a"),
        F.max(F.when(F.col("replica") == "b", F.col("digest"))).alias("b")).where("not (a <=> b)")
    bad = digests(tree[levels], "node").select("file", F.col("node").alias("up"))
    for k in range(levels - 1, -1, -1):
        up = F.floor(F.col("node") / fanout) if k < levels - 1 else F.lit(0)
        children = tree[k].withColumn("up", up.cast("long")).join(bad, ["file", "up"], "left_semi")
        bad = digests(children, "node").select("file", F.col("node").alias("up"))
    suspects = leaves.withColumnRenamed("node", "up").join(bad, ["file", "up"], "left_semi")
    pairs = suspects.groupBy("file", "number").agg(F.max("offset").alias("offset"), *[
        F.max(F.when(F.col("replica") == r, F.col(c))).alias(f"{c}_{r}") for r in "ab" for c in ("length", "digest", "copies", "low", "high")])
    equal = (F.col("low_a") == F.col("high_a")) & (F.col("low_b") == F.col("high_b")) & (F.col("low_a") == F.col("low_b"))
    kind = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
            .when(equal, "repeated").otherwise("changed"))
    return pairs.where("not (digest_a <=> digest_b)").select(
        "file", "number", "offset", F.coalesce("length_a", "length_b").alias("length"), kind.alias("kind"))
