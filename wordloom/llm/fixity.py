"""Fixity of WARC archives: Merkle trees over records and ordered offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wordloom.llm.common import stored

_END = "\r\n\r\n"  # ends the head of a record, and the record
FAN_OUT = 16


def warc_record(
    identifier: Column, url: Column, body: Column, stated: Column | None = None
) -> Column:
    """The text of a WARC response record; null fields are empty. ``stated`` is the length
    given in the head if that of the body is another."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(identifier.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        (F.octet_length(body) if stated is None else stated).cast("string"),
        F.lit(_END),
        body,
        F.lit(_END),
    )


#: The first file of records without an id.
NO_ID = 2**40


def file_of(digest: Column, ids_per_file: int, null_files: int) -> Column:
    """The file of a page: by range of its id, without one by the digest of its record."""
    dealt = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % null_files + NO_ID
    return F.coalesce(F.floor(F.col("page_id") / ids_per_file), dealt)


def null_files_of(pages: DataFrame, ids_per_file: int = 1000) -> int:
    """How many files the records without an id need."""
    return -(-pages.filter("page_id is null").count() // ids_per_file) or 1


def lay_out(
    pages: DataFrame,
    ids_per_file: int = 1000,
    null_files: int | None = None,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """``file, offset, length, place, page_id, digest``: the place of every page's record.

    Files hold ranges of ``ids_per_file`` ids and in them records in order of id and digest.
    Records without an id are dealt by digest over ``null_files`` files, the last in number,
    of about ``ids_per_file`` records. Offsets are running sums of lengths within a file, of
    which a file has a bounded number unless ids, or records without one, repeat.

    ``carried`` are more columns, computed of each page before its text is let go.
    """
    if null_files is None:
        null_files = null_files_of(pages, ids_per_file)
    carried = carried or {}
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = (
        pages.select("page_id", record.alias("record"), *(c.alias(name) for name, c in carried.items()))
        .withColumns({"length": F.octet_length("record").cast("long"), "digest": F.sha2("record", 256)})
        .withColumn("file", file_of(F.col("digest"), ids_per_file, null_files))
    )
    places = Window.partitionBy("file").orderBy("page_id", "digest")
    before = places.rowsBetween(Window.unboundedPreceding, -1)
    # Only ids, lengths and digests are sorted, not the records.
    return rows.drop("record").withColumns(
        {
            "offset": F.coalesce(F.sum("length").over(before), F.lit(0)),
            "place": F.row_number().over(places) - 1,
        }
    )


def leaf_number(slots: int) -> Column:
    """The number of a place among all files' places, of which a file has ``slots``."""
    return F.col("file") * slots + F.col("place")


def merkle_levels(leaves: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Tables ``node, hash`` from the leaves (given) up to the root.

    The parent of node n is n / ``fan_out``; its hash is the SHA-256 of its children's
    hashes with their numbers, in order. A group has at most ``fan_out`` rows. Each level
    is stored, so that all of them can be read again.
    """
    level = stored(leaves.select("node", "hash"))
    levels = [level]
    while (level.agg(F.max("node")).first()[0] or 0) > 0:
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))
        joined = F.array_join(
            F.transform(children, lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"])), "|"
        )
        level = stored(
            level.groupBy(F.floor(F.col("node") / fan_out).alias("parent"))
            .agg(F.sha2(joined, 256).alias("hash"))
            .withColumnRenamed("parent", "node")
        )
        levels.append(level)
    return levels


def differing_leaves(
    one: list[DataFrame], two: list[DataFrame], fan_out: int = FAN_OUT
) -> DataFrame:
    """``node, expected, found`` of leaves whose hashes differ or that one tree lacks.

    The roots are compared, then level by level the children of nodes that differ.
    """
    spark = one[0].sparkSession
    while len(one) < len(two):
        one = one + [_lifted(one[-1], fan_out)]
    while len(two) < len(one):
        two = two + [_lifted(two[-1], fan_out)]
    differ = None
    for left, right in zip(reversed(one), reversed(two)):
        if differ is not None:
            parent = F.floor(F.col("node") / fan_out)
            left = left.join(differ, parent == F.col("parent"), "left_semi")
            right = right.join(differ, parent == F.col("parent"), "left_semi")
        pairs = left.withColumnRenamed("hash", "expected").join(
            right.withColumnRenamed("hash", "found"), "node", "full"
        )
        pairs = stored(pairs.filter(~F.col("expected").eqNullSafe(F.col("found"))))
        differ = pairs.select(F.col("node").alias("parent"))
        if pairs.isEmpty():
            break
    if pairs.isEmpty():
        return spark.createDataFrame([], "node long, expected string, found string")
    return pairs


def _lifted(level: DataFrame, fan_out: int) -> DataFrame:
    """A root one level higher, for a tree that is not as high as the other."""
    return level.select(
        F.floor(F.col("node") / fan_out).alias("node"),
        F.sha2(F.concat_ws(":", F.col("node").cast("string"), "hash"), 256).alias("hash"),
    )


def audit(places: DataFrame, replica: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """``file, offset, length, page_id, expected, found, status`` of damaged records.

    ``places`` is what ``lay_out`` gave for the archive; ``replica`` has ``file, offset,
    digest`` of the records found in a copy. Status is ``changed``, ``missing``, or
    ``extra`` for a record at a place where the archive has none; extra records have
    neither length nor id. Both trees are built from digests alone; only branches whose
    hashes differ are followed down.
    """
    at = ["file", "offset"]
    numbered = places.select(*at, "length", "page_id", "digest", "place")
    held = numbered.select(*at, "place", F.col("digest").alias("_expected"))
    # Records at places that the archive lacks are numbered behind its own, as are all but
    # one of several at one place: an intact one, if there is one, is no extra record.
    strange = replica.join(held, at, "left_anti")
    copies = replica.join(held, at).withColumn(
        "_turn", F.row_number().over(Window.partitionBy(*at).orderBy(F.col("digest") != F.col("_expected"), "digest"))
    )
    strange = strange.unionByName(copies.filter("_turn > 1").select(*replica.columns))
    ends = numbered.groupBy("file").agg((F.max("place") + 1).alias("_end"))
    turn = F.row_number().over(Window.partitionBy("file").orderBy("offset", "digest")) - 1
    extra = stored(
        strange.join(ends, "file", "left").select(
            *at, "digest", (F.coalesce("_end", F.lit(0)) + turn).alias("place")
        )
    )
    most = [t.agg(F.max("place")).first()[0] for t in (places, extra)]
    slots = max(0 if m is None else m for m in most) + 1
    numbered = stored(numbered.withColumn("node", leaf_number(slots)))
    known = copies.filter("_turn = 1").withColumn("node", leaf_number(slots)).select("node", "digest")
    unknown = extra.withColumn("node", leaf_number(slots))
    copy = known.unionByName(unknown.select("node", "digest"))
    one = merkle_levels(numbered.withColumnRenamed("digest", "hash"), fan_out)
    two = merkle_levels(copy.withColumnRenamed("digest", "hash"), fan_out)
    every = numbered.drop("digest", "place").unionByName(
        unknown.select(*at, "node"), allowMissingColumns=True
    )
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("expected").isNull(), "extra")
        .otherwise("changed")
    )
    return (
        differing_leaves(one, two, fan_out)
        .join(every, "node")
        .select("file", "offset", "length", "page_id", "expected", "found", status.alias("status"))
    )


def write_warc(pages: DataFrame, path: str, ids_per_file: int = 1000) -> None:
    """One WARC file for each range of ids under ``path/file=n``, places as ``lay_out``
    has them."""
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    null_files = null_files_of(pages, ids_per_file)
    rows = pages.select(
        file_of(F.sha2(record, 256), ids_per_file, null_files).alias("file"),
        "page_id",
        F.sha2(record, 256).alias("digest"),
        record.alias("record"),
    )
    rows = rows.repartition("file").sortWithinPartitions("file", "page_id", "digest")
    # The writer ends every row as WARC ends every record.
    body = F.substring("record", 1, F.char_length("record") - len(_END))
    rows.select("file", body.alias("value")).write.partitionBy("file").option(
        "lineSep", _END
    ).text(path)


def read_digests(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``file, offset, digest`` of what WARC files hold at the places of an archive.

    A file is read whole by one task, so files are to be of a bounded size. The places of a
    file come to it as one list, so its content is held once, not once for every record.
    """
    name = F.regexp_extract("path", r"/file=([0-9]+)/", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/file=*")
    listed = places.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("places")
    )
    held = files.select(name.alias("file"), "content").join(listed, "file")

    def digest(place: Column) -> Column:
        begin, length = (place["offset"] + 1).cast("int"), place["length"].cast("int")
        found = F.sha2(F.substring("content", begin, length), 256)
        return F.struct(place["offset"].alias("offset"), found.alias("digest"))

    return held.select("file", F.inline(F.transform("places", digest))).filter(
        F.col("digest") != F.sha2(F.lit(""), 256)
    )


#: Of 97 records one is changed and one lost in the replica that the query audits.
CHECK_SQL = r"""
with records as (
  select page_id, html, kind, prefix || html || chr(13) || chr(10) || chr(13) || chr(10) as record,
    prefix || case when kind = 5 then '?' || substr(html, 2) else html end
      || chr(13) || chr(10) || chr(13) || chr(10) as copy
  from (
    select page_id, coalesce(html, '') as html, page_id % 97 as kind,
      'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) as prefix
    from pages)),
placed as (
  select *, page_id // 1000 as file, strlen(record) as length,
    coalesce(sum(strlen(record)) over (partition by page_id // 1000 order by page_id
      rows between unbounded preceding and 1 preceding), 0) as offset_
  from records)
select cast(file as bigint) as file, cast(offset_ as bigint) as "offset", cast(length as bigint) as length,
  page_id, sha256(record) as expected, case when kind = 6 then null else sha256(copy) end as found,
  case when kind = 6 then 'missing' else 'changed' end as status
from placed where kind = 6 or sha256(record) <> sha256(copy)
"""
