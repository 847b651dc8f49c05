"""Entries of bundle objects read in splits: a very large bundle is many tasks' work.

The text source cuts objects at ``}`` and deals byte ranges of them to tasks,
so a row is a *segment* of JSON and never a whole object. What a segment means
depends on what stands before it: whether a string is open, how deep the
nesting is, which member of the bundle it belongs to. Each of these is carried
in two steps: inside a byte range by a running sum over its segments, and from
range to range by composing one small summary row per range. Only then are
segments known to belong to the n-th element of the top-level ``entry`` array,
and one grouping joins the segments of each entry.

The largest group in a task is one byte range
(``spark.sql.files.maxPartitionBytes``) or one entry. Text after the object
(blank lines) is allowed. An object whose nesting does not close, or that has
an entry that is no JSON object, is not read in parts but reported by
:func:`unsplit_objects` as malformed; the whole-text reader rejects it too.
Equal member names (``entry`` twice) follow each other. Members of the bundle
itself may hold plain arrays in arrays of four levels; FHIR has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A string's inside, a whole string, another value without parts. Possessive: a long string is matched
# without backtracking.
_INSIDE = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_STRING = f'"{_INSIDE}"'
_ATOM = r'[^\s,:"\[\]{}]++'


def _array(levels: int) -> str:
    """An array of strings, numbers and such arrays, so many levels deep."""
    inner = rf'|{_array(levels - 1)}' if levels > 1 else ""
    return rf'\[(?:[^"\[\]{{}}]++|{_STRING}{inner})*+\]'


_MEMBERS = rf'(?:{_STRING}\s*+:\s*+(?:{_STRING}|{_ATOM}|{_array(4)})\s*+,\s*+)*+'
#: What is left of an array, without objects, that a string with a brace has cut.
_REST = rf'(?:\s*+,?\s*+(?:{_STRING}|{_ATOM}))*+\s*+\]'
#: From the end of a member (or the start of the object) up to the ``{`` that a later member opens.
_OPENS = rf'(?s)^(?:{_REST})?\s*+[,{{]?\s*+{_MEMBERS}"({_INSIDE})"\s*+:\s*+(\[?)\s*+(?=\{{)'
_NEXT = r'^\s*+,\s*+(?=\{)'
_ENTRY_DEPTH = 2


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """``(object_name, object_time, start, at, text)``: byte range and place in it of every segment."""
    rows = (spark.read.format("text").option("lineSep", "}").option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", True).load(path))
    return rows.select(F.col("_metadata.file_path").alias("object_name"),
                       F.col("_metadata.file_modification_time").alias("object_time"),
                       F.col("_metadata.file_block_start").alias("start"),
                       F.col("_metadata.file_size").alias("size"),
                       F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _bare(text: Column) -> Column:
    """Without its strings, the last of which may be open."""
    return F.regexp_replace(text, f'(?s)"{_INSIDE}(?:"|$)', "")


def _with_depths(seg: DataFrame) -> DataFrame:
    """``text`` freed of what belongs to a string opened earlier, ``depth`` before and ``after`` it.

    ``closes`` says whether the ``}`` behind the segment is one, or a character of a string.
    """
    chunk, order = ["object_name", "start"], ["object_name"]
    so_far = Window.partitionBy(*chunk).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = Window.partitionBy(*order).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    # strings: parity of the quotes that are not escaped
    quotes = _count(F.regexp_replace("text", r"(?s)\\.", ""), '"') % 2
    seg = seg.withColumn("odd", quotes)
    parity = seg.groupBy(*chunk).agg(F.sum("odd").alias("n")).select(
        *chunk, F.coalesce(F.sum("n").over(ranges_before), F.lit(0)).alias("quotes_before"))
    seg = seg.join(parity, chunk)
    opened = (F.col("quotes_before") + F.coalesce(F.sum("odd").over(so_far), F.lit(0))) % 2 == 1
    seg = seg.withColumn("opened", opened)
    own = F.when(F.col("opened"), F.regexp_replace("text", f'(?s)^{_INSIDE}(?:"|$)', "")).otherwise(F.col("text"))
    seg = seg.withColumn("own", own).withColumn(
        "closes", (F.col("opened") == (F.col("odd") == 1)) & ~F.col("last"))
    # nesting: what a segment opens and closes outside strings
    bare = _bare(F.col("own"))
    seg = seg.withColumn("step", _count(bare, "{[") - _count(bare, "]") - F.when(F.col("closes"), 1).otherwise(0))
    nesting = seg.groupBy(*chunk).agg(F.sum("step").alias("n")).select(
        *chunk, F.coalesce(F.sum("n").over(ranges_before), F.lit(0)).alias("depth_before"))
    seg = seg.join(nesting, chunk)
    depth = F.col("depth_before") + F.coalesce(F.sum("step").over(so_far), F.lit(0))
    return seg.withColumn("depth", depth).withColumn("after", F.col("depth") + F.col("step"))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Segments with depth, the bundle's ``member`` they belong to and the number ``pos`` of the entry."""
    seg = _segments(spark, path)
    # an object's last segment has no } behind it if the bytes come to more with one
    ends = seg.groupBy("object_name", "start", "size").agg(
        F.max("at").alias("at"), F.sum(F.octet_length("text") + 1).alias("n")).groupBy("object_name", "size").agg(
        F.max(F.struct("start", "at")).alias("end"), F.sum("n").alias("n"))
    ends = ends.select("object_name", F.when(F.col("n") > F.col("size"), F.col("end")).alias("end"))
    seg = seg.join(ends, "object_name").withColumn("last", F.coalesce(
        (F.col("start") == F.col("end.start")) & (F.col("at") == F.col("end.at")), F.lit(False))).drop("end")
    seg = _with_depths(seg)
    chunk = ["object_name", "start"]
    here = Window.partitionBy(*chunk).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    so_far = Window.partitionBy(*chunk).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = Window.partitionBy("object_name").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    outer = F.col("depth") <= _ENTRY_DEPTH
    # an object inside a member that is no array lies at the same depth; only a new member changes the name
    top = (F.col("depth") < _ENTRY_DEPTH) | F.col("own").rlike(f"(?s)^{_REST}")
    member = F.when(outer & top, F.nullif(F.concat(F.regexp_extract("own", _OPENS, 1), F.regexp_extract("own", _OPENS, 2)),
                                          F.lit("")))
    seg = seg.withColumn("opens", member)
    carried = seg.groupBy(*chunk).agg(F.max_by("opens", F.when(F.col("opens").isNotNull(), F.col("at"))).alias("m")).select(
        *chunk, F.last("m", ignorenulls=True).over(ranges_before).alias("member_before"))
    seg = seg.join(carried, chunk, "left").withColumn(
        "member", F.coalesce(F.last("opens", ignorenulls=True).over(here), F.col("member_before")))
    in_entry = F.coalesce(F.col("member") == "entry[", F.lit(False))
    # blank or "]"-only text between members belongs to no entry
    seg = seg.withColumn("inside", in_entry & (
        (F.col("depth") > _ENTRY_DEPTH) | F.col("opens").isNotNull() | F.col("own").rlike(_NEXT)))
    ended = F.when(F.col("inside") & F.col("closes") & (F.col("after") == _ENTRY_DEPTH), 1).otherwise(0)
    seg = seg.withColumn("ended", ended)
    numbers = seg.groupBy(*chunk).agg(F.sum("ended").alias("n")).select(
        *chunk, F.coalesce(F.sum("n").over(ranges_before), F.lit(0)).alias("ended_before"))
    return seg.join(numbers, chunk).withColumn(
        "pos", F.col("ended_before") + F.coalesce(F.sum("ended").over(so_far), F.lit(0)))


def split_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(object_name, object_time, pos, body)``: the JSON text of every entry under ``path``, in bundle order."""
    seg = _placed(spark, path).where("inside")
    first = F.col("depth") <= _ENTRY_DEPTH
    text = F.when(first & F.col("opens").isNotNull(), F.regexp_replace("own", _OPENS, "")) \
        .when(first, F.regexp_replace("own", _NEXT, "")).otherwise(F.col("text"))
    part = F.struct("start", "at", F.concat(text, F.lit("}")).alias("text"))
    return (seg.groupBy("object_name", "object_time", F.col("pos").cast("int").alias("pos"))
            .agg(F.array_sort(F.collect_list(part)).alias("parts"))
            .select("object_name", "object_time", "pos",
                    F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("body")))


def unsplit_objects(spark: SparkSession, path: str) -> DataFrame:
    """``(object_name, unclosed, bad_entries)`` of the objects that cannot be read in parts."""
    ends = _placed(spark, path).groupBy("object_name").agg(
        ((F.sum("step") != 0) | (F.min("after") < 0) | (F.sum("odd") % 2 != 0)).alias("unclosed"))
    bad = split_entries(spark, path).groupBy("object_name").agg(
        F.count_if(F.try_parse_json("body").isNull()).alias("bad_entries"))
    return (ends.join(bad, "object_name", "left").withColumn("bad_entries", F.coalesce("bad_entries", F.lit(0)))
            .where("unclosed OR bad_entries > 0"))

