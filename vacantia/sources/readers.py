"""Reading postings from delimited text and JSON."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip
from ..operators.skew import lookup
from ..shared import settle

EXTRA = "_extra"
#: Characters that one record may have within a read part.
LONGEST = 1 << 24
# Lines of a stretch of a file, which one task sorts.
STRETCH = 65_536

# Field texts that stand for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _strings(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _missing_to_null(df: DataFrame, names: Sequence[str], missing: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.when(~F.col(n).isin(*missing), F.col(n)) for n in names}) if missing and names else df


def read_delimited(spark: SparkSession, path, columns: Sequence[str], sep: str = ";",
                   multi_line: bool = True, missing: Sequence[str] = MISSING) -> DataFrame:
    """Delimited text with a header; rows with too many fields are skipped.

    Short rows are padded with nulls and ``missing`` texts are null.  A byte order
    mark is part of the header, which is not used.  One extra column catches
    the surplus, so that only rows with a surplus are lost.  With
    ``multi_line`` fields may hold line breaks; a large file is still read by
    many tasks (``quoted_records``).
    """
    names = list(columns)
    schema = _strings([*names, EXTRA])
    if multi_line:
        rows = _parsed(quoted_records(spark, path, sep), schema, sep)
    else:
        rows = (spark.read.schema(schema)
                .options(header=True, sep=sep, quote='"', escape='"', mode="PERMISSIVE", encoding="UTF-8", columnPruning=False)
                .csv(path))
    return _missing_to_null(rows.filter(F.col(EXTRA).isNull()).drop(EXTRA), names, missing)


def read_plain(spark: SparkSession, path, schema, multi_line: bool = True, missing: Sequence[str] = ()) -> DataFrame:
    """Comma-separated text with a header and a given schema.

    ``missing`` texts become null; without any, empty fields are null only.
    With ``multi_line`` fields may hold line breaks, as in ``read_delimited``.
    """
    if multi_line:
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = _parsed(quoted_records(spark, path, ","), kind, ",")
    else:
        rows = spark.read.schema(schema).options(header=True, quote='"', escape='"', mode="PERMISSIVE").csv(path)
    return _missing_to_null(rows, [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)], missing)


def _parsed(records: DataFrame, schema: StructType, sep: str, *keep: str) -> DataFrame:
    """The fields of the records after each file's header, by position; ``keep`` names columns that stay as they are."""
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = F.from_csv("record", kinds, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    rows = records.filter("line_no > header_no AND record <> ''").select(*keep, fields.alias("_fields"))
    return rows.select(*keep, *[F.col("_fields").getField(f.name).alias(f.name) for f in schema.fields])


def _lines(spark: SparkSession, path, **options) -> DataFrame:
    """Lines of text files with ``file``, ``block`` (where the read part begins) and ``at`` (order within it)."""
    return (spark.read.options(**options).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), "value"))


def headers(spark: SparkSession, glob: str) -> DataFrame:
    """(file, header) of every file of a glob in one distributed read.

    The header is the first line that is not blank; it is null for a file that
    has none or cannot be read at all.  Files of no bytes are not listed.
    """
    listed = spark.read.format("binaryFile").load(glob).select(F.col("path").alias("file"))
    lines = _lines(spark, glob, ignoreCorruptFiles=True).filter(~F.col("value").rlike("^\ufeff?[\\s,]*$"))
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("header"))
    return listed.join(first, "file", "left")


def skipped(found: DataFrame) -> DataFrame:
    """(file, reason) of the files that ``read_glob`` leaves out, from ``headers``."""
    return found.filter("header IS NULL").select("file", F.lit("no header line, or unreadable").alias("reason"))


def read_glob(spark: SparkSession, glob: str, source: str = "_source", row: str = "_row",
              missing: Sequence[str] = MISSING) -> DataFrame:
    """All files of a glob as strings, with the file's full path and a row
    number that grows within a file, united by column name.

    All files are read in one pass: a record's fields are numbered, and its
    file's header says which column each number is.  Only the distinct headers
    come to the driver.  Files without a header line are left out (``skipped``
    lists them); it is an error if none is left, and a file that turns out
    damaged after its header ends the read.
    """
    found = headers(spark, glob)
    counts = found.agg(F.count_if(F.expr("header IS NULL")), F.count_if(F.expr("header IS NOT NULL"))).first()
    if not counts[1]:
        raise FileNotFoundError(f"no readable file matches {glob}")
    # A file that cannot be opened must not be listed; only then the others are named one by one.
    paths = [r["file"] for r in found.filter("header IS NOT NULL").select("file").collect()] if counts[0] else glob
    records = quoted_records(spark, paths, ",")
    # One short row for each file, asked for twice.
    heads = settle(records.filter("line_no = header_no").select("file", F.col("record").alias("header")))
    names = {r["header"]: next(csv.reader(io.StringIO(r["header"]), strict=False)) for r in heads.select("header").distinct().collect()}
    columns = list(dict.fromkeys(n for header in sorted(names) for n in names[header]))
    places = spark.createDataFrame(
        [(h, [fields.index(c) if c in fields else None for c in columns]) for h, fields in names.items()], "header string, places array<int>")
    width = max(map(len, names.values()))
    rows = _parsed(records, _strings([f"_{i}" for i in range(width)]), ",", "file", "line_no")
    placed = lookup(rows.select("file", "line_no", F.array(*[f"_{i}" for i in range(width)]).alias("fields")),
                    heads.join(places, "header").select("file", "places"), ["file"],
                    _lines(spark, paths).groupBy("file").agg(F.count("*").alias("n")))
    value = [F.get("fields", F.get("places", F.lit(k))).alias(c) for k, c in enumerate(columns)]
    return _missing_to_null(placed.select(*value, F.col("file").alias(source), F.col("line_no").alias(row)), columns, missing)


def read_records(spark: SparkSession, path, schema=None, multi_line: bool = True) -> DataFrame:
    """JSON array of records (or, with ``multi_line`` off, one record per line)."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def field_count(record: Column, sep: str = ";") -> Column:
    """Number of fields of a raw record, separators inside quotes not counted."""
    bare = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def record_fields(record: Column, sep: str, n: int = 5) -> Column:
    """The first ``n`` fields of a raw record, unquoted."""
    escaped = f"\\{sep}" if not sep.isalnum() else sep
    fields = F.regexp_extract_all(
        F.concat(record, F.lit(sep)), F.lit(f'((?:"(?:[^"]|"")*"|[^"{escaped}])*){escaped}'), F.lit(1))
    return F.transform(F.slice(fields, 1, n), lambda f: F.replace(
        F.regexp_replace(f, '(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))


def audit_records(df: DataFrame, record: str, line_no: str, n_fields: int, sep: str = ";") -> DataFrame:
    """Records whose field count differs: (line_no, n_fields, preview)."""
    return (df.withColumn("n_fields", field_count(F.col(record), sep))
            .filter(F.col("n_fields") != n_fields)
            .select(line_no, "n_fields", record_fields(F.col(record), sep).alias("preview")))


def ends_quoted(line: Column, sep: str, starts_quoted: bool) -> Column:
    """Is a quoted field open at the end of a line, given whether one is at its start?

    A quote opens a field where the field begins and is an ordinary character
    elsewhere; in a quoted field two quotes are one, and after any other quote
    the field goes on unquoted to the next separator.  The fold goes over the
    texts before each quote: 0 in an unquoted field, 1 where a field begins, 2
    in a quoted one, 3 after a quote in it.
    """
    before = F.split(line, '"', -1)
    state = F.aggregate(
        F.slice(before, F.lit(1), F.size(before) - 1), F.lit(2 if starts_quoted else 1),
        lambda at, text: F.when(at == 2, 3).when(text == "", F.when(at == 0, 0).otherwise(2)).when(text.endswith(sep), 2).otherwise(0))
    return F.when(line.contains('"'), (state == 2).cast("int")).otherwise(int(starts_quoted))


def _states(lines: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """``before0/1`` and ``after0/1``: the state before and after each row, for either state before the first row of its group.

    Each row maps the state by (to0, to1): it keeps it, swaps it or fixes it.
    So a state is that of the last fixing row, turned by the swaps since.
    """
    fixes = F.col("to0") == F.col("to1")
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    past = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = lines.withColumn("swaps", F.coalesce(F.sum(((F.col("to0") == 1) & (F.col("to1") == 0)).cast("int")).over(upto), F.lit(0)))
    turned = turned.withColumn("fixed", F.when(fixes, F.struct((F.col("to0") + F.col("swaps")).alias("value"))))
    out = turned.withColumn("last_after", F.last("fixed", ignorenulls=True).over(upto)).withColumn(
        "last_before", F.last("fixed", ignorenulls=True).over(past)).withColumn("swaps_before", F.coalesce(F.last("swaps").over(past), F.lit(0)))
    for first in (0, 1):
        out = out.withColumns({f"before{first}": ((F.coalesce("last_before.value", F.lit(first)) + F.col("swaps_before")) % 2).cast("int"),
                               f"after{first}": ((F.coalesce("last_after.value", F.lit(first)) + F.col("swaps")) % 2).cast("int")})
    return out.drop("swaps", "fixed", "last_after", "last_before", "swaps_before")


def quoted_records(spark: SparkSession, path, sep: str = ";", longest: int = LONGEST) -> DataFrame:
    """(file, line_no, header_no, record) of every record, blank ones included; ``header_no`` is the first that is not blank.

    A record ends with a line at which no quoted field is open.  Each line maps
    "open before" to "open after"; the maps of a stretch of a read part are
    chained first, then those of the stretches, so a large file is split among
    tasks and only records of several lines are gathered.  Lines end with a
    line feed; if a file's first line has a carriage return before it, so have
    the others, and line breaks in its fields become line feeds.

    A quote that is never closed would make one record of all that follows:
    more than ``longest`` characters of a part within one record are an error
    that names the file and the record.
    """
    lines = _lines(spark, path, lineSep="\n").withColumns(
        {"to0": ends_quoted(F.col("value"), sep, False), "to1": ends_quoted(F.col("value"), sep, True)})
    # Stretches of a read part, so that no task sorts and holds a whole one.
    lines = lines.withColumn("stretch", F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / STRETCH))
    part = ["file", "block", "stretch"]
    lines = _states(lines, part, "at")
    here = Window.partitionBy(*part).orderBy("at")
    lines = lines.withColumn("index", F.row_number().over(here))
    filled = ~F.col("value").rlike("^\ufeff?\r?$")
    # For either state in which a part may begin, the records that begin in it.
    parts = lines.groupBy(*part).agg(
        F.max_by("after0", "at").alias("to0"), F.max_by("after1", "at").alias("to1"), F.count("*").alias("lines"),
        F.count_if(F.col("before0") == 0).alias("records0"), F.count_if(F.col("before1") == 0).alias("records1"),
        F.min(F.when(filled, F.col("index"))).alias("filled"), F.min_by(F.col("value").endswith("\r"), "at").alias("returns")).withColumn("place", F.struct("block", "stretch"))
    past = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begun = _states(parts, ["file"], "place").withColumn("open", F.col("before0"))
    begun = begun.withColumn("done", F.coalesce(F.sum(F.when(F.col("open") == 0, F.col("records0")).otherwise(F.col("records1"))).over(past), F.lit(0)))
    # Every line before the first that is not blank is a record of its own.
    first = F.when(F.col("filled").isNotNull(), F.coalesce(F.sum("lines").over(past), F.lit(0)) + F.col("filled"))
    begun = begun.withColumn("first", first).withColumns(
        {"header_no": F.min("first").over(Window.partitionBy("file")),
         "returns": F.first("returns").over(Window.partitionBy("file").orderBy("place"))}).select(
        F.col("file").alias("f"), F.col("block").alias("b"), F.col("stretch").alias("s"), "open", "done", "header_no", "returns")
    placed = lines.join(begun, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.col("stretch") == F.col("s")))
    starts = F.when(F.col("open") == 0, F.col("before0")).otherwise(F.col("before1")) == 0
    placed = placed.withColumns({"starts": starts, "line_no": F.col("done") + F.sum(starts.cast("int")).over(here)})
    alone = F.col("starts") & (F.col("to0") == 0)
    # Characters since the record began, within the read part.
    run = F.sum(F.length("value")).over(Window.partitionBy("file", "block", "line_no").orderBy("at"))
    unclosed = F.raise_error(F.concat(F.lit("quote not closed within the longest record: "), "file", F.lit(", record "), F.col("line_no").cast("string")))
    keys = ["file", "line_no", "header_no", "returns"]
    single = placed.filter(alone).select(*keys, F.col("value").alias("record"))
    open_ = placed.filter(~alone).withColumn("run", run).withColumn("value", F.when(F.col("run") > longest, unclosed).otherwise(F.col("value")))
    several = open_.groupBy(*keys).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n").alias("record"))
    bare = F.when(F.col("returns"), F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")).otherwise(F.col("record"))
    return single.unionByName(several).withColumn(
        "record", F.when(F.col("line_no") == 1, F.regexp_replace(bare, "^\ufeff", "")).otherwise(bare)).drop("returns")


def raw_records(spark: SparkSession, path, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """(file, line_no, record) of every record, blank ones included, and (file, n) lines per file."""
    counted = _lines(spark, path, lineSep="\n").groupBy("file").agg(F.count("*").alias("n"))
    return quoted_records(spark, path, sep).select("file", "line_no", "record"), counted


def audit_delimited(spark: SparkSession, path, sep: str = ";") -> DataFrame:
    """Records whose field count differs from that of their file's header, short, long and blank.

    (file, line_no, n_fields, preview); line numbers count records of the
    file, blank ones too, the header being line 1.  A blank record has no fields.
    """
    counted, lines = raw_records(spark, path, sep)
    blank = F.col("record") == ""
    counted = counted.withColumn("n_fields", F.when(blank, 0).otherwise(field_count(F.col("record"), sep)))
    wanted = counted.filter("line_no = 1").select("file", F.col("n_fields").alias("_wanted"))
    broken = lookup(counted, wanted, ["file"], lines).filter("n_fields <> _wanted")
    preview = F.when(blank, F.array().cast("array<string>")).otherwise(record_fields(F.col("record"), sep))
    return broken.select("file", "line_no", "n_fields", preview.alias("preview"))


def audit_head(audit: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Total of an audit and its first ``n`` records."""
    order = [c for c in ("file", "line_no") if c in audit.columns]
    return audit.agg(F.count(F.lit(1)).alias("broken")), audit.orderBy(*order).limit(n)
