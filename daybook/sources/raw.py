"""Readers for landed data: raw records, database extracts, delimited files, binary text, seeds."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from daybook.functions.columns import blank_null, k, robust_date
from daybook.operators.staging import materialise

C = F.col
RECORD = "RECID string, XMLRECORD string"
ROWS_PER_FILE = 500_000


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed records: id and text."""
    return spark.read.format(fmt).load(path).select("RECID", "XMLRECORD")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata records from a multi-line JSON array."""
    return spark.read.schema(RECORD).option("multiLine", True).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Records from a database; pass partitionColumn, bounds and numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select("RECID", "XMLRECORD")


def newer_than(df: DataFrame, mark_col: str, last_value: str | None) -> DataFrame:
    """Rows above the high-water mark; the filter reaches the source (file statistics or database)."""
    if last_value is None:
        raise ValueError("an incremental extract needs the last value")
    return df.filter(C(mark_col) > F.lit(last_value))


def high_water(df: DataFrame, mark_col: str) -> DataFrame:
    """Next high-water mark as a one-row frame."""
    return df.agg(F.max(mark_col).alias("high_water"))


def write_extract(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write an extract and return its row count, counted during the write. No rows still leave a readable file."""
    seen = Observation("extract")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("maxRecordsPerFile", rows_per_file) \
        .mode("overwrite").parquet(path)
    return seen.get["rows"]


def read_bulk_text(spark: SparkSession, path: str) -> DataFrame:
    """Two tab-separated columns from a bulk copy; status lines carry no tab and are dropped."""
    cells = F.split("value", "\t", 2)
    return spark.read.text(path).filter(C("value").contains("\t")).select(
        cells[0].alias("RECID"), cells[1].alias("XMLRECORD"))


# Prefixes stripped from a physical table name.
PREFIXES = "^(FBNK_|F_)"


def logical_names(tables: DataFrame, overrides: Mapping[str, tuple[str, str]] | None = None, physical: str = "physical") -> DataFrame:
    """Metadata key and target table of physical tables: prefix stripped, '_' becomes '.'; overrides win."""
    bare = F.regexp_replace(C(physical), PREFIXES, "")
    key, target = F.replace(bare, F.lit("_"), F.lit(".")), F.lower(bare)
    for name, (own_key, own_target) in (overrides or {}).items():
        key = F.when(C(physical) == name, own_key).otherwise(key)
        target = F.when(C(physical) == name, own_target).otherwise(target)
    return tables.withColumns({"metadata_key": key, "target": target})


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, file_name, bytes and modified of the files below ``path`` that match; no file is opened."""
    found = spark.read.format("binaryFile").load(f"{path}/{pattern}").select("path", C("length").alias("bytes"), C("modificationTime").alias("modified"))
    return found.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def wanted_files(files: DataFrame, manifest: DataFrame, report: str, day: str) -> tuple[DataFrame, DataFrame]:
    """Files the manifest names for a report and day, and the entries whose file has not arrived."""
    entries = manifest.filter((C("report_name") == report) & (C("date_created") == F.lit(day).cast("date"))).select("file_name")
    return files.join(entries, "file_name", "left_semi"), entries.join(files, "file_name", "left_anti")


def require_all(missing: DataFrame, show: int = 20) -> None:
    names = [r[0] for r in missing.limit(show).collect()]
    if names:
        raise FileNotFoundError(f"files not delivered: {names}")


def read_utf16_table(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-16LE") -> DataFrame:
    """'~' separated UTF-16 files with a dirty header: marks and zero bytes removed, blanks null, empty rows dropped.

    Naming the byte order and the line end lets Spark split a big file.
    """
    raw = spark.read.csv(path, sep="~", encoding=encoding, lineSep="\n", header=True, schema=schema)
    clean = raw.select(*[blank_null(F.regexp_replace(c, "[\ufeff@\u0000\r]", "")).alias(c) for c in raw.columns])
    return clean.na.drop("all")


# Windows-1252 is Latin-1 but for these bytes (five of which it leaves undefined).
_UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
_OWN_BYTES = [b for b in range(0x80, 0xA0) if b not in _UNDEFINED]
_LATIN = "".join(map(chr, _OWN_BYTES))
_WINDOWS = bytes(_OWN_BYTES).decode("cp1252")


def _single_byte(content: Column) -> tuple[Column, Column, Column]:
    """Bytes as Latin-1 and as Windows-1252, and whether they hold one that Windows-1252 leaves undefined."""
    latin = F.decode(content, "ISO-8859-1")
    return latin, F.translate(latin, _LATIN, _WINDOWS), latin.rlike("[" + "".join(f"\\x{b:02x}" for b in _UNDEFINED) + "]")


def _file_lines(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """Lines of text files as they lie in the file, with the place of the part of the file they were read in and their order there."""
    return spark.read.options(**options).text(path).select(
        C("_metadata.file_path").alias("_file"), C("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value")


def read_mixed_encodings(spark: SparkSession, path: str) -> DataFrame:
    """Lines of legacy files whose encoding differs per file; '}' stands for ': ', '~' separates cells.

    A file is UTF-16 (with its mark), UTF-8, Windows-1252, or else Latin-1: the first that fits all of its lines. Files are read in parts, as lines
    of bytes: a first pass sums up each part (number of lines, whether they are UTF-8), these few rows give every part the encoding of its
    file and the number of its first line, and the second pass decodes line by line. Only UTF-16 files, whose line ends are no single bytes,
    are decoded as a whole; big ones with one known layout are for ``read_utf16_table``.
    """
    lines = _file_lines(spark, path)  # both passes read the same parts, so a line has the same place in both
    content = C("value").cast("binary")
    _, _, undefined = _single_byte(content)
    parts = materialise(lines.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"), F.bool_and(F.try_validate_utf8("value").isNotNull()).alias("utf8"), F.bool_or(undefined).alias("undefined"),
        F.hex(F.substring(F.min_by(content, "_at"), 1, 2)).alias("mark")))
    whole, earlier = Window.partitionBy("_file"), Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    known = parts.select(
        "_file", "_block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.when(F.bool_or((C("_block") == 0) & C("mark").isin("FFFE", "FEFF")).over(whole), "UTF-16").when(F.bool_and("utf8").over(whole), "UTF-8")
        .when(F.bool_or("undefined").over(whole), "ISO-8859-1").otherwise("WINDOWS-1252").alias("encoding"))
    latin, windows, _ = _single_byte(content)
    text = F.when(C("encoding") == "UTF-8", C("value")).when(C("encoding") == "ISO-8859-1", latin).otherwise(windows)
    decoded = lines.join(known.filter("encoding <> 'UTF-16'"), ["_file", "_block"]).select(
        "_file", (C("before") + C("_at") - C("first") + 1).cast("int").alias("line_seq"), text.alias("line"))
    marked = [r[0] for r in known.filter("encoding = 'UTF-16' and _block = 0").select("_file").collect()]  # paths, as Spark's own listing holds them
    if marked:
        wide = spark.read.format("binaryFile").load([unquote(m) for m in marked]).select(
            C("_metadata.file_path").alias("_file"), F.posexplode(F.split(F.decode("content", "UTF-16"), "\r\n|\r|\n")).alias("line_seq", "line"))
        decoded = decoded.unionByName(wide.select("_file", (C("line_seq") + 1).alias("line_seq"), "line"))
    fixed = F.replace("line", F.lit("}"), F.lit(": "))
    return decoded.filter(F.trim("line") != "").select(F.url_decode(F.replace(F.element_at(F.split("_file", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("source_file"), "line_seq",
                                                       fixed.alias("line"), F.split(fixed, "~").alias("cells"))


def read_pipe_table(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Pipe-separated file without header; columns named by position when the width matches."""
    raw = spark.read.csv(path, sep="|")
    return raw.toDF(*names) if len(raw.columns) == len(names) else raw


def split_by_template(lines: DataFrame, headers: Sequence[str], least: int = 14, sep: str = "[|]",
                      numeric: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Delimited lines under template headers; lines with too few cells are set aside.

    Named numeric columns get a flag column telling whether the text is a number.
    """
    cells = lines.withColumn("_c", F.split("value", sep))
    good = cells.filter(F.size("_c") >= least).select(*[F.trim(F.get("_c", F.lit(i))).alias(h) for i, h in enumerate(headers)])
    flags = {f"{n}_is_number": F.replace(C(n), F.lit(","), F.lit("")).try_cast("double").isNotNull() for n in numeric}
    return good.withColumns(flags) if flags else good, cells.filter(F.size("_c") < least).drop("_c")


# Delimiters tried, in this order.
DELIMITERS = ("|", ",", ";", "\t")


def best_delimiter(lines: DataFrame) -> str:
    """Delimiter that cuts some line into most cells, over all lines; the earlier one wins a tie."""
    widths = lines.agg(*[F.max(F.size(F.split("value", f"[{d}]"))).alias(f"w{i}") for i, d in enumerate(DELIMITERS)]).first()
    return DELIMITERS[max(range(len(DELIMITERS)), key=lambda i: (widths[i] or 0, -i))]


def assign_headers(lines: DataFrame, headers: Sequence[str], width: int, delimiter: str, drop_first: bool = False) -> DataFrame:
    """Name cells by position. Surplus cells become ``Extra_Col_<n>`` with n counted on from the headers; surplus headers fall away.

    With ``drop_first`` the first cell of a line is none of the columns (loan master extracts begin with one).
    """
    skip = 1 if drop_first else 0
    cells = F.split("value", f"[{delimiter}]")
    names = [*headers[:width - skip], *[f"Extra_Col_{n}" for n in range(len(headers) + 1, width - skip + 1)]]
    return lines.select(*[F.trim(F.get(cells, F.lit(i + skip))).alias(n) for i, n in enumerate(names)])


def _quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of quoted CSV files, read in parts: ``_file``, ``text`` of the record, and ``head`` for a file's first.

    Whether a line begins a record follows from the number of quotes before it. The first pass counts the quotes of each part of a
    file, a sum over the parts before tells how each part begins, and the second pass cuts every part into records on its own. What is left over at a
    part's beginning belongs to the last record begun before; only these records, at most one per part, are put together across parts.
    """
    lines = _file_lines(spark, path, lineSep="\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("_file", "_block").agg((F.sum(quotes) % 2).alias("odd")).select(
        "_file", "_block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("open"))
    above = Window.partitionBy("_file", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("_file", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.join(parts, ["_file", "_block"]).withColumns({"before": C("open") + F.coalesce(F.sum(quotes).over(above), F.lit(0)),
                                                                  "top": (C("_block") == 0) & (F.count(F.lit(1)).over(here) == 1)})
    begun = counted.withColumn("record", F.max(F.when(C("before") % 2 == 0, C("_at"))).over(here))

    def joined(pieces: str, order: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, pieces))), lambda x: x[pieces]), "\n")

    cut = materialise(begun.groupBy("_file", "_block", "record").agg(joined("value", "_at").alias("text"), F.max("top").alias("head")))
    last = cut.groupBy("_file", "_block").agg(F.max("record").alias("record"))
    owner = F.last(F.when(C("record").isNotNull(), F.struct(C("_block"), C("record"))), ignorenulls=True).over(earlier)
    rests = cut.filter(C("record").isNull()).join(last.select("_file", "_block", owner.alias("owner")), ["_file", "_block"]).select(
        "_file", "_block", "text", C("owner._block").alias("of_block"), C("owner.record").alias("of_record"))
    owners = rests.select("_file", C("of_block").alias("_block"), C("of_record").alias("record")).distinct()
    opened = cut.join(owners, ["_file", "_block", "record"], "left_semi").select(
        "_file", "_block", "text", C("_block").alias("of_block"), C("record").alias("of_record"), "head")
    spanning = opened.unionByName(rests, allowMissingColumns=True).groupBy("_file", "of_block", "of_record").agg(joined("text", "_block").alias("text"), F.max("head").alias("head"))
    inside = cut.filter(C("record").isNotNull()).join(owners, ["_file", "_block", "record"], "left_anti")
    both = inside.select("_file", "text", "head").unionByName(spanning.select("_file", "text", "head"))
    return both.withColumn("text", F.rtrim("text", F.lit("\r"))).filter(C("text") != "")


def read_quoted_table(spark: SparkSession, path: str, file_column: str | None = None) -> DataFrame:
    """Quoted CSV whose cells may span lines, every column as text; a quote within a cell is doubled, the first record of a file is its header.

    Big files are read in parts. Columns are named by the header of the first file; lines end with ``\\n`` or ``\\r\\n``; empty lines between records are
    no records. ``file_column`` asks for the path of the file a row comes from.
    """
    records = materialise(_quoted_records(spark, path))
    first = records.filter("head").orderBy("_file").select("text").first()
    if first is None:
        raise ValueError(f"no header below {path}")
    names = next(csv.reader(io.StringIO(first[0].removeprefix("\ufeff"), newline="")))
    layout = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    # exploding the one-element array keeps later columns and filters from repeating the read
    row = F.explode(F.array(F.from_csv("text", layout, {"quote": '"', "escape": '"'})))
    read = records.filter(~C("head")).select(C("_file"), row.alias("row"))
    return read.select(*[C("row")[n].alias(n) for n in names], *([C("_file").alias(file_column)] if file_column else []))


def file_date(name: Column | str) -> Column:
    """Day in a file name (yyyyMMdd), else null."""
    return F.try_to_timestamp(blank_null(F.regexp_extract(name, r"(\d{8})", 1)), F.lit("yyyyMMdd")).cast("date")


def file_month(name: Column | str) -> Column:
    """Month in a file name (yyyy_MM) as yyyy-MM, else null."""
    return blank_null(F.regexp_replace(F.regexp_extract(name, r"(\d{4}_\d{2})", 1), "_", "-"))


def read_channel_log(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """Monthly log of a digital channel (agency, teller machine, internet banking, transfers) with its partition columns.

    The month stands in the name of the file, or else of its folder. Rows whose date cannot be read belong to the first day of the file's month.
    """
    raw = read_quoted_table(spark, path, file_column="_path")
    names = F.split("_path", "/")
    month = F.coalesce(file_month(F.element_at(names, -1)), file_month(F.element_at(names, -2)))
    first = F.to_date(F.concat(month, F.lit("-01")))
    return raw.select(*[c for c in raw.columns if c != "_path"], month.alias("partition_month"), robust_date(date_col, fallback=first).alias("partition_date"))


def account_from_number(col: Column | str) -> tuple[Column, Column, Column]:
    """Account id read as a number (12345.0) and its branch and product parts."""
    text = k(C(col) if isinstance(col, str) else col).try_cast("double").try_cast("decimal(20,0)").cast("string")
    return text, F.substring(text, 1, 2), F.substring(text, 3, 4)


def with_provenance(df: DataFrame, day: str) -> DataFrame:
    """Source file and ingestion day."""
    return df.withColumns({"_source_file": C("_metadata.file_name"), "_ingestion_date": F.lit(day).cast("date")})


def cast_listed(df: DataFrame, dates: Sequence[str] = (), decimals: Sequence[str] = (), layout: str = "yyyyMMdd",
                dtype: str = "decimal(20,4)") -> DataFrame:
    """Cast the listed columns that are present."""
    wanted = {c: F.to_date(F.try_to_timestamp(c, F.lit(layout))) for c in dates if c in df.columns}
    wanted |= {c: F.replace(C(c), F.lit(","), F.lit("")).try_cast(dtype) for c in decimals if c in df.columns}
    return df.withColumns(wanted) if wanted else df


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Seed table from CSV with a header."""
    return spark.read.csv(path, header=True, schema=schema)


def export_csv(df: DataFrame, path: str, order: Sequence[str | Column] = (), one_file: bool = False) -> None:
    """CSV with headers, sorted over all part files by ``order``: file names in order give the rows in order.

    The rows are computed and sorted in parallel. ``one_file`` then brings the sorted rows into one task, for reports that
    a person opens; only the last step runs there.
    """
    out = df.orderBy(*order) if order else df
    if one_file:
        out = df.repartition(1).sortWithinPartitions(*order) if order else df.repartition(1)
    out.write.mode("overwrite").csv(path, header=True)


# Below anything of their type that is stored.
_LEAST = {"date": "0001-01-01", "timestamp": "0001-01-01 00:00:00", "timestamp_ntz": "0001-01-01 00:00:00", "string": ""}


def newer_than_own(df: DataFrame, column: str, history: DataFrame | None) -> DataFrame:
    """Loads newer than the newest in the own history; all of them if there is none yet.

    The newest is one value that Spark looks up before it plans the read: of a table partitioned by ``column`` the older partitions are
    not listed in the scan, of another the comparison reaches the files' statistics.
    """
    if history is None:
        return df
    kind = history.schema[column].dataType.simpleString()
    least = F.lit(_LEAST[kind]).cast(kind) if kind in _LEAST else F.lit("-Infinity").cast("double") if kind in ("double", "float") else F.lit(-(2**63) + 1)
    seen = history.agg(F.coalesce(F.max(column), least)).scalar()
    none = history.agg(F.count(column) == 0).scalar()
    return df.filter((F.col(column) > seen) | none & (F.col(column).isNull() | (F.col(column) == least)))
