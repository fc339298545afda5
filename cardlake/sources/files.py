"""File sources and sinks of the raw and bronze layers.

Readers: header CSV (declared schema, dialect options, extension filter),
one-object JSON (multi-line), text by line, text by whole file, and a
splittable reader for one giant ``{"target": {"<id>": "<label>", ...}}``
object. Writers: the same shapes from DataFrames, all distributed.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardlake.operators.reshape import FRAUD_OBJECT_SCHEMA, explode_map
from cardlake.sources.csv_split import QuotedRecords, csv_records, header_names
from cardlake.sources.json_split import object_entries

# Dialect of the delimited source files.
CSV_DIALECT = {"sep": ",", "quote": '"', "escape": "\\", "header": "true"}
# Writing keeps padding (" no " stays padded); an empty string is written as
# "" and a NULL as an empty field, and the reader tells them apart.
CSV_WRITE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# --- readers ----------------------------------------------------------------------

def _keep_empty() -> dict[str, str]:
    """An unquoted empty field reads as the null value, a quoted one as ''. The null value is new for each
    reader, so no text equals it."""
    return {"nullValue": uuid.uuid4().hex}


def header_groups(spark: SparkSession, path: str | list[str], escape: str = CSV_DIALECT["escape"],
                  **options: str) -> list[tuple[str, list[str]]]:
    """The catalogue of a folder's files: ``(header record, files)``, in the order of each group's first file. Only the
    first record of each file is read, by the driver, which lists the files anyway. Files without
    a record are in no group. Compressed files are known by their ending, as in the engine's reader."""
    whole = QuotedRecords(escape).whole
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_record(uri: str) -> tuple[str | None, str]:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        try:
            text = codec.createInputStream(stream) if codec else stream
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
            record = lines.readLine()
            while record is not None and not whole(record) and (more := lines.readLine()) is not None:
                record += "\n" + more
            return record, file.toString()
        finally:
            stream.close()

    files = sorted(spark.read.options(**options).text(path).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for record, file in pool.map(first_record, files):
            if record is not None:
                groups.setdefault(record, []).append(file)
    return list(groups.items())


def _by_record(spark: SparkSession, header: str, files: list[str], options: dict[str, str]) -> DataFrame:
    """Text columns of files with one header; quoted fields may hold line breaks and the files are still split."""
    names = header_names(header, options["escape"])
    columns = StructType([StructField(n, StringType()) for n in names])
    records = csv_records(spark, files, options["escape"]).where(F.trim("record") != "")
    fields = F.from_csv("record", columns.toDDL(), {**options, "header": "false", "multiLine": "true"}).alias("fields")
    return records.select(fields).select("fields.*")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, glob: str | None = "*.csv",
             recursive: bool = False, keep_empty_strings: bool = True, infer: bool = False, line_breaks: bool = False,
             source_file: str | None = None, **options: str) -> DataFrame:
    """Header CSV; columns go by their header names. Files of one folder may have their columns in any order and
    may lack some or have others: files with the same header are read together, and the groups are put
    together by name, with NULL where a file lacks a column.

    Without a ``schema`` every column is text (``infer=True``: inferred types; text where the
    groups' types differ). With one, its columns come first, cast to their types (text that does not fit is
    NULL), then all other columns as text; a column that no file has is an error that names it.
    ``keep_empty_strings``: a quoted empty field reads as '' (an unquoted empty field is NULL); otherwise both
    read as NULL (Spark's default). ``line_breaks``: quoted fields may hold line breaks (the reader then
    writes its chunks to the scratch folder when called; all columns are text). ``source_file``
    names a further column for the name of the file each row came from (not with ``line_breaks``)."""
    dialect = {**CSV_DIALECT, **(_keep_empty() if keep_empty_strings else {}), **options}
    listing = {**({"pathGlobFilter": glob} if glob else {}), **({"recursiveFileLookup": "true"} if recursive else {})}

    def frame(header: str | None, where: str | list[str], listed: dict[str, str]) -> DataFrame:
        if line_breaks and header is not None:
            return _by_record(spark, header, where, dialect)
        df = spark.read.options(**{**dialect, **listed}).option("inferSchema", str(infer).lower()).csv(where)
        return with_source_file(df, source_file) if source_file else df

    groups = header_groups(spark, path, dialect["escape"], **listing)
    if len(groups) < 2 and not (line_breaks and groups):
        df = frame(None, path, listing)
    else:
        df = union_by_name([frame(header, files, {}) for header, files in groups])
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    extra = [c for c in df.columns if c not in schema.names]
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields],
                     *[F.col(f"`{c}`") for c in extra])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns by name in the order in which they first appear; a column whose types differ is text."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    out = None
    for df in frames:
        same = df.select(*[(F.col(f"`{c}`").cast("string").alias(c) if len(types[c]) > 1 else F.col(f"`{c}`"))
                           for c in df.columns])
        out = same if out is None else out.unionByName(same, allowMissingColumns=True)
    return out


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Provenance column: the name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def read_json_object(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One (possibly pretty-printed) JSON object per file -> one wide row."""
    r = spark.read.option("multiLine", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_text_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row per file. ``wholetext`` must be passed as the reader keyword (a
    prior ``.option`` is reset by ``text()``'s own default). One task per file."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)


# --- bronze builders --------------------------------------------------------------

def bronze_mcc_codes(spark: SparkSession, path: str, keep_nulls: bool = True) -> DataFrame:
    """Merchant-code objects ``{"<code>": "<category>", ...}``, one per file and in any layout -> (mcc,
    category). Each object is read as one map, so planning does not grow with the codes.

    ``keep_nulls=True`` keeps NULL-valued codes (map form); ``False`` drops them
    (JSON round-trip form)."""
    objects = read_text_whole(spark, path).select(F.from_json("value", "map<string,string>").alias("codes"))
    pairs = explode_map(objects, "codes", "mcc", "category")
    pairs = pairs if keep_nulls else pairs.filter(F.col("category").isNotNull())
    return pairs.select(F.col("mcc").try_cast("int").alias("mcc"), "category")


def _fraud_rows(parsed: DataFrame) -> DataFrame:
    rows = explode_map(parsed, F.col("data.target"), "transaction_id", "fraud_label")
    return rows.select(F.col("transaction_id").try_cast("long").alias("transaction_id"), "fraud_label")


def bronze_fraud_labels_by_line(spark: SparkSession, path: str) -> DataFrame:
    """Each line is one whole object (works only for one-line objects)."""
    lines = read_text_lines(spark, path)
    return _fraud_rows(lines.select(F.from_json("value", FRAUD_OBJECT_SCHEMA).alias("data")))


def bronze_fraud_labels_whole(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one object, any layout. One task and one row per file:
    for bounded files only; use ``bronze_fraud_labels_split`` at scale."""
    files = read_text_whole(spark, path)
    return _fraud_rows(files.select(F.from_json("value", FRAUD_OBJECT_SCHEMA).alias("data")))


# commas between entries of a text that is no legal JSON: before a key, or at the end of a line
_NEXT_ENTRY = r',(?=\s*"(?:[^"\\]|\\.)*"\s*:)|,(?=[ \t]*\r?\n)'


def bronze_fraud_labels_split(spark: SparkSession, path: str) -> DataFrame:
    """Splittable read of giant label objects in any legal layout: one line or many, several objects a file, other
    keys beside ``target``, nested values. Gives the rows of ``bronze_fraud_labels_whole``, and those of all
    top-level objects where a file holds several. Runs of entries are cut out by ``json_split``, which
    writes its chunks when this is called, and parsed by the engine. Text among the entries that is no legal
    entry comes with a NULL id and the text as its label, so nothing is lost unseen."""
    def entries(text):
        return F.map_entries(F.from_json(F.concat(F.lit("{"), text, F.lit("}")), "map<string,string>"))

    one_by_one = F.flatten(F.transform(F.split("run", _NEXT_ENTRY), lambda e: F.coalesce(
        entries(e), F.array(F.struct(F.lit("").alias("key"), F.regexp_replace(e, r"^\s+|\s+$", "").alias("value"))))))
    pairs = F.when(F.col("run").isNull(), F.array(F.struct("key", "value"))).otherwise(
        F.coalesce(entries(F.col("run")), one_by_one))
    return object_entries(spark, path, "target").select(F.explode(pairs).alias("pair")).select(
        F.col("pair.key").try_cast("long").alias("transaction_id"), F.col("pair.value").alias("fraud_label"))


# --- writers ----------------------------------------------------------------------

def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> str:
    w = df.write.mode("overwrite").options(**CSV_DIALECT, **CSV_WRITE)
    if quote_all:
        w = w.option("quoteAll", "true")
    w.csv(path)
    return path


def _objects(df: DataFrame, key: str, value: str, entries: int, head: str, sep: str, tail: str) -> DataFrame:
    """(key, value) rows as JSON objects of at most ``entries`` consecutive rows of a task. Entries are
    written by the JSON generator, so quotes and nulls are kept; an object never grows with a key."""
    pair = F.to_json(F.create_map(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(value).cast("string")))
    block = F.floor(F.monotonically_increasing_id() / F.lit(entries))
    numbered = df.select(block.alias("block"), F.substring(pair, F.lit(2), F.length(pair) - 2).alias("entry"))
    return numbered.groupBy("block").agg(F.concat(
        F.lit(head), F.array_join(F.collect_list("entry"), sep), F.lit(tail)).alias("value")).select("value")


def write_json_object(df: DataFrame, key: str, value: str, path: str, entries_per_object: int = 50_000) -> str:
    """Write (key, value) rows as JSON objects ``{"k": "v", ...}``, one per file and as many as needed."""
    _objects(df, key, value, entries_per_object, "{", ", ", "}").write.mode("overwrite").option(
        "maxRecordsPerFile", 1).text(path)
    return path


#: Legal layouts of a label object: what stands before, between and behind the entries.
LABEL_LAYOUTS = {
    "line": ('{"target": {', ", ", "}}"),
    "pretty": ('{\n  "target": {\n    ', ",\n    ", "\n  }\n}"),
    "brace_below": ('{"target":\n{\n', ",\n", "}}"),
    "other_objects": ('{"meta": {"target": {"1": "Yes"}, "list": [1, {"target": {"2": "x"}}]}, "target": {', " , ",
                      '\n}, "after": {"3": "No, }"}}'),
    "loose": ('\r\n{\t"t\\u0061rget"\r\n: {', ',\r\n\r\n\t', "\t}\r\n}\r\n"),
}


def write_label_objects(df: DataFrame, key: str, value: str, path: str, entries_per_object: int = 200_000,
                        pretty: bool = False, layout: str | None = None) -> str:
    """Write (key, value) rows as ``{"target": {"k": "v", ...}}`` objects of at most ``entries_per_object``
    entries. ``pretty`` lays each out over many lines, one entry a line and one object per file;
    otherwise an object is one line and a file holds many. ``layout`` names another of ``LABEL_LAYOUTS``."""
    layout = layout or ("pretty" if pretty else "line")
    head, sep, tail = LABEL_LAYOUTS[layout]
    w = _objects(df, key, value, entries_per_object, head, sep, tail).write.mode("overwrite")
    (w if layout == "line" else w.option("maxRecordsPerFile", 1)).text(path)
    return path


def land_csv(spark: SparkSession, src: str, dst: str, glob: str = "*.csv", recursive: bool = False,
             compression: str | None = None) -> str:
    """Raw landing copy of delimited files, read and written as text columns: no type conversion, nothing truncated.
    Fields are quoted where they hold a separator, quote, backslash or line break; '' is written as "" and NULL as
    nothing, so no text can be taken for it (quoting every field would make the two alike). Files keep their
    own headers: those with the same header are landed together. ``compression`` names a codec for the copy, whose
    files then end as the codec's do (``*.csv.gz``); a file is what one task wrote, so its size does not follow the data's."""
    listing = {"pathGlobFilter": glob, **({"recursiveFileLookup": "true"} if recursive else {})}
    options = {**CSV_DIALECT, **_keep_empty()}
    mode = "overwrite"
    for header, files in header_groups(spark, src, options["escape"], **listing):
        _by_record(spark, header, files, options).write.mode(mode).options(**CSV_DIALECT, **CSV_WRITE).csv(
            dst, compression=compression)
        mode = "append"
    return dst


def land_text(spark: SparkSession, src: str, dst: str, glob: str = "*.json") -> str:
    """Raw landing copy of JSON files, line by line (stays splittable)."""
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(src)
    df.write.mode("overwrite").text(dst)
    return dst


# --- one raw folder in, raw frames out --------------------------------------------

# Fixed layout: one sub-folder per source under a single raw folder.
RAW_SOURCES = ("users", "cards", "transactions", "mcc_codes", "fraud_labels")


def write_raw_dir(raw: dict[str, DataFrame], raw_dir: str, pretty_labels: bool = True) -> str:
    """Land raw frames in their source shapes: header CSV for users, cards and
    transactions; one JSON object for the code list; bounded label objects."""
    for name in ("users", "cards", "transactions"):
        write_csv(raw[name], f"{raw_dir}/{name}")
    write_json_object(raw["mcc_codes"], "mcc", "category", f"{raw_dir}/mcc_codes")
    write_label_objects(raw["fraud_labels"], "transaction_id", "fraud_label", f"{raw_dir}/fraud_labels",
                        pretty=pretty_labels)
    return raw_dir


def read_raw_dir(spark: SparkSession, raw_dir: str, fraud_reader: str = "split") -> dict[str, DataFrame]:
    """Raw frames from one raw folder: CSV columns as text under their header names (silver types them and
    the reject report counts what does not fit), map-form code list, splittable label reader by default."""
    readers = {
        "split": bronze_fraud_labels_split,
        "lines": bronze_fraud_labels_by_line,
        "whole": bronze_fraud_labels_whole,
    }
    frames = {name: read_csv(spark, f"{raw_dir}/{name}") for name in
              ("users", "cards", "transactions")}
    frames["mcc_codes"] = bronze_mcc_codes(spark, f"{raw_dir}/mcc_codes", keep_nulls=True)
    frames["fraud_labels"] = readers[fraud_reader](spark, f"{raw_dir}/fraud_labels")
    return frames
