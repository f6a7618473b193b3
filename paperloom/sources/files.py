"""Files of a corpus as tables, and tables as files. A folder that is missing gives an empty table."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

# Fixed value: the first bytes of a PDF file.
PDF_MAGIC = b"%PDF"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _with_empty(read: DataFrame, path: Column) -> DataFrame:
    """read with path, and a row of nulls for each empty file: Spark's scans skip those. Names come from the scan's own listing."""
    same = lambda p: F.regexp_replace(p, "^file:/+", "file:/")
    listed = read.sparkSession.createDataFrame([(unquote(p),) for p in read.inputFiles()], "path string").select(same(F.col("path")).alias("path"))
    return listed.join(read.withColumn("path", same(path)), "path", "left")


def catalogued(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, filename, size_bytes, is_pdf, valid_pdf) of the files whose names fit; names that start with a dot are left out.
    valid_pdf is null for files that are no PDF by name, false for empty ones and for others without the magic."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "path string, filename string, size_bytes long, is_pdf boolean, valid_pdf boolean")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).load(folder)
    found = _with_empty(found.select("path", "length", F.substring("content", 1, 4).alias("magic")), F.col("path"))
    named = found.select("path", _name(F.col("path")).alias("filename"), F.coalesce("length", F.lit(0)).cast("long").alias("size_bytes"), F.coalesce("magic", F.lit(b"")).alias("magic"))
    is_pdf = F.lower("filename").endswith(".pdf")
    return named.filter(~F.col("filename").startswith(".")).select("path", "filename", "size_bytes", is_pdf.alias("is_pdf"), F.when(is_pdf, F.col("magic") == F.lit(PDF_MAGIC)).alias("valid_pdf"))


def texts(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """(stem, content): each text file whole."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "stem string, content string")
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder, wholetext=True)
    found = _with_empty(found.select("value", F.col("_metadata.file_path").alias("path")), F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))))
    return found.select(F.regexp_replace(_name(F.col("path")), r"\.[^.]*$", "").alias("stem"), F.coalesce("value", F.lit("")).alias("content"))


def lines(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """(stem, block, seq, line): the lines of text files, which many tasks read by ranges of bytes. block and seq, the start of a line's range and a number that grows within it, are
    its place in the file."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "stem string, block long, seq long, line string")
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder)
    stem = F.regexp_replace(_name(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))), r"\.[^.]*$", "")
    return found.select(stem.alias("stem"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))


def json_rows(spark: SparkSession, path: str, schema: StructType | str, many_lines: bool = False) -> DataFrame:
    """Records of JSON lines, or of files that hold one array or object each; malformed ones are left out."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", many_lines).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(path)


def json_entries(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(key, value...) of files that hold one object whose values have this schema. A file is one row until it is exploded."""
    if not exists(spark, path):
        return spark.createDataFrame([], StructType([StructField("key", StringType()), *schema.fields]))
    whole = spark.read.text(path, wholetext=True)
    entries = whole.select(F.explode(F.from_json("value", MapType(StringType(), schema))).alias("key", "entry"))
    return entries.select("key", "entry.*")


def captions(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Records of one JSON file each: no index files, no malformed ones, no decorative images; caption_file is the file's name."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema).withColumn("caption_file", F.lit(None).cast("string"))
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    rows = read.withColumn("caption_file", _name(F.col("_metadata.file_path"))).filter("caption_file <> 'index.json'")
    return rows.filter(~F.coalesce("is_decorative", F.lit(False))) if "is_decorative" in rows.columns else rows


def _replaced(spark: SparkSession, new: str, path: str) -> None:
    """Puts a finished folder in the place of another: what was there is moved aside first and deleted last."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old, to, source = hadoop.Path(f"{path}.old"), hadoop.Path(path), hadoop.Path(new)
    files = to.getFileSystem(conf)
    files.delete(old, True)
    if files.exists(to):
        files.rename(to, old)
    if not files.rename(source, to):
        files.rename(old, to)
        raise OSError(f"{new} could not be moved to {path}")
    files.delete(old, True)


def replaced(df: DataFrame, path: str, kind: str = "parquet", by: list[str] | None = None) -> None:
    """Writes df in place of a folder that it may have been read from. The job writes beside it; readers see the old files or the new ones, but for the
    moment of two renames."""
    new = f"{path}.new"
    df.write.mode("overwrite").partitionBy(*(by or [])).format(kind).save(new)
    _replaced(df.sparkSession, new, path)


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replaces a folder of JSON lines, split by columns."""
    replaced(df, path, "json", by)


def write_texts(texts: DataFrame, path: str) -> None:
    """texts(stem, content) as one text file each, below a folder for each stem."""
    texts.select("stem", F.col("content").alias("value")).write.mode("overwrite").partitionBy("stem").option("lineSep", "\n").text(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
