"""Files as tables: listings without reading contents, whole texts, nested JSON and CSV with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """path, name, folder, size, modified_time of every file below root; contents aren't read. Temporary office files are left out."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (r.option("pathGlobFilter", glob) if glob else r).load(root)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    base = F.lit(root.rstrip("/").split(":", 1)[-1].lstrip("/"))
    at = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", ""), F.concat(F.lit("^\\Q"), base, F.lit("\\E/?")), F.lit(""))
    return df.select("path", name.alias("name"), F.regexp_replace(at, "/?[^/]*$", "").alias("folder"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_time")).where(~F.col("name").startswith("~$"))


def with_extension(files: DataFrame, *extensions: str) -> DataFrame:
    return files.where(F.lower(F.regexp_extract("name", r"(\.\w+)$", 1)).isin(*extensions))


def read_text_docs(spark: SparkSession, root: str, heading: str = r"(?m)^## Slide \d+") -> DataFrame:
    """Whole text files: path, text, char_count, slide_count (lines that open a slide), preview."""
    df = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(root)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.length("value").alias("char_count"), F.regexp_count("value", F.lit(heading)).alias("slide_count"), F.substring("value", 1, 1000).alias("preview"))


def read_json(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """Multi-line JSON files under a declared schema; unreadable files give a row with __corrupt set."""
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType([*schema.fields])
    return spark.read.schema(s.add("__corrupt", "string")).option("multiLine", True).option("columnNameOfCorruptRecord", "__corrupt").option("mode", "PERMISSIVE").json(root)


def exploded(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """A row for each element of an array of structs; empty arrays give none."""
    return df.select(*keep, F.explode(array).alias("__x")).select(*keep, "__x.*")


def first_known(values: list[Column]) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values])


def union_formats(new: DataFrame, legacy: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both formats, missing columns null; where keys repeat, the new format's first row stays."""
    from ..operators.dedup import first_wins

    both = new.withColumn("__old", F.lit(0)).unionByName(legacy.withColumn("__old", F.lit(1)), allowMissingColumns=True)
    return first_wins(both, keys, ["__old"]).drop("__old")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows of its schema where it doesn't exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, path: str, schema: str, **keys) -> DataFrame:
    """The rows of an earlier output that have the given keys; a table parted by a key is pruned, and a missing one has no rows."""
    df = read_or_empty(spark, path, schema)
    for k, v in keys.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def read_map(spark: SparkSession, root: str, value: str, name: str = "name") -> DataFrame:
    """Files that hold one JSON object of names to structs: a row for each name (transcripts, metadata); unreadable files and null values give none."""
    text = spark.read.format("text").option("wholetext", "true").load(root)
    return text.select(F.explode(F.from_json("value", f"map<string,struct<{value}>>")).alias(name, "x")).where("x is not null").select(name, "x.*")


def read_annotations(spark: SparkSession, root: str, result: str, key: Column, fallback: Column) -> DataFrame:
    """JSON files of batches with results: a row for each result, its key from the batch's name, else from its source. result: fields of a result, among them source."""
    b = read_json(spark, root, f"batches array<struct<batch:string,results:array<struct<{result}>>>>")
    rows = b.select(F.explode("batches").alias("b")).select(F.col("b.batch").alias("batch"), F.explode("b.results").alias("r")).select("batch", "r.*")
    return rows.withColumn("key", F.coalesce(key, fallback))


def ids_in_csv(spark: SparkSession, path: str, schema: str, column: str, id_name: str) -> DataFrame:
    """The distinct ids that the JSON payloads of a CSV column name; the payloads needn't be valid as a whole."""
    found = F.regexp_extract_all(column, F.lit(rf'"{id_name}":\s*(\d+)'), F.lit(1))
    return read_csv(spark, path, schema).select(F.explode(F.transform(found, lambda x: x.cast("long"))).alias(id_name)).distinct()


def media_files(files: DataFrame, key: Column, *extensions: str) -> DataFrame:
    """Files of the given extensions with their size and the key that their path names."""
    return with_extension(files, *extensions).select("path", "name", "size", key.alias("key"))


def invalid_texts(spark: SparkSession, root: str) -> DataFrame:
    """path and whether a file is valid UTF-8, has a byte-order mark, a NUL byte, and a size within 1 KB and 50 MB."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return df.select("path", F.is_valid_utf8(F.col("content").cast("string")).alias("utf8"), F.startswith(F.col("content"), F.unhex(F.lit("EFBBBF"))).alias("bom"), F.contains(F.col("content"), F.unhex(F.lit("00"))).alias("nul"), F.col("length").between(1024, 50 << 20).alias("size_ok"))
