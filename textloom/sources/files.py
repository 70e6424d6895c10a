"""File sources and sinks: CSV, JSON arrays, Q/A text, saved vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The table shapes the readers are used with.
PAPERS = "titles string, summaries string, terms string"
TICKETS = "Description string, Resolution string, Flavors array<string>, Resolution_Flavor string, Team string"
TICKETS_CATEGORY = "Description string, Category string, Resolution string"
LABELLED = "description string, labels string"
FAQ = "question string, answer string"
FAQ_RAW = "question string, answer string, found_duplicate boolean"
VOCABULARY = "token string, n bigint, token_id bigint"

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False) -> DataFrame:
    """The columns of ``schema``, found by their names in the header; other columns are left out.

    An empty field is missing; lines may end in LF or CRLF. ``multi_line`` is for texts with line breaks of their own: such a file is
    read by one task, any other is split.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    raw = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(path)
    missing = [f.name for f in wanted if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header has {', '.join(raw.columns)}")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header="true", quote='"', escape='"', quoteAll="true").csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files holding one JSON array of objects each, one row per object; empty entries of an array are left out."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = spark.read.schema(wanted).option("multiLine", "true").json(path)
    return rows.dropna("all", subset=wanted.names)


def write_json_arrays(df: DataFrame, path: str, *chunk: str) -> None:
    """One JSON array of objects per line, one line per value of the ``chunk`` columns.

    The caller picks the chunk so that an array stays small; its columns are not written.
    """
    objects = F.collect_list(F.struct(*[c for c in df.columns if c not in chunk]))
    arrays = df.groupBy(*chunk).agg(objects.alias("_objects"))
    arrays.select(F.to_json("_objects", {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def write_json_array_files(df: DataFrame, path: str, part: str) -> None:
    """One file per value of ``part``, each one JSON array with an object per line; no array is gathered anywhere.

    The brackets and commas are lines of their own, written by the task that writes the rows.
    """
    objects = df.select(part, F.to_json(F.struct(*[c for c in df.columns if c != part]), {"ignoreNullFields": "false"}).alias("value"))
    lines = objects.select(part, F.lit(1).alias("_n"), F.concat(F.lit(","), "value").alias("value"))
    ends = df.select(part).distinct().select(
        part, F.explode(F.array(F.struct(F.lit(0).alias("_n"), F.lit("[{}").alias("value")), F.struct(F.lit(2).alias("_n"), F.lit("]").alias("value")))).alias("e")
    ).select(part, "e.*")
    ordered = lines.unionByName(ends).repartition(part).sortWithinPartitions(part, "_n")
    ordered.select(part, "value").write.partitionBy(part).text(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One object, or one array of objects, per line: the splittable form for large inputs."""
    return spark.read.schema(schema).json(path)


def as_json_text(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in the column ``value``."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    as_json_text(df).write.text(path)


def write_qa_text(pairs: DataFrame, path: str, question: str = "question", answer: str = "answer") -> None:
    """Question line, answer line, blank line."""
    pairs.select(F.concat_ws("\n", question, answer, F.lit("")).alias("value")).write.text(path)


def save_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.write.parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCABULARY).parquet(path)
