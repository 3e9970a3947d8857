"""JSON, log and portable-page sources. Schemas are declared and malformed input fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from chainfold.functions import scalars as X

MAX_LINE_BYTES = 1_024
PAGE_FIELDS = ["address", "page", "slot", "value"]


def json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document per file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines: time series, growth records, exported accounts."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def complete_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a log still being written: an unfinished line is left out."""
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("r"), "value")
    whole = F.col("value").rlike(r"^\{.*\}\s*$")
    return lines.where(whole & F.col("r").isNotNull()).select("r.*")


def append_rows(rows: DataFrame, path: str) -> None:
    """Append observation records."""
    rows.write.mode("append").json(path)


# ---------------------------------------------------------------- run logs

# The three line shapes and the keys kept of each.
LINE_SHAPES = {
    "session": ("session initialized with remote endpoint",
                "max_parallel_workers bigint, linear_handoff_block bigint, resolved_start_block bigint, trace_id string"),
    "setting": ("sink settings",
                "decode_workers bigint, decode_batch_size bigint, spool_max_idle string, spool_max_size bigint, "
                "db_write_target_duration string, db_write_max_size bigint"),
    "progress": ("stream stats",
                 "progress_running_jobs map<string,bigint>, progress_total_processed_blocks bigint, is_live boolean, "
                 "last_block string, data_msg_rate string, undo_msg_rate string"),
}


def log_lines(lines: DataFrame, shape: str, column: str = "value") -> DataFrame:
    """Lines of one shape: timestamp from the prefix, declared keys from the JSON tail.

    A key the line does not carry stays NULL; an unreadable tail is an error.
    """
    marker, schema = LINE_SHAPES[shape]
    cut = F.instr(column, " {")
    prefix, payload = F.substring(F.col(column), F.lit(1), cut - 1), F.expr(f"substring({column}, instr({column}, ' {{') + 1)")
    first = {name: F.instr(prefix, text) > 0 for name, (text, _) in LINE_SHAPES.items()}
    mine = first[shape]
    for other in LINE_SHAPES:               # the order of the shapes decides a line that names two
        if other == shape:
            break
        mine = mine & ~first[other]
    split = lines.where((cut > 0) & mine).select(
        F.element_at(F.split(F.trim(prefix), r"\s+"), 1).alias("timestamp"), payload.alias("payload"))
    parsed = split.select("timestamp", F.from_json("payload", schema, {"mode": "FAILFAST"}).alias("r"))
    rows = parsed.select("timestamp", "r.*")
    return rows.drop("timestamp") if shape == "setting" else rows


def read_log(spark: SparkSession, path: str, shape: str) -> DataFrame:
    return log_lines(spark.read.text(path), shape)


# ---------------------------------------------------------------- portable pages

def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw page lines with the page number they hold (NULL if none can be read) and the file they came from."""
    return spark.read.text(path).select(F.expr("try_cast(get_json_object(value, '$.page') AS bigint)").alias("page"),
                                        F.col("_metadata.file_name").alias("file"), "value")


def page_problem() -> Column:
    """Why a page line is not a storage row, or NULL."""
    fields = F.from_json("value", "map<string,string>")
    keys = F.array_sort(F.map_keys(fields))
    return (F.when(F.octet_length("value") > MAX_LINE_BYTES, "oversized row")
            .when(fields.isNull() | (keys != F.array(*[F.lit(n) for n in PAGE_FIELDS])), "unexpected fields")
            .when(~fields["page"].rlike("^(0|[1-9][0-9]{0,17})$"), "malformed page number")
            .when(~X.is_fixed_hex(fields["slot"], 32) | ~X.is_fixed_hex(fields["value"], 32), "malformed word"))


def page_rows(lines: DataFrame) -> DataFrame:
    return lines.select("page", "file", F.from_json("value", "address string, slot string, value string").alias("r")
                        ).select("page", "file", "r.*")


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """Length and sha256 of every page file of a folder. A file holds a bounded number of pages, so it fits a task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"),
                        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
