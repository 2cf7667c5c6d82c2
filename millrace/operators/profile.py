"""What kind of JSON each input file holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.json_text import is_json, strip_space
from millrace.scratch import stage
from millrace.sources.text import read_documents, read_lines


def profile_lines(lines: DataFrame, with_schema: bool = True) -> DataFrame:
    """Per file: line, blank and valid-line counts, layout flags, first object, joint schema.

    Counts cover all lines. The layout comes from the first character of the
    file that is not white space. Grouping by file is combined on the map side,
    so one huge file costs no more than many small ones.
    """
    place = F.struct(F.col("block"), F.col("_row"))
    text = F.col("_text")
    judged = lines.select(
        "file",
        "block",
        strip_space(F.col("value")).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    ).select("file", "block", "_row", "_text", is_json(text).alias("_valid"))
    is_object = F.col("_valid") & text.startswith("{")
    measures = [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(text == "").alias("blank_lines"),
        F.count_if("_valid").alias("valid_lines"),
        F.min_by(F.when(text != "", text.substr(1, 1)), F.when(text != "", place)).alias("_head"),
        F.min_by(F.when(is_object, text), F.when(is_object, place)).alias("sample"),
    ]
    if with_schema:
        objects = F.try_parse_json(F.when(is_object, text))
        measures.append(F.schema_of_variant_agg(objects).alias("sample_schema"))
    per_file = judged.groupBy("file").agg(*measures)
    head = F.coalesce(F.col("_head"), F.lit(""))
    full_lines = F.col("lines") - F.col("blank_lines")
    return per_file.withColumns(
        {
            # Lines that are all valid by themselves are records, also if each is an array; a
            # single line that is an array is a document.
            "is_array": (head == "[")
            & ((F.col("valid_lines") < full_lines) | (full_lines == 1)),
            "is_line_delimited": (head == "{")
            | ((head == "[") & (full_lines > 1) & (F.col("valid_lines") == full_lines)),
        }
    ).drop("_head")


def json_profile(spark: SparkSession, paths, with_schema: bool = True) -> DataFrame:
    """:func:`profile_lines` plus ``is_valid``.

    A file of lines is valid if any line is. A file that starts as an array is
    valid if the whole document is; those that are not one valid line are read again
    whole. Only their names pass through the driver, as they do in any file listing.
    """
    per_file = stage(profile_lines(read_lines(spark, paths), with_schema), "profile")
    judged = F.col("valid_lines") > 0  # one valid line that is the whole file
    unsure = per_file.where(F.col("is_array") & ~judged).select("file")
    arrays = [r["file"] for r in unsure.toLocalIterator()]
    if not arrays:
        return per_file.withColumn("is_valid", F.col("valid_lines") > 0)
    whole = read_documents(spark, arrays).select(
        "file", is_json(strip_space(F.col("value"))).alias("_whole")
    )
    return (
        per_file.join(whole, "file", "left")
        .withColumn("is_valid", F.coalesce(F.col("_whole"), F.col("valid_lines") > 0))
        .drop("_whole")
    )
