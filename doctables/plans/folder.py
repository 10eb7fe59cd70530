"""Whole folders: Markdown of every file under its output name, what became of each file, and what was found in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doctables.functions import fixed
from doctables.operators import corpus as K
from doctables.plans.convert import word_to_markdown
from doctables.sources import packages as S
from doctables.sources.staging import drop_staged, staged


def file_outcomes(package: DataFrame, part: DataFrame, out_path: Column, wanted: str = "docx") -> DataFrame:
    """What became of each file: (path, out_path, reason); the reason is null for files that are converted.

    Files whose name does not match have no output name and are left out: they were not asked for.
    """
    failed = part.where(F.col("error").isNotNull()).groupBy("path").agg(F.max("error").alias("error"))
    files = package.select("path", "kind", "length").join(failed, "path", "left")
    reason = S.classify_input("length", "error", "kind", wanted)
    return files.select("path", out_path.alias("out_path"), reason.alias("reason")).where(F.col("out_path").isNotNull())


def folder_texts(
    package: DataFrame, part: DataFrame, outcomes: DataFrame, headers: dict[str, str] | None = None, now: Column | None = None
) -> DataFrame:
    """Markdown of the files that are converted: (path, out_path, part, text), part 0 the header if there is one.

    Given headers come first and replace the property of the same name. Where several files get the same output name the
    last path counts, as a later file is written over an earlier one.
    """
    good = outcomes.where(F.col("reason").isNull())
    wins = staged(good.groupBy("out_path").agg(F.max("path").alias("path")), "chosen")
    chosen = part.join(wins.select("path"), "path", "left_semi")
    body = word_to_markdown(chosen, now, files=package.select("path", "length"))
    nothing = F.lit(None).cast("string")
    every = wins.select("path", nothing.alias("name"), nothing.alias("value"))  # given headers stand in files without properties, too
    head = K.header_text(K.inject_headers(S.read_props(S.readable(chosen)).unionByName(every), headers or {}))
    return head.unionByName(body).join(wins, "path").select("path", "out_path", "part", "text")


def convert_folder(
    spark: SparkSession, folder: str, target: str, pattern: str = "*.docx", out: str | None = None, recursive: bool = False,
    headers: dict[str, str] | None = None, now: Column | None = None,
) -> DataFrame:
    """Convert the Word files of a folder; gives (converted, failed, message).

    ``pattern`` is a file name in which ``*`` stands for any text, ``out`` is read as in target_path. Below ``target`` lie
    ``texts`` (path, out_path, part, text) and ``outcomes`` (path, out_path, reason), written over by the next call. Outcomes
    are written last, so a call that broke off leaves none of its own. Opened parts are removed at the end.
    """
    if out is not None and not out.endswith("/") and "*" in out and out.count("*") != pattern.count("*"):
        raise ValueError("number of wildcards does not match")
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    package = S.scan_packages(spark, folder, "*", recursive)
    package = package.where(K.base_name("path").rlike(K.wildcard_pattern(pattern)))
    part = staged(S.unpack(package.where(F.col("kind") == "docx")), "parts")
    outcomes = file_outcomes(package.drop("content"), part, K.target_path("path", root, pattern, out))
    folder_texts(package.drop("content"), part, outcomes, headers, now).write.mode("overwrite").parquet(f"{target}/texts")
    outcomes.write.mode("overwrite").parquet(f"{target}/outcomes")
    drop_staged(part)
    return summary(spark.read.parquet(f"{target}/outcomes"))


def summary(outcomes: DataFrame) -> DataFrame:
    """How many files were converted and how many not, with the message: one row, for no files, too."""
    return K.outcome(outcomes, F.col("reason").isNull(), [])


# --- censuses over files ------------------------------------------------------------------------

# fixed values: texts in the order in which equal languages are decided
_TEXT_ORDER = ["officeDocument", "officeDocument/footnotes", "officeDocument/endnotes"]


def file_census(tags: DataFrame) -> DataFrame:
    """Elements without a rule in Word texts and sheets, from read_tags: (path, element, n)."""
    handled = {"docx": fixed.HANDLED_WORD, "xlsx": fixed.HANDLED_SHEET}
    return K.unhandled_census(tags, handled, {"docx": fixed.WORD_NS, "xlsx": fixed.SHEET_NS}, "n")


def file_languages(tags: DataFrame, prop: DataFrame) -> DataFrame:
    """Language of Word files: the property, else the language most often tagged in any text: (path, language)."""
    order = F.array_position(F.array(*[F.lit(r) for r in _TEXT_ORDER]), F.col("role"))
    runs = tags.where(F.length("lang") > 0).select("path", F.col("lang").alias("tag"), (order * (1 << 48) + F.col("first")).alias("pos"), "n")
    return K.doc_language(runs, prop, "n")
