"""From delimited tables to one row per attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import fixed
from cairn.operators import quality
from cairn.operators.relational import all_zero, lookup, not_both_zero, yes_no
from cairn.sources import tables
from cairn.sources.delimited import flags_as_int, lower_names, write_delimited


def clean_table(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Drop superseded duplicates of a source table and export flags as 0/1.

    Returns the kept rows and the log of dropped keys.
    """
    keys, compare = fixed.DUPLICATE_KEYS[name]
    df = lower_names(df)
    kept, dropped = quality.split_latest(df, keys, compare)
    return flags_as_int(kept), dropped


def ingest(sources: dict[str, DataFrame], out_folder: str) -> dict[str, int]:
    """Clean the source tables and write each as delimited text. Returns rows written."""
    return {name: write_delimited(clean_table(df, name)[0], f"{out_folder}/{name}", "overwrite")[1]
            for name, df in sources.items()}


def expeditions(expedition: DataFrame, peak: DataFrame, season: DataFrame) -> DataFrame:
    """Undisputed expeditions with a reliable hired count, their peak and their season."""
    joined = lookup(expedition, peak, {"peakid": "peak_id"},
                    {"p_himal": "himal", "p_height": "height"}, required=True)
    joined = lookup(joined, season, {"season": "season"}, {"seasonname": "seasonname"})
    return (joined.where(all_zero("claimed", "disputed", "o2unkwn")
                         & not_both_zero("nohired", "tothired"))
            .select(F.col("expid").alias("expedition_id"), F.col("peakid").alias("peak_id"),
                    F.col("year").alias("expedition_year"), F.col("seasonname").alias("season"),
                    F.col("p_himal").alias("himal"), F.col("p_height").alias("height"),
                    yes_no(F.col("comrte") == 1).alias("commercial_route"),
                    F.col("totmembers").alias("total_members"),
                    F.col("tothired").alias("total_hired")))


def members(member: DataFrame) -> DataFrame:
    """Undisputed members who were not hired, and whether they reached the top."""
    return (member.where(all_zero("hired", "sherpa", "tibetan", "mclaimed", "mdisputed"))
            .select(F.col("expid").alias("expedition_id"), F.col("membid").alias("member_id"),
                    "sex", F.col("calcage").alias("age"),
                    yes_no(F.col("mo2used") == 1).alias("o2_used"),
                    yes_no(F.col("msmtterm") == 1).alias("successful_summit")))


def attempts(expedition_view: DataFrame, member_view: DataFrame) -> DataFrame:
    """One row per member of an expedition. Both facts are large; their key spreads the join."""
    return (expedition_view.join(member_view, "expedition_id")
            .select("expedition_id", "member_id", "expedition_year", "season", "himal", "peak_id",
                    "height", "commercial_route", "total_members", "total_hired", "sex", "age",
                    "o2_used", "successful_summit"))


def create_model_views(spark: SparkSession) -> list[str]:
    """(Re)create the three model views over the registered tables."""
    t = spark.table
    return tables.create_views({
        "model_expedition": lambda: expeditions(t("hdb_expedition"), t("ref_peak"),
                                                t("hdb_season")),
        "model_member": lambda: members(t("hdb_member")),
        "model_base": lambda: attempts(t("model_expedition"), t("model_member")),
    })


def load_warehouse(spark: SparkSession, text_paths: dict[str, str], out_folder: str,
                   multiline: bool | None = None) -> dict[str, int]:
    """Create every table, load the given text files and define the views."""
    tables.create_empty(spark, out_folder)
    counts = tables.load_catalogue(spark, text_paths, out_folder, multiline=multiline)
    create_model_views(spark)
    return counts


def training_rows(spark: SparkSession, first_year: int = fixed.FIRST_MODEL_YEAR) -> DataFrame:
    return tables.rows_since(spark.table("model_base"), "expedition_year", first_year)
