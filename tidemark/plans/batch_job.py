"""The batch job: cut to size, clean, analyse, save. Each step reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_to_timestamp, parse_integer
from tidemark.operators import analysis, validate
from tidemark.operators.clean import CORRUPT, clean_ratings
from tidemark.operators.prefix import text_file_prefix
from tidemark.sinks.files import write_parquet
from tidemark.sources.files import csv_lines, read_csv_text, read_table, records_as_text
from tidemark.sources.records import csv_records
from tidemark.workspace import shared_table

# Columns of the item file.
MOVIE_COLUMNS = ("movieId", "title", "genres")


def analyses(
    ratings: DataFrame, movies: DataFrame, top: int = 10, scale: int | None = None, min_count: int = 1
) -> dict[str, DataFrame]:
    """Results by name, from typed ratings and the items they rate.

    ``scale`` is the number of decimals of the ratings, if it is fixed: means are
    then exact, whatever the order in which rows arrive. The ratings are scanned six times: once for
    the histogram, for the sums per movie, and for those per hour, and three times for users.
    """
    timed = ratings.withColumn("ts", epoch_to_timestamp("timestamp"))
    per_movie = shared_table(analysis.totals(ratings, "movieId", "rating", scale), "movie-totals")
    per_hour = shared_table(analysis.hourly_totals(timed, "ts", "rating", scale), "hour-totals")
    movie_stats = analysis.stats_of_totals(per_movie, "movieId", "rating", scale)
    return {
        "rating_histogram": analysis.value_histogram(ratings, "rating"),
        "movie_stats": movie_stats,
        "top_movies": analysis.top_of_stats(movie_stats, "movieId", "rating", top, min_count),
        "genre_stats": analysis.category_stats_of_totals(
            per_movie, movies, "movieId", categories="genres", scale=scale
        ),
        "month_stats": analysis.months_of_totals(per_hour, "ts", scale),
        "hour_stats": analysis.hours_of_totals(per_hour, "ts", scale),
        "user_stats": analysis.user_behaviour(
            timed, "userId", "movieId", value="rating", ts="ts", scale=scale
        ),
    }


def checked_movies(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Items with typed ids and the reason why a row is rejected: ``arity`` or ``type``."""
    rows = read_csv_text(spark, path, MOVIE_COLUMNS, multi_line).select(
        parse_integer("movieId").alias("movieId"), "title", "genres", CORRUPT
    )
    rules = [("arity", F.col(CORRUPT).isNull()), ("type", F.col("movieId").isNotNull())]
    return validate.with_reject_reason(rows, rules)


def run_batch(
    spark: SparkSession,
    ratings_csv: str,
    movies_csv: str,
    output: str,
    budget: int | None = None,
    scale: int | None = None,
    top: int = 10,
    min_count: int = 1,
    multi_line: bool = False,
) -> dict[str, int]:
    """Run all steps and save each result as Parquet under ``output``; returns the cleaner's counters.

    Only ``*.csv`` of a folder are read, the first line of each is its header, and blank lines are
    counted as rejects. With ``budget`` only the leading bytes of each ratings file are used.
    ``multi_line`` allows line breaks in quoted fields; a budget that ends inside one cuts its record
    there. ``skipped_items`` counts rejected items.
    """
    if budget is None:
        rows = read_csv_text(spark, ratings_csv, multi_line=multi_line, blank_lines=True)
    else:
        kept = text_file_prefix(spark, ratings_csv, budget, glob="*.csv")
        if multi_line:
            rows = records_as_text(csv_records(kept.drop("is_header")), blank_lines=True)
        else:
            rows = csv_lines(kept.filter(~F.col("is_header")).select("line"))
    cleaned = clean_ratings(rows)
    counters = cleaned.write_valid(f"{output}/ratings")
    ratings = read_table(spark, f"{output}/ratings", "parquet", cleaned.valid.schema)
    checked = shared_table(checked_movies(spark, movies_csv, multi_line), "movies")
    counters["skipped_items"] = validate.rejected_rows(checked).count()
    movies = validate.valid_rows(checked).drop(CORRUPT)
    for name, result in analyses(ratings, movies, top, scale, min_count).items():
        write_parquet(result, f"{output}/{name}")
    return counters
