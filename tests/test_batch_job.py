import random

import pytest

from tidemark.plans.batch_job import analyses, run_batch
from tidemark.sources import read_table

RESULTS = {
    "ratings",
    "rating_histogram",
    "movie_stats",
    "top_movies",
    "genre_stats",
    "month_stats",
    "hour_stats",
    "user_stats",
}


@pytest.fixture
def inputs(tmp_path):
    random.seed(17)
    for name in ("ratings", "movies"):
        (tmp_path / name).mkdir()
    lines = ["userId,movieId,rating,timestamp"]
    for _ in range(400):
        rating = random.choice(["3.0", "4.0", "5", "9.0", "x"])
        lines.append(f"{random.randrange(9)},{random.choice([1, 1, 2, 3])},{rating},964980868")
    (tmp_path / "ratings" / "ratings.csv").write_text("\n".join(lines) + "\n")
    movies = 'movieId,title,genres\n1,"Some, thing (1990)",Drama|War\n2,B (1991),War\nx,C (1992),War\n'
    (tmp_path / "movies" / "movies.csv").write_text(movies)
    return tmp_path, lines


def _clean(lines):
    rows = [line.split(",") for line in lines[1:]]
    return [(int(u), int(m), float(r)) for u, m, r, _ in rows if r not in ("9.0", "x")]


@pytest.mark.parametrize("budget", [None, 10**6, 2_000])
def test_all_steps(spark, inputs, budget, records):
    folder, lines = inputs
    if budget:
        spent, used = 0, []
        for line in lines:
            spent += len(line) + 1
            if spent > budget:
                break
            used.append(line)
        lines = used
    out = folder / "out"
    args = (spark, str(folder / "ratings"), str(folder / "movies"), str(out), budget)
    counters = run_batch(*args)
    valid = _clean(lines)
    assert counters == {
        "total_rows": len(lines) - 1,
        "valid_rows": len(valid),
        "skipped_rows": len(lines) - 1 - len(valid),
        "skipped_items": 1,
    }
    assert {p.name for p in out.iterdir()} == RESULTS
    genres = read_table(spark, f"{out}/genre_stats", "parquet")
    drama = [r for _, m, r in valid if m == 1]
    war = [r for _, m, r in valid if m in (1, 2)]
    assert records(genres, "category", "row_count", "item_count") == [
        ("Drama", len(drama), 1),
        ("War", len(war), 2),
    ]
    top = read_table(spark, f"{out}/top_movies", "parquet").orderBy("avg_rating").collect()
    assert {r.movieId for r in top} == {m for _, m, _ in valid}
    if budget is None:
        assert run_batch(*args) == counters  # a second run replaces the first
        assert read_table(spark, f"{out}/ratings", "parquet").count() == len(valid)


@pytest.mark.parametrize("budget", [None, 10**9])
def test_blank_lines_and_other_files(spark, inputs, budget):
    """Empty files and files of another kind add nothing; blank lines are rejects."""
    folder, _ = inputs
    ratings = folder / "mixed"
    ratings.mkdir()
    (ratings / "a.csv").write_text("userId,movieId,rating,timestamp\n1,1,4.0,964980868\n\n  \n2,1,3.0,964980868")
    (ratings / "empty.csv").write_text("")
    (ratings / "notes.txt").write_text("a\n3,1,4.0,964980868\n")
    counters = run_batch(spark, str(ratings), str(folder / "movies"), str(folder / "out"), budget)
    assert counters == {"total_rows": 4, "valid_rows": 2, "skipped_rows": 2, "skipped_items": 1}


def test_line_breaks_in_quoted_fields(spark, inputs):
    folder, _ = inputs
    ratings = folder / "quoted"
    ratings.mkdir()
    (ratings / "a.csv").write_text('userId,movieId,rating,timestamp\n1,1,"4.0\n",964980868\n2,1,3.0,964980868\n')
    args = (spark, str(ratings), str(folder / "movies"), str(folder / "out"))
    assert run_batch(*args, multi_line=True)["total_rows"] == 2
    assert run_batch(*args)["total_rows"] == 3
    # Blank lines count, and a budget may end inside a field: its record ends there.
    text = 'userId,movieId,rating,timestamp\n\n1,1,"4.0\n",964980868\n2,1,3.0,964980868\n'
    (ratings / "a.csv").write_text(text)
    assert run_batch(*args, multi_line=True)["total_rows"] == 3
    cut = text.index('",')
    counters = run_batch(*args, budget=cut, multi_line=True)
    assert counters == {"total_rows": 2, "valid_rows": 0, "skipped_rows": 2, "skipped_items": 1}


def test_ratings_are_scanned_six_times(spark, tmp_path):
    schema = "userId bigint, movieId bigint, rating double, timestamp bigint"
    spark.createDataFrame([(1, 1, 4.0, 964980868)], schema).write.parquet(str(tmp_path / "r"))
    movies = spark.createDataFrame([(1, "A", "War")], "movieId bigint, title string, genres string")
    results = analyses(spark.read.parquet(str(tmp_path / "r")), movies)
    scans = 0
    for df in results.values():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        scans += sum("FileScan" in line and f"{tmp_path}/r" in line for line in final.splitlines())
    assert scans + 2 <= 6  # two further scans made the tables of totals
