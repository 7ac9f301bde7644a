import os

import pytest

from cardfold import session
from cardfold.operators.extract import extract_detail
from cardfold.sources.snapshot import page_snapshot, resolve_attempts


def test_saved_pages_form_a_snapshot(spark, tmp_path):
    (tmp_path / "a.html").write_text("<h1>A\n one</h1>", encoding="utf-8")
    (tmp_path / "b.html").write_text("<h1>B</h1>", encoding="utf-8")
    pages = page_snapshot(spark, str(tmp_path), "html")
    assert pages.columns == [
        "url", "attempt", "fetched_at", "status_code", "error_type", "error_message", "html"]
    got = {os.path.basename(r.url): r.description for r in extract_detail(pages, "h1").collect()}
    assert got == {"a.html": "A one", "b.html": "B"}


def test_parquet_snapshot_keeps_errors(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame(
        [("u", 1, "Timeout", None), ("u", 2, None, "<p>")],
        "url string, attempt int, error_type string, html string",
    ).write.parquet(path)
    (row,) = resolve_attempts(page_snapshot(spark, path)).collect()
    assert (row.attempt, row.html) == (2, "<p>")
    with pytest.raises(ValueError):
        resolve_attempts(page_snapshot(spark, path), 0)


def test_a_hot_url_is_cut_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(1000).selectExpr(
        "'u' AS url", "CAST(id % 3 + 1 AS INT) AS attempt", "'E' AS error_type", "'' AS html"
    ).write.parquet(path)
    plan = resolve_attempts(page_snapshot(spark, path))._jdf.queryExecution().toString()
    assert "row_number(), 3, Partial" in plan


def test_materialize_uses_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(f"{folder}/cardfold/x-")
    table = session.materialize(spark.range(3), "t")
    assert sorted(r.id for r in table.collect()) == [0, 1, 2]
    assert all(folder in name for name in table.inputFiles())
