from __future__ import annotations

import json

import pytest
from conftest import rows

from skillweave.plans.stages import run_stage
from skillweave.sources.readers import read_embeddings, read_jobs, read_profiles, write_embeddings
from skillweave.sources.writers import read_table, write_summary, write_table


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "Resume.csv"
    path.write_text('ID,Resume_str,Category\n1,"two\nlines, and ""quotes""",HR\n2,,IT\n')
    assert rows(read_profiles(spark, str(path))) == [("1", 'two\nlines, and "quotes"', "HR"), ("2", None, "IT")]
    assert read_jobs(spark, str(tmp_path / "none.csv")) is None


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, ["a"])], "id int, items array<string>"), path)
    write_table(read_table(spark, path).union(spark.createDataFrame([(2, ["b"])], "id int, items array<string>")), path)
    assert rows(read_table(spark, path)) == [(1, ["a"]), (2, ["b"])]
    (tmp_path / "t" / "version=2").mkdir()  # a write that never finished
    assert read_table(spark, path).count() == 2
    write_table(read_table(spark, path), path + "_csv", "csv")
    assert rows(read_table(spark, path + "_csv", "csv")) == [("1", '["a"]'), ("2", '["b"]')]
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "missing"))


def test_summary_goes_to_variant_and_latest(spark, tmp_path):
    df = spark.createDataFrame([(10, {8: 0.1})], "best_k int, silhouette_by_k map<int,double>")
    write_summary(df, str(tmp_path / "s"), "norm_pca64")
    assert read_table(spark, str(tmp_path / "s" / "latest"), "json").first()["best_k"] == 10
    file = next((tmp_path / "s" / "variant=norm_pca64" / "version=0").glob("part-*.json"))
    assert json.loads(file.read_text())["silhouette_by_k"] == {"8": 0.1}


def test_embeddings_keep_their_key(spark, tmp_path):
    df = spark.createDataFrame([("x", [0.5, 1.5])], "ID string, embedding array<double>")
    write_embeddings(df, str(tmp_path / "e"))
    assert rows(read_embeddings(spark, str(tmp_path / "e"))) == [("x", [0.5, 1.5])]


def test_embeddings_replace_the_table_they_come_from(spark, tmp_path):
    path = str(tmp_path / "e")
    write_embeddings(spark.createDataFrame([("x", [0.5])], "ID string, embedding array<double>"), path)
    write_embeddings(read_embeddings(spark, path).unionByName(spark.createDataFrame([("y", [2.0])], "ID string, embedding array<float>")), path)
    assert rows(read_embeddings(spark, path)) == [("x", [0.5]), ("y", [2.0])]
    spark.createDataFrame([("z", [1.0])], "ID string, embedding array<float>").write.parquet(str(tmp_path / "plain"))
    assert rows(read_embeddings(spark, str(tmp_path / "plain"))) == [("z", [1.0])]


@pytest.fixture(scope="module")
def raw(spark):
    topics = {"HR": "recruiting payroll interviews", "IT": "python java cloud servers", "CHEF": "cooking menus kitchens"}
    resumes = [(i, f"<p>Experienced in {list(topics.values())[i % 3]} and number {i}</p>", list(topics)[i % 3]) for i in range(60)]
    jobs = [(1, "Java developer", "python, cloud", "servers"), (2, "Head of kitchen", "cooking menus", None), (3, "unrelated", None, None)]
    return {
        "resumes": spark.createDataFrame(resumes, "ID int, Resume_str string, Category string"),
        "jobs": spark.createDataFrame(jobs, "JobID int, Title string, Skills string, Responsibilities string"),
    }


def test_all_stages(spark, raw):
    first = run_stage("week1", raw, skills={"dim": 16})
    assert first["clean_resumes"].count() == 60 and first["skill_lists"].count() == 60 and first["embeddings"].count() == 60
    assert tuple(first["recovered"].first()) == (60, 60) and tuple(first["cache_status"].first()) == (60, 0, 0, 60)
    again = run_stage("skills", {**first})
    assert again["recovered"].first()["processed"] == 0 and again["skill_lists"].count() == 60
    second = run_stage(
        "week2", first, cluster={"k_min": 2, "k_max": 3, "n_init": 2}, classify={"trees": 5, "max_depth": 4, "max_iter": 5}, match={"top_k": 5}
    )
    assert second["cluster_assignments"].count() == 60
    assert second["clustering_summary"].count() == 1
    assert second["skill_item_matrix_meta"].first()["n_transactions"] == 60
    assert second["association_rules"].count() > 0
    assert second["classification_comparison"].count() == 6
    top = {r["JobID"]: r for r in second["matching_topk"].collect()}
    assert len(top) == 3 and all(len(r["ranked_resume_ids"]) == 5 for r in top.values())
    assert top["3"]["category_rerank_applied"] is False
    assert {r["k"] for r in second["matching_precision_at_k"].collect()} == {5, 10}


def test_responses_feed_the_skill_stage(spark, raw):
    clean = run_stage("preprocess", {"resumes": raw["resumes"]}, sample_size=2)
    answers = spark.createDataFrame([("0", '{"technical": ["Payroll"], "soft": []}'), ("1", "sorry")], "ID string, response string")
    out = run_stage("skills", {**clean, "responses": answers}, dim=8)
    got = {r["ID"]: r["technical"] for r in out["skill_lists"].collect()}
    assert got["0"] == ["payroll"] and "excel" in got["1"]
    assert tuple(out["recovered"].first()) == (2, 1)
    only = run_stage("skills", {**clean, "skill_lists": out["skill_lists"]}, skip_extraction=True, dim=8)
    assert "recovered" not in only and only["embeddings"].count() == 2


def test_matching_without_jobs_and_unknown_stage(spark, raw):
    assert run_stage("match", {"clean_resumes": raw["resumes"], "embeddings": raw["resumes"]}) == {}
    with pytest.raises(ValueError):
        run_stage("nothing", {})
