"""The command line jobs, end to end on a small folder."""

import json

import pytest

from fiscalframe.__main__ import main

SLIP = "Məhsulun adı Say Qiymət Cəmi\nSu 1.000 0.50 0.50\nCəmi 0.50\n"


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\nb\nc", encoding="utf-8")
    for part in ("images", "text"):
        (tmp_path / part).mkdir()
    for name in "ab":
        (tmp_path / "images" / f"{name}.jpeg").write_bytes(b"x")
        (tmp_path / "text" / f"{name}.jpeg.txt").write_text(SLIP, encoding="utf-8")
    return tmp_path


def lines(folder):
    return sorted(line for part in folder.glob("part-*") for line in part.read_text(encoding="utf-8").splitlines())


def test_worklist_job(folder):
    main(["worklist", "--ids", f"{folder}/ids.txt", "--images", f"{folder}/images", "--out", f"{folder}/out", "--base-url", "http://x/"])
    assert "c,http://x/c,c.jpeg" in lines(folder / "out")


def test_parse_job(spark, folder):
    main(["parse", "--text", f"{folder}/text", "--format", "text", "--out", f"{folder}/out"])
    assert [x.split(",")[0] for x in lines(folder / "out") if ",Su,1.0,0.5,0.5," in x] == ["a.jpeg", "b.jpeg"]
    main(["parse", "--text", f"{folder}/text", "--format", "text", "--out", f"{folder}/by-date", "--by-date"])
    assert spark.read.parquet(f"{folder}/by-date").count() == 2


def test_parse_new_job(spark, folder):
    args = ["parse-new", "--text", f"{folder}/text", "--format", "text", "--out", f"{folder}/out", "--checkpoint", f"{folder}/state"]
    main(args)
    main(args)
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_requests_and_recover_jobs(spark, folder, capsys):
    main(["requests", "--text", f"{folder}/text", "--format", "text", "--out", f"{folder}/requests"])
    assert {json.loads(x)["filename"] for x in lines(folder / "requests")} == {"a.jpeg", "b.jpeg"}
    answer = json.dumps([{"filename": "a.jpeg", "item_name": "Su", "quantity": 1, "unit_price": 0.5, "line_total": 0.5}])
    answers = spark.createDataFrame([("a.jpeg", 0, answer)], "filename string, attempt int, response string")
    answers.write.parquet(f"{folder}/answers")
    main(["recover", "--text", f"{folder}/text", "--format", "text", "--responses", f"{folder}/answers", "--out", f"{folder}/out"])
    assert any(",Su,1.0,0.50,0.50," in x for x in lines(folder / "out"))
    printed = capsys.readouterr().out
    assert "unique_receipts: 2" in printed and "cost: 0.06" in printed


def test_recover_reads_answers_in_their_own_format(spark, folder, capsys):
    answer = json.dumps([{"item_name": "Su", "quantity": 1, "unit_price": 0.5, "line_total": 0.5}])
    answers = spark.createDataFrame([("a.jpeg", 2, answer)], "filename string, attempt int, response string")
    answers.write.json(f"{folder}/answers")
    args = ["recover", "--text", f"{folder}/text", "--format", "text", "--responses", f"{folder}/answers", "--responses-format", "json"]
    main([*args, "--out", f"{folder}/out"])
    assert any(",Su,1.0,0.50,0.50," in x for x in lines(folder / "out"))
    assert "success_rate: 0.5" in capsys.readouterr().out
    main([*args, "--out", f"{folder}/two", "--max-attempts", "2"])
    assert not any(",Su," in x for x in lines(folder / "two"))


def test_outcomes_job(spark, folder, capsys):
    log = spark.createDataFrame([("a", None, None), ("c", 404, None)], "fiscal_id string, status_code int, error string")
    log.write.json(f"{folder}/log")
    main(["outcomes", "--log", f"{folder}/log", "--format", "json", "--images", f"{folder}/images"])
    assert capsys.readouterr().out.split("\n")[:3] == ["total: 2", "successful: 1", "failed: 1"]


def test_answers_arrive_and_the_rest_is_asked_again(spark, folder):
    answer = json.dumps([{"item_name": "Su", "quantity": 1, "unit_price": 0.5, "line_total": 0.5}])
    schema = "filename string, attempt int, response string"
    text = ["--text", f"{folder}/text", "--format", "text", "--responses", f"{folder}/answers"]
    spark.createDataFrame([("a.jpeg", 0, answer), ("b.jpeg", 0, "?")], schema).write.parquet(f"{folder}/answers")
    main(["requests-again", *text, "--out", f"{folder}/again"])
    assert [(json.loads(x)["filename"], json.loads(x)["attempt"]) for x in lines(folder / "again")] == [("b.jpeg", 1)]
    keep = ["recover-new", *text, "--kept", f"{folder}/kept", "--checkpoint", f"{folder}/state"]
    main([*keep, "--out", f"{folder}/one"])
    assert sum(",Su,1.0,0.50,0.50," in x for x in lines(folder / "one")) == 1
    spark.createDataFrame([("b.jpeg", 1, answer)], schema).write.mode("append").parquet(f"{folder}/answers")
    main([*keep, "--out", f"{folder}/two"])
    assert sum(",Su,1.0,0.50,0.50," in x for x in lines(folder / "two")) == 2
