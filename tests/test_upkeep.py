"""Tables that are kept up to date: present files, listings, dates written again; and pages cut into tokens."""

import glob
import os
import random
import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from fiscalframe.catalog import collecting
from fiscalframe.catalog import receipts as receipt_queries
from fiscalframe.functions.html import decode_entities, form_token, html_attr
from fiscalframe.operators.worklist import fetch_worklist
from fiscalframe.schema import conform
from fiscalframe.sources.inputs import folders, list_folders, list_images
from fiscalframe.sources.outputs import finished_dates, rewrite_changed_dates
from fiscalframe.sources.present import add_present, buckets_of, present_table, worklist_from_table


@pytest.fixture
def present(spark, tmp_path):
    name = f"present_{uuid.uuid4().hex}"
    present_table(spark, name, str(tmp_path / "present"), 5)
    yield name
    spark.sql(f"DROP TABLE `{name}`")


def files(spark, ids):
    return spark.createDataFrame([(f"{i}.jpeg",) for i in ids] + [("x.png",), (None,)], "filename string")


def test_worklist_against_the_bucketed_table(spark, present, tmp_path):
    ids = spark.createDataFrame([(str(i % 90),) for i in range(300)] + [("",)], "fiscal_id string")
    assert worklist_from_table(ids, present).count() == 91
    first, second = range(0, 40), range(20, 60)
    add_present(files(spark, first), present)
    add_present(files(spark, [*second, *second]), present)
    assert sorted(r[0] for r in spark.table(present).collect()) == sorted(str(i) for i in range(60))
    every = files(spark, [*first, *second])
    assert sorted(worklist_from_table(ids, present).collect()) == sorted(fetch_worklist(ids, every).collect())
    # Another session finds the same table by its path.
    present_table(spark, present + "_again", str(tmp_path / "present"), 5)
    assert worklist_from_table(ids, present + "_again").count() == 31 and buckets_of(spark, present + "_again") == 5
    spark.sql(f"DROP TABLE `{present}_again`")


def test_only_wanted_ids_are_shuffled(spark, present):
    add_present(files(spark, range(50)), present)
    out = worklist_from_table(spark.createDataFrame([("1",), ("99",)], "fiscal_id string"), present)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    left, right = plan.split("SortMergeJoin")[1].split("Scan parquet")[0], plan.rpartition("Scan parquet")
    assert "Bucketed: true" in plan and "Broadcast" not in plan
    # What lies between the join and the scan of the table: a sort at most.
    branch = [line for line in plan.splitlines() if "Scan parquet" in line or "Exchange" in line or "Scan ExistingRDD" in line]
    known = next(i for i, line in enumerate(branch) if "Scan parquet" in line)
    assert known == len(branch) - 1 or "Exchange" not in branch[known - 1] or "Scan ExistingRDD" in branch[known - 1]
    assert left and right


def test_folders_are_listed_by_tasks(spark, tmp_path):
    for folder in ("a", "a/deep", "b", "_hidden", "b/.trash", "c d"):
        (tmp_path / folder).mkdir(exist_ok=True)
        for name in ("1.jpeg", "2.PNG", "3.gif", "_4.jpeg", "ü 5.tiff"):
            (tmp_path / folder / name).write_bytes(b"x")
    (tmp_path / "empty").mkdir()
    plain = lambda df: sorted((r["path"].replace("file://", "file:"), r["filename"]) for r in df.collect())
    prefixes = [f for f in folders(spark, str(tmp_path)) if "_hidden" not in f]
    assert len(prefixes) == 4
    found = list_folders(spark, prefixes)
    names = [(p.removeprefix("file:").removeprefix(str(tmp_path)), n) for p, n in plain(found)]
    assert names == sorted((f"/{d}/{n}", n) for d in ("a", "a/deep", "b", "c d") for n in ("1.jpeg", "2.PNG", "ü 5.tiff"))
    assert found.rdd.getNumPartitions() == 4
    whole = list_images(spark, f"{tmp_path}/b").select("filename")
    assert sorted(whole.collect()) == sorted(list_folders(spark, [f"{tmp_path}/b"]).select("filename").collect())
    assert list_folders(spark, [f"{tmp_path}/none"]).count() == list_folders(spark, []).count() == 0


def receipts(spark, rows):
    return conform(spark.createDataFrame(rows, "filename string, date string, time string, line_total double"))


def read(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("filename", "line_total", "sale_date").collect()), key=repr)


@pytest.mark.parametrize("by_month", [False, True])
def test_a_second_run_changes_nothing_and_a_later_one_only_its_dates(spark, tmp_path, by_month):
    path = str(tmp_path / "by-date")
    rows = [("a", "01.02.2024", "10:00:00", 1.0), ("b", "02.02.2024", "10:00:00", 2.0), ("b", "02.02.2024", "10:00:00", 2.0), ("c", None, None, 3.0), ("d", "05.03.2024", "08:00:00", 4.0)]
    rewrite_changed_dates(receipts(spark, rows), path, by_month)
    before, stamps = read(spark, path), {f: f.stat().st_mtime_ns for f in (tmp_path / "by-date").rglob("*.parquet")}
    assert len(before) == 5
    rewrite_changed_dates(receipts(spark, rows[::-1]), path, by_month)
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "by-date").rglob("*.parquet")} == stamps
    changed = [("a", "01.02.2024", "10:00:00", 9.0), *rows[1:4], ("e", "06.04.2024", "08:00:00", 5.0)]
    rewrite_changed_dates(receipts(spark, changed), path, by_month)
    # March is not in this run and stays.
    assert sorted(r[1] for r in read(spark, path)) == [2.0, 2.0, 3.0, 4.0, 5.0, 9.0]
    last = {str(r["sale_date"]): r["run"] for r in finished_dates(spark, path).collect()}
    assert sorted(last.values()) == ([0, 0, 1, 1] if by_month else [0, 0, 0, 1, 1])


def test_a_run_that_is_killed_is_made_good(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "by-date")
    rows = [(f"r{i}", f"{i % 28 + 1:02}.02.2024", "10:00:00", float(i)) for i in range(60)]
    rewrite_changed_dates(receipts(spark, rows[:30]), path)

    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    # The dates are written, or some of them; the note is not.
    frame = type(spark.range(1))
    real = frame.write.fget
    calls = []

    def write(df):
        calls.append(df)
        return killed() if len(calls) == 3 else real(df)

    monkeypatch.setattr(frame, "write", property(write))
    with pytest.raises(Killed):
        rewrite_changed_dates(receipts(spark, rows), path)
    monkeypatch.undo()
    rewrite_changed_dates(receipts(spark, rows), path)
    assert [r[1] for r in sorted(read(spark, path), key=lambda r: r[1])] == [float(i) for i in range(60)]
    assert finished_dates(spark, path).agg(F.sum("n_rows")).first()[0] == 60


def test_receipts_written_three_times_are_parsed_once(spark, tmp_path, monkeypatch):
    orders = "1L o_orderkey, 1L o_custkey, 'P' o_orderstatus, 2.5D o_totalprice, timestamp_ntz'2024-02-01' o_orderdate, '1-URGENT' o_orderpriority"
    for i in range(1, 5):
        spark.sql(f"SELECT {orders}").withColumn("o_orderkey", F.lit(i).cast("long")).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    plans = []

    def rewritten(df, path, by_month=False):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        rewrite_changed_dates(df, path, by_month)

    monkeypatch.setattr(receipt_queries, "rewrite_changed_dates", rewritten)
    days = receipt_queries.sale_dates_rerun(spark, str(tmp_path)).collect()
    assert len(plans) == 3 and not any("regexp" in p for p in plans)
    assert [(r["n_rows"], r["run"]) for r in days] == [(10, 1)]


def test_listed_files_are_written_by_many_tasks(spark, tmp_path):
    customers = spark.range(1_010).select(F.lit(3).alias("c_nationkey"), F.col("id").cast("string").alias("c_name"))
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    before = len(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/images-*"))
    found = collecting.listed_images(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [(3, ending, 51) for ending in ("jpg", "png")]
    written = glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/images-*")
    newest = max(written, key=os.path.getmtime)
    tasks = {re.search(r"part-(\d+)-", f).group(1) for f in glob.glob(f"{newest}/c_nationkey=3/*jpg")}
    assert len(written) == before + 1 and len(tasks) > 1


HIDDEN = [
    ('<!-- <meta charset="a"> --><meta charset="b">', "b"),
    ('<!--><meta charset="a">', "a"),
    ('<!-- x --!><meta charset="a">', "a"),
    ('<!-- <meta charset="a">', None),
    ('<script>"<meta charset=a>"</SCRIPT ><meta charset=b>', "b"),
    ('<script>"<meta charset=a>"</scripts><meta charset=b>', None),
    ("<style>/*<meta charset=a>*/</style><TITLE><meta charset=b></TITLE><textarea><meta charset=c></textarea><META charset=d>", "d"),
    ("<a title='<meta charset=a>'>x</a><meta charset=b>", "b"),
    ("<a title=it's><meta charset=b>don't", "b"),
    ('<a "><meta charset=b>', "b"),
    ('<a title="<meta charset=a>', None),
    ("<!DOCTYPE html><meta charset=b>", "b"),
    ("<? <meta charset=a> ?><meta charset=b>", "b"),
    ("1 < 2 <meta charset=b>", "b"),
    ("<metas charset=a><meta charset=b>", "b"),
    ("<scripty><meta charset=b></scripty>", "b"),
    ('<meta charset="&lt;&quot;&amp;amp;&#65;&#x1F600;&eacute;&#0;&#xD800;&nope;&amp &">', '<"&amp;A\U0001f600é��&nope;&amp &'),
    ("<meta charset>", ""),
]


def test_hidden_tags_and_entities(spark):
    df = spark.createDataFrame(list(enumerate(h for h, _ in HIDDEN)), "i int, html string")
    for row in df.select("i", html_attr(F.col("html"), "meta", "charset").alias("v")).collect():
        assert row["v"] == HIDDEN[row["i"]][1], HIDDEN[row["i"]][0]


def test_text_of_a_script_is_hidden_but_not_the_script(column):
    html = F.lit("<script src='a.js'>'<script src=b.js>'</script><script src=c.js>")
    assert column(html_attr(html, "script", "src")) == "a.js"
    assert column(html_attr(html, "script", "src", key="src", value="b.js")) is None
    assert column(form_token(F.lit("<!-- <meta name=csrf-token content=x> --><input name=_csrf value='a&#38;b'>"))) == "a&b"


def test_entities_against_python(spark):
    import html as reference

    rng = random.Random(2)
    pieces = ["&amp;", "&lt;", "&eacute;", "&#8364;", "&#x20AC;", "&#X41;", "a", " ", "&&", ";", "&euro;", "&Alpha;", "x;y"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(8))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in df.select("i", decode_entities(F.col("t")).alias("v")).collect():
        assert row["v"] == reference.unescape(texts[row["i"]]), texts[row["i"]]


def test_broken_pages_stay_linear(column):
    shapes = ["<a ", "<!--", "<a b='", '<a b="', "<script>", "<script ", "</", "<", "<!", "&amp", "<meta charset='"]
    started = time.monotonic()
    for shape in shapes:
        column(html_attr(F.repeat(F.lit(shape), 1_000_000 // len(shape)), "meta", "charset"))
    assert time.monotonic() - started < 60
