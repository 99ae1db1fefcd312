"""Readers, writers, pipelines and the collection stream, in temporary folders."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vacantia.functions import text, vocab
from vacantia.plans import board_a, board_b, dashboard, market
from vacantia.operators.impute import ForestSpec
from vacantia.sources import readers, writers
from vacantia.streaming.collect import collect
from vacantia.streaming.seen import SeenKeys

LINES = [
    "﻿id;title;company",
    "1;plain;x",
    '2;"semi;colon";x',
    '3;"double ""quote""";x',
    '4;"two\nlines";x',
    "5;too;many;fields",
    "6;short",
    "7;;x",
    '8;"";"last ""one"""',
]


@pytest.fixture
def delimited(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes("\r\n".join(LINES).encode("utf-8"))
    return str(path)


def test_delimited(spark, delimited):
    got = readers.read_delimited(spark, delimited, ["id", "title", "company"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        ("1", "plain", "x"), ("2", "semi;colon", "x"), ("3", 'double "quote"', "x"), ("4", "two\nlines", "x"),
        ("6", "short", None), ("7", None, "x"), ("8", None, 'last "one"')]


def test_audit(spark, delimited):
    audit = readers.audit_delimited(spark, delimited)
    total, head = readers.audit_head(audit)
    assert total.first()[0] == 2
    assert [(r["line_no"], r["n_fields"], r["preview"]) for r in head.collect()] == [
        (6, 4, ["5", "too", "many", "fields"]), (7, 2, ["6", "short"])]


def test_audit_counts_blank_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffid;title\n\n1;x;y\n2;"two\n\nlines"\n\n3\n')
    (tmp_path / "b.csv").write_text("id;title;company\n1;a;b\n2;a\n")
    got = sorted((r["file"][-5:], r["line_no"], r["n_fields"], r["preview"]) for r in readers.audit_delimited(spark, str(tmp_path / "*.csv")).collect())
    assert got == [("a.csv", 2, 0, []), ("a.csv", 3, 3, ["1", "x", "y"]), ("a.csv", 5, 0, []), ("a.csv", 6, 1, ["3"]), ("b.csv", 3, 2, ["2", "a"])]


def test_audit_of_a_split_file(spark, tmp_path):
    """The same answers if the file is read in many parts, quoted line breaks across them included."""
    lines = ["id;title;company"]
    for i in range(400):
        lines.append(f'{i};"a\nb;c\n";x' if i % 3 == 0 else f"{i};short" if i % 7 == 0 else f"{i};plain;x")
    (tmp_path / "long.csv").write_text("\n".join(lines) + "\n")
    whole = sorted(map(tuple, readers.audit_delimited(spark, str(tmp_path / "long.csv")).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        assert sorted(map(tuple, readers.audit_delimited(spark, str(tmp_path / "long.csv")).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[1] for r in whole] == [i + 2 for i in range(400) if i % 7 == 0 and i % 3]


def spark_rows(spark, path, columns, sep):
    """Spark's own reader of quoted text, one task for each file."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).options(header=True, sep=sep, quote='"', escape='"', multiLine=True, mode="PERMISSIVE").csv(path)


@pytest.mark.parametrize("end, part", [("\n", 997), ("\r\n", 613), ("\n", 1 << 20)])
def test_quoted_text_is_read_in_parts(spark, tmp_path, end, part):
    """Random quotes, separators, blanks and line breaks: as Spark's reader of one task, in however many parts."""
    rng = random.Random(part)

    def field():
        kind = rng.randrange(8)
        if kind < 3:
            return "".join(rng.choice("ab é") for _ in range(rng.randrange(6)))
        if kind == 3:
            return rng.choice(['3" pipe', 'a"b"', 'x""y', 'say ""no""', "q'"])
        body = "".join(rng.choice(["a", "b", ";", '""', end, " ", "é"]) for _ in range(rng.choice([0, 3, 9, 400 if kind == 7 else 5])))
        return f'"{body}"' + (rng.choice(["", "tail", " "]) if kind == 6 else "")

    for name in ("a", "b"):
        rows = [";".join([f"{name}{i}", *(field() for _ in range(rng.choice([1, 2, 2, 2])))]) for i in range(300)]
        rows = [r for row in rows for r in ([row, ""] if rng.random() < 0.1 else [row])]
        (tmp_path / f"{name}.csv").write_text("\ufeffid;x;y" + end + end.join(rows) + rng.choice(["", end]), newline="", encoding="utf-8")
    path = str(tmp_path / "*.csv")
    wanted = sorted(map(tuple, spark_rows(spark, path, ["id", "x", "y"], ";").collect()), key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        read = readers.read_delimited(spark, path, ["id", "x", "y"], missing=())
        got = sorted(map(tuple, read.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == wanted
    assert any(v and "\n" in v for r in got for v in r) and len(got) == 600


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    """A record across three parts, and at least eight tasks for one file."""
    rows = [f'{i};"a ""b"";\n{"x" * (60_000 if i == 50 else 40)}";y' for i in range(3000)]
    (tmp_path / "one.csv").write_text("id;title;company\n" + "\n".join(rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        assert readers._lines(spark, str(tmp_path / "one.csv"), lineSep="\n").rdd.getNumPartitions() >= 8
        got = {r["id"]: r["title"] for r in readers.read_delimited(spark, str(tmp_path / "one.csv"), ["id", "title", "company"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f'a "b";\n{"x" * (60_000 if i == 50 else 40)}' for i in range(3000)}


def test_a_quote_that_is_never_closed_is_an_error(spark, tmp_path):
    (tmp_path / "u.csv").write_text("id;title\n1;a\n2;\"open\n" + "3;more text\n" * 400)
    with pytest.raises(Exception, match="u.csv, record 3"):
        readers.quoted_records(spark, str(tmp_path / "u.csv"), longest=1000).collect()
    assert readers.quoted_records(spark, str(tmp_path / "u.csv")).count() == 3


def test_missing_value_texts(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id;company\n1;N/A\n2;null\n3;None\n4;nan\n5;\n6;Nada\n")
    path = str(tmp_path / "m.csv")
    assert [r["company"] for r in readers.read_delimited(spark, path, ["id", "company"]).collect()] == [None] * 5 + ["Nada"]
    kept = readers.read_delimited(spark, path, ["id", "company"], missing=[""]).collect()
    assert [r["company"] for r in kept] == ["N/A", "null", "None", "nan", None, "Nada"]


def test_audit_records(spark):
    data = [(2, "a;b;c"), (3, '"x;y";b;c'), (4, "a;b"), (5, 'a;"b ""q""; z";c;d;e;f')]
    df = spark.createDataFrame(data, "line_no int, record string")
    got = [tuple(r) for r in readers.audit_records(df, "record", "line_no", 3).orderBy("line_no").collect()]
    assert got == [(4, 2, ["a", "b"]), (5, 6, ["a", 'b "q"; z', "c", "d", "e"])]


def test_empty_and_header_only(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("id;title\n")
    for name in ("e.csv", "h.csv"):
        assert readers.read_delimited(spark, str(tmp_path / name), ["id", "title"]).count() == 0


def test_glob(spark, tmp_path):
    (tmp_path / "checkpoint_a.csv").write_text('id,title\n1,"a, b"\n2,\n')
    (tmp_path / "checkpoint_b.csv").write_text("title,company\nt,c\n")
    (tmp_path / "checkpoint_c.csv").write_text("\n")
    (tmp_path / "other.csv").write_text("id\n9\n")
    got = readers.read_glob(spark, str(tmp_path / "checkpoint_*.csv")).orderBy("_source", "_row").collect()
    assert [(r["_source"].rsplit("/")[-1], r["id"], r["title"], r["company"]) for r in got] == [
        ("checkpoint_a.csv", "1", "a, b", None), ("checkpoint_a.csv", "2", None, None), ("checkpoint_b.csv", None, "t", "c")]


def test_glob_of_many_headers(spark, tmp_path):
    """Quoted names, other orders, names twice, and short and long rows, in one pass."""
    (tmp_path / "checkpoint_a.csv").write_text('\ufeffid,"ti,tle",id\n1,x,2\n2\n3,"two\nlines",4,surplus\n')
    (tmp_path / "checkpoint_b.csv").write_text('\n\n"ti,tle",id\n\ny,5\nNA,6\n')
    (tmp_path / "checkpoint_c.csv").write_text("company\nz\n")
    got = readers.read_glob(spark, str(tmp_path / "checkpoint_*.csv"))
    assert set(got.columns) == {"id", "ti,tle", "company", "_source", "_row"}
    rows = {(r["_source"][-5:], r["_row"]): (r["id"], r["ti,tle"], r["company"]) for r in got.collect()}
    assert rows == {("a.csv", 2): ("1", "x", None), ("a.csv", 3): ("2", None, None), ("a.csv", 4): ("3", "two\nlines", None),
                    ("b.csv", 5): ("5", "y", None), ("b.csv", 6): ("6", None, None), ("c.csv", 2): (None, None, "z")}


def test_glob_tells_what_it_skips(spark, tmp_path):
    (tmp_path / "checkpoint_a.csv").write_text("id\n1\n")
    (tmp_path / "checkpoint_b.csv").write_text("\n\n")
    (tmp_path / "checkpoint_c.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 damaged")
    found = readers.headers(spark, str(tmp_path / "checkpoint_*"))
    assert sorted(r["file"].rsplit("_")[-1] for r in readers.skipped(found).collect()) == ["b.csv", "c.csv.gz"]
    assert [r["id"] for r in readers.read_glob(spark, str(tmp_path / "checkpoint_*")).collect()] == ["1"]


def test_glob_of_equal_file_names(spark, tmp_path):
    for folder, title in (("x", "old"), ("y", "new")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "checkpoint_1.csv").write_text(f"id,title\n1,{title}\n")
    got = readers.read_glob(spark, str(tmp_path / "*/checkpoint_*.csv"))
    assert got.select("_source").distinct().count() == 2


def test_glob_without_files(spark, tmp_path):
    (tmp_path / "checkpoint_c.csv").write_text("\n")
    with pytest.raises(FileNotFoundError):
        readers.read_glob(spark, str(tmp_path / "checkpoint_*.csv"))


def test_json_array(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"id": "1", "extracted_skills": ["a"]}, {"id": "2", "extracted_skills": []}], indent=2))
    got = readers.read_records(spark, str(path), "id string, extracted_skills array<string>").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", ["a"]), ("2", [])]


def test_csv_has_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([(1, "é, \"x\"\ny", ["a", "it's"])], "id int, title string, extracted_skills array<string>")
    writers.write_csv(df.coalesce(1), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid,title,extracted_skills\n")
    back = readers.read_plain(spark, str(tmp_path / "out"), "id int, title string, extracted_skills string").first()
    assert back["title"] == "é, \"x\"\ny"
    assert json.loads(json.dumps(spark.createDataFrame([(back[2],)], "v string").select(
        text.parse_list(F.col("v"))).first()[0])) == ["a", "it's"]


def test_light_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "long", None)], "id int, job_description string, company string")
    writers.write_records_light(df.coalesce(1), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*.json"))
    assert json.loads(part.read_text()) == {"id": 1, "company": None}


def test_per_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, search_role string")
    target = writers.write_per_key(df, str(tmp_path), "r1")
    assert {p.name for p in (tmp_path / "run=r1").iterdir() if p.is_dir()} == {"search_role=a b", "search_role=c"}
    assert spark.read.parquet(target).count() == 2


DESCRIPTION = "We look for python and sql, react native too. " * 3


def test_board_a_run(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    rows = ["id;title;company;location;job_description;job_url", f"1;Data Scientist;c;Bali;{DESCRIPTION};u",
            f"2;Nurse;c;Bali;{DESCRIPTION};u", "3;Chef;c;Bali;cook;u", f"4;AI Specialist Intern;c;Bali;{DESCRIPTION};u", "5;x;y;z;1;2;3"]
    raw.write_text("\n".join(rows))
    names = rows[0].split(";")
    final = board_a.run(spark, str(raw), names, str(tmp_path / "out"), "r1")
    got = {r["id"]: r for r in final.collect()}
    assert set(got) == {"1", "4"}
    assert got["1"]["standardized_role"] == "Data Scientist" and got["4"]["standardized_role"] == "ML Engineer"
    assert got["4"]["seniority"] == "Intern" and got["1"]["extracted_skills"] == ["python", "react", "react native", "sql"]
    assert final.columns == [c for c in vocab.BOARD_A_COLUMNS if c in final.columns]
    log = board_a.step_log(readers.read_delimited(spark, str(raw), names)).collect()
    assert [(r["before"], r["after"]) for r in log] == [(4, 3), (3, 2)]
    summary = json.loads(next((tmp_path / "out/summary_r1.json").glob("part-*.json")).read_text())
    assert summary["total_jobs"] == 2 and summary["skills_per_role"]["Data Scientist"]["sql"] == 1


def test_board_b_run_and_market(spark, tmp_path):
    head = "id,title,company,location,job_description,job_url,salary,search_role,search_location,extracted_skills,skills_count,scraped_at\n"
    (tmp_path / "checkpoint_1.csv").write_text(
        head + "1, Data Engineer ,c,Bandung,senior,u,Rp 5.000.000,data engineer,id,\"['sql']\",1,2026-04-21T10:00:00\n"
        + "1,Data Engineer II,c,,x,u,5jt - 7jt,data engineer,id,\"['sql', 'r']\",1,bad\n"
        + ",Dev,c,Remote,x,u,,backend,id,[],0,\n,Dev,c,Tokyo,mid,u,,backend,id,,0,\n9,,c,x,x,u,,x,id,,0,\n")
    b = board_b.run(spark, str(tmp_path / "checkpoint_*.csv"), str(tmp_path / "out"), "r1")
    got = {r["title"]: r for r in b.collect()}
    assert set(got) == {"Data Engineer II", "Dev"}
    two, dev = got["Data Engineer II"], got["Dev"]
    assert (two["salary_min"], two["salary_max"], two["salary_avg"]) == (5000000, 7000000, 6000000.0)
    assert two["location"] == vocab.NOT_STATED and two["location_raw"] == vocab.NOT_STATED and two["scraped_at"] is None
    assert two["extracted_skills"] == ["sql", "r"] and two["skills_count"] == 2
    assert dev["location"] == "Lainnya" and dev["search_role"] == "Backend Developer" and dev["search_role_raw"] == "backend"
    assert dev["job_level"] == "Mid" and dev["salary_display"] == vocab.NOT_STATED and dev["extracted_skills"] == []
    assert b.columns[:18] == vocab.BOARD_B_COLUMNS and "_source" not in b.columns
    a = spark.createDataFrame(
        [("7", "Lead Dev", "Backend Developer", "c", "Bali, ID", "Intern", ["sql"], 1)],
        "id string, title string, standardized_role string, company string, location string, seniority string, "
        "extracted_skills array<string>, skills_count int")
    table = market.analysis_table(a, b, ForestSpec(trees=3, min_support=1, min_leaf=1))
    rows = {r["id"]: r for r in table.collect()}
    assert table.filter("salary_avg is null").count() == 0 and rows["1"]["location"] == "DKI Jakarta"
    assert rows["7"]["job_level"] == "Junior" and rows["7"]["title_seniority"] == "Manager/Head"
    assert rows["7"]["company_hiring_freq"] == 3 and rows["7"]["company_size_proxy"] == "Medium (3–5)"
    assert "city" not in table.columns and "salary_source" not in table.columns


def test_dashboard(spark):
    df = spark.createDataFrame([("A", "x", "5000000", "['a', 'b']"), ("B", "y", "bad", None)],
                               "`Search Role` string, company string, salary_avg string, extracted_skills string")
    loaded = dashboard.load(df.withColumn("Job_Leevl", F.lit("Senior")))
    assert {"search_role", "job_level", "skills_count", "salary_avg_jt", "company_size_proxy"} <= set(loaded.columns)
    rows, paid = dashboard.select(loaded, {"search_role": [], "job_level": ["Senior"]})
    assert rows.count() == 2 and paid.count() == 1 and paid.first()["salary_avg_jt"] == 5.0
    assert paid.first()["skills_count"] == 2


def test_collect_stream(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = "id string, job_url string, search_role string, at int"

    def put(name, *records):
        (source / name).write_text("\n".join(json.dumps(dict(zip(["id", "job_url", "search_role", "at"], r))) for r in records))

    def run(state="state"):
        stream = spark.readStream.schema(schema).json(str(source))
        key = text.identity_key(F.col("id"), F.col("job_url"))
        query = collect(stream, target, str(tmp_path / state), key, ["at"])
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r["at"] for r in spark.read.parquet(target).collect())

    put("1.json", ("7", "u", "A", 1), ("7", "v", "A", 2), ("", "u", "B", 3), ("", "", "B", 4))
    assert run() == [1, 3, 4]
    put("2.json", ("7", "w", "C", 5), ("8", "", "C", 6), ("", "", "C", 7), ("", "u", "C", 8))
    assert run() == [1, 3, 4, 6, 7]
    assert run() == [1, 3, 4, 6, 7]
    # The checkpoint is lost: epochs count from 0 again, and everything that was collected stays.
    (source / "1.json").unlink()
    (source / "2.json").unlink()
    put("3.json", ("9", "", "C", 9))
    assert run("new state") == [1, 3, 4, 6, 7, 9]
    # A run that is missing in the index is read from the table.
    for part in (tmp_path / "out_keys/filters").glob("run=*/_SUCCESS"):
        part.unlink()
    put("4.json", ("7", "x", "A", 10), ("11", "", "A", 11))
    assert run("new state") == [1, 3, 4, 6, 7, 9, 11]


def test_a_batch_reads_only_the_files_it_hits(spark, tmp_path):
    index = SeenKeys(str(tmp_path / "index"), buckets=16)

    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k string")

    for run in range(4):
        index.add(keys(None, *(f"{run}-{i}" for i in range(2000))), f"s-{run}")
    runs = index.runs(spark)
    assert runs == ["s-0", "s-1", "s-2", "s-3"]
    one = index.places(keys("2-77", None), runs)
    assert len(one) <= 2 and any("run=s-2/" in p for p in one)
    assert {"2-77"} <= {r["key"] for r in index.among(keys("2-77"), runs).collect()}
    # New keys hit nearly nothing, and every stored key is found again.
    assert len(index.places(keys(*(f"new-{i}" for i in range(50))), runs)) < 16
    stored = keys(*(f"{r}-{i}" for r in range(4) for i in range(0, 2000, 7)))
    assert index.among(stored, runs).join(stored, F.col("key") == F.col("k"), "left_semi").count() == stored.count()
    assert index.places(keys("2-77"), ["s-1"]) == [] or index.places(keys("2-77"), []) == []
    assert index.among(keys(None), runs) is None


@pytest.mark.parametrize("stretch", [1, 3, 50])
def test_stretches_of_a_read_part(spark, tmp_path, monkeypatch, stretch):
    """Records, numbers and headers are the same however short the stretches are."""
    path = tmp_path / "s.csv"
    path.write_text("\n\na,b\n" + "".join(f'{i},"x\n""{i}"",\n\ny"\n' if i % 3 else f"{i},z\n" for i in range(200)))
    whole = sorted(map(tuple, readers.quoted_records(spark, str(path), ",").collect()))
    monkeypatch.setattr(readers, "STRETCH", stretch)
    cut = readers.quoted_records(spark, str(path), ",")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "stretch" in plan and sorted(map(tuple, cut.collect())) == whole and len(whole) == 203
