import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from goldrec.catalog import CATALOG
from goldrec.session import run_folder, scratch_path, shared_folder, stage
from goldrec.sources import footers, readers, records, writers


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_keeps_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", "SIREN;CP;x\n000012345;06130;1\n;75013;2\n")
    rows = readers.read_delimited(spark, path, ["SIREN", "CP"], ";").collect()
    assert [tuple(r) for r in rows] == [("000012345", "06130"), (None, "75013")]


def test_bom_is_not_part_of_the_first_header(spark, tmp_path):
    path = write(tmp_path / "b.csv", "﻿siren,x\n1,2\n")
    assert readers.read_delimited(spark, path).columns == ["siren", "x"]


def test_preamble(spark, tmp_path):
    path = write(tmp_path / "c.csv", 'sep=,\ntitle,Country\n"a, b",France\nc,\n')
    rows = readers.read_with_preamble(spark, path, ["title", "Country"]).collect()
    assert sorted(tuple(r) for r in rows) == [("a, b", "France"), ("c", None)]


def test_preamble_is_two_records_and_no_more(spark, tmp_path):
    lines = 'sep=,\ntitle,site\n"sep=abc",http\ntitle,site\n"two\nlines",b\n'
    for name in ("1.csv", "2.csv"):
        write(tmp_path / name, lines)
    rows = readers.read_with_preamble(spark, str(tmp_path), ["title", "site"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted(2 * [("sep=abc", "http"), ("title", "site"), ("two\nlines", "b")])


def test_text_survives_the_file(spark, tmp_path):
    values = [" lead trail ", "two\nlines", "", None, "cr\rhere", "crlf\r\nx", 'q"uo"te', "back\\slash", "\\", '"', "a,b;c", "\tx\t", "\n", " ", '""', "\\N"]
    df = spark.createDataFrame([(str(i), v, v) for i, v in enumerate(values)], "i string, v string, w string")
    for sep in ",;":
        writers.write_delimited(df, str(tmp_path / "t"), sep)
        got = {r.i: (r.v, r.w) for r in readers.read_delimited(spark, str(tmp_path / "t"), sep=sep).collect()}
        assert got == {str(i): (v, v) for i, v in enumerate(values)}


def test_optional_input(spark, tmp_path):
    absent = readers.read_optional(spark, str(tmp_path / "none.csv"), ["siren", "x"])
    assert absent.columns == ["siren", "x"] and absent.count() == 0
    present = readers.read_optional(spark, write(tmp_path / "d.csv", "siren\n1\n"), ["siren", "x"])
    assert [tuple(r) for r in present.collect()] == [("1", None)]


def test_key_column_by_header(spark):
    df = spark.createDataFrame([("a", "12345"), ("b", " 111111111 "), ("c", None), ("d", "12345")], "n string, `N° Siren` string")
    assert sorted(r.key for r in readers.load_key_list(df).collect()) == ["000012345", "111111111"]


def test_key_column_by_content(spark):
    df = spark.createDataFrame([("a", "111111111"), ("222222222", "333333333"), ("c", "x"), (None, None)], "n string, id string")
    assert readers.find_key_column(df) == "id"


def test_no_key_column(spark):
    df = spark.createDataFrame([("a", "111111111"), ("b", "x")], "n string, id string")
    with pytest.raises(ValueError):
        readers.find_key_column(df)


def test_point_lookup_not_found(spark):
    df = spark.createDataFrame([("1",)], "siren string")
    assert readers.lookup_key(df, "siren", "2").isEmpty()


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = {r.id for r in readers.sample_rows(df.repartition(7), 50, F.col("id"), 42).collect()}
    two = {r.id for r in readers.sample_rows(df.coalesce(1), 50, F.col("id"), 42).collect()}
    assert one == two and len(one) == 50
    assert readers.sample_rows(df, 5000, F.col("id"), 42).count() == 1000


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    assert tuple(readers.source_profile(df, "t").first()) == ("t", 2, 2, "x,y")


def test_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a;\"b\"", None, ["y", "x"]), ("", "é", [])], "a string, b string, c array<string>")
    writers.write_delimited(spark.range(3).withColumnRenamed("id", "old"), path, ";")
    writers.write_delimited(df, path, ";")
    back = readers.read_delimited(spark, path, sep=";")
    got = {r.b: (r.a, r.c) for r in back.collect()}
    assert got == {"é": ("", ""), None: ('a;"b"', "y|x")}
    assert '"";é;""' in "".join(r.value + "\n" for r in spark.read.text(path).collect())


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", (F.col("id") % 2).alias("flag"), F.lit("x").alias("wide")).write.parquet(path)
    plan = readers.read_table(spark, path, ["id", "flag"]).where("flag = 1").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(flag), EqualTo(flag,1)]" in text and "wide" not in text


def test_stage_writes_under_the_named_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5 and "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


# records of quoted text in many blocks

AWKWARD = [
    " lead trail ", "two\nlines", "", None, "cr\rhere", "crlf\r\nx", 'q"uo"te', "back\\slash", "\\", '"', "a,b;c", "\tx\t", "\n", " ", '""', "\\N", "end\r",
    '\n"\n', ',"\n",', "x" * 300 + "\n" + "y" * 300, "\n" * 70, '"""', "é\n漢", ',"',
]


@pytest.fixture
def small_blocks(spark):
    """Every file is read in blocks of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "0")

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [90, 1000, 1 << 20])
def test_text_survives_many_blocks(spark, tmp_path, small_blocks, size):
    df = spark.createDataFrame([(str(i), AWKWARD[i % len(AWKWARD)], AWKWARD[(5 * i) % len(AWKWARD)]) for i in range(60)], "i string, v string, w string")
    writers.write_delimited(df.coalesce(1), str(tmp_path / "t"))
    small_blocks(size)
    back = readers.read_delimited(spark, str(tmp_path / "t"))
    got = sorted(tuple(r) for r in back.collect())
    assert got == sorted(tuple(r) for r in df.collect())
    parts = back.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_no_task_writes_the_whole_table(spark, tmp_path, small_blocks):
    rows = [(i, f"a{i} the \"b\"; the c\n") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "in/documents.parquet"))
    small_blocks(1 << 20)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))  # a file to a task
    with run_folder(spark) as path:
        got = {r.doc_id: r.digest for r in CATALOG.queries["src03_line_breaks"](spark, str(tmp_path / "in")).collect()}
        parts = list(Path(path.removeprefix("file:")).glob("delimited-*/part-*"))
    assert got == {str(i): hashlib.md5(t.replace(" the ", '\n"the"\r').encode()).hexdigest() for i, t in rows}
    assert len(parts) == 4


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_null_rows_of_one_column(spark, tmp_path, small_blocks, size):
    df = spark.createDataFrame([(v,) for v in [*AWKWARD, None, "", None, "x"]], "siren string")
    writers.write_delimited(df.repartition(3), str(tmp_path / "t"))
    small_blocks(size)
    got = [r.siren for r in readers.read_delimited(spark, str(tmp_path / "t")).collect()]
    assert sorted(got, key=repr) == sorted((r.siren for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_foreign_files(spark, tmp_path, small_blocks, size):
    (tmp_path / "a.csv").write_bytes('﻿siren;nom\r\n1;"a\r\nb"\r\n\r\n2;12" pipe\r\n3;"x"y;z\r\n4;"open\r\nto the end'.encode())
    (tmp_path / "b.csv").write_bytes('siren;nom\n5;é\r\n6\n'.encode())
    small_blocks(size)
    got = sorted(tuple(r) for r in readers.read_delimited(spark, str(tmp_path), sep=";").collect())
    assert [tuple(x for x in r) for r in got if r[0] in "1256"] == [("1", "a\r\nb"), ("2", '12" pipe'), ("5", "é\r"), ("6", None)]
    assert got[2][0] == "3" and got[3][0] == "4" and got[3][1].replace('"', "") == "open\r\nto the end"


@pytest.mark.parametrize("size", [6, 1 << 20])
def test_preamble_over_blocks(spark, tmp_path, small_blocks, size):
    for name in ("1.csv", "2.csv"):
        write(tmp_path / name, 'sep=,\n"title",site\n"sep=,",x\n"title",site\n"two\n\nlines",b\n')
    small_blocks(size)
    rows = readers.read_with_preamble(spark, str(tmp_path), ["title", "site"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted(2 * [("sep=,", "x"), ("title", "site"), ("two\n\nlines", "b")])


def test_records_are_numbered(spark, tmp_path, small_blocks):
    write(tmp_path / "n.csv", "".join(f'{i},"{"x" * (i % 9)}\n{i}"\n' for i in range(30)))
    small_blocks(11)
    rows = records.records(spark, str(tmp_path / "n.csv")).collect()
    assert sorted((r.number, r.text) for r in rows) == [(i, f'{i},"{"x" * (i % 9)}\n{i}"') for i in range(30)]


def test_every_split_agrees_with_the_whole(spark, tmp_path, small_blocks):
    rng = random.Random(4)
    texts = ["".join(rng.choice('ab,"\n\r') for _ in range(40)) for _ in range(40)]
    df = spark.createDataFrame([(str(i), t, texts[-i]) for i, t in enumerate(texts)], "i string, v string, w string")
    writers.write_delimited(df.coalesce(1), str(tmp_path / "t"))
    for size in (29, 110):
        small_blocks(size)
        assert sorted(tuple(r) for r in readers.read_delimited(spark, str(tmp_path / "t")).collect()) == sorted(tuple(r) for r in df.collect())


def test_preamble_needs_one_parse(spark, tmp_path):
    write(tmp_path / "c.csv", "sep=,\ntitle,Country\na,b\n")
    plan = readers.read_with_preamble(spark, str(tmp_path / "c.csv"), ["title"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan


def test_sample_stays_in_its_tasks(spark):
    df = spark.range(0, 200_000, 1, 8)
    for n in (0, 1, 999, 100_000, 200_000, 300_000):
        sample = readers.sample_rows(df, n, F.col("id"), 7)
        ticket = F.md5(F.concat_ws(":", F.lit("7"), F.col("id").cast("string")))
        wanted = {r.id for r in df.orderBy(ticket, "id").limit(n).collect()}
        assert {r.id for r in sample.collect()} == wanted and sample.count() == min(n, 200_000)
    assert readers.sample_rows(df, 100_000, F.col("id"), 7).select(F.spark_partition_id()).distinct().count() > 4


def test_table_is_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        readers.read_replaced(spark, path)
    for n in (3, 5, 7):
        writers.replace_table(spark.range(n), path)
        assert readers.read_replaced(spark, path).count() == n
    old = readers.read_replaced(spark, path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        writers.replace_table(broken, path)
    assert readers.read_replaced(spark, path, ["id"]).count() == 7
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 2
    writers.replace_table(spark.range(2), path)
    assert old.count() == 7 and readers.read_replaced(spark, path).count() == 2


def test_footers_answer_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, float(i) / 2 if i % 5 else None, f"x{i}") for i in range(100)]
    spark.createDataFrame(rows, "a long, b double, c string").repartition(3).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    n, facts, plan = footers.footer_facts(spark, path, ["a", "b"])
    assert (n, facts) == (100, {"a": (100, 0, 99), "b": (80, 0.5, 49.5)})
    assert "PushedAggregation: [COUNT(*), COUNT(a), MIN(a), MAX(a), COUNT(b), MIN(b), MAX(b)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    n, facts, _ = footers.footer_facts(spark, path, ["c"])
    assert facts == {"c": (100, "x0", "x99")}
    spark.createDataFrame([], "a long").write.parquet(path + "0")
    assert footers.footer_facts(spark, path + "0", ["a"])[:2] == (0, {"a": (0, None, None)})


def test_run_folder_is_removed(spark, tmp_path):
    before = shared_folder(spark)
    with run_folder(spark) as folder:
        assert shared_folder(spark) == folder and stage(spark.range(4), "four").count() == 4
        assert any(p.name.startswith("four-") for p in Path(folder).iterdir())
    assert shared_folder(spark) == before and not Path(folder).exists()
