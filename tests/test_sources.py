import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.sources import columnar, delimited, fixed_width, jdbc, lines, listing


def test_edges_come_off_each_file_over_many_splits(spark, shared):
    import pathlib

    folder = pathlib.Path(shared) / "in"
    folder.mkdir()
    for f in range(3):
        body = [f"row-{f}-{i}" for i in range(200 * (f + 1))]
        (folder / f"f{f}.txt").write_text("\n".join(["h1", "h2", *body, "trailer"]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        out = lines.text_lines(spark, str(folder), header_rows=2, footer_rows=1)
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 6
        assert {r.value for r in out.collect()} == {f"row-{f}-{i}" for f in range(3) for i in range(200 * (f + 1))}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fixed_width_keeps_padding(spark, shared):
    spark.createDataFrame([("ab  123 ",), ("é   9   ",)], "value string").coalesce(1).write.text(f"{shared}/f")
    out = fixed_width.fixed_width_scan(spark, f"{shared}/f", [("a", 4), ("b", 4)]).collect()
    assert sorted(map(tuple, out)) == [("ab  ", "123 "), ("é   ", "9   ")]


def test_field_widths():
    assert [fixed_width.field_width(t) for t in ("CHAR(10)", "varchar(5)", "INTEGER", "DECIMAL(12,2)")] == [10, 5, 7, 14]


def test_delimited_options(spark, shared):
    import pathlib

    path = pathlib.Path(shared) / "d.csv"
    path.write_text("made by\nid|txt\n1|'a|b'\n2|'it\\'s'\nend\n")
    out = delimited.delimited_scan(spark, str(path), ["id", "txt"], sep="|", quote="'", header_rows=2, footer_rows=1)
    assert sorted(map(tuple, out.collect())) == [("1", "a|b"), ("2", "it's")]
    assert delimited.delimiter_from_control({"delimiter": "'|'"}) == "|"
    assert delimited.delimiter_from_control({}) == ","


@pytest.mark.parametrize("fmt", ["avro", "delta"])
def test_absent_connectors_say_so(spark, shared, fmt):
    with pytest.raises(ValueError, match="connector"):
        columnar.columnar_scan(spark, shared, fmt)


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="not one of"):
        columnar.columnar_scan(spark, "/x", "uniform")


def test_listing_choices(spark):
    T = dt.datetime
    rows = [("/in/files/a_1.dat", T(2024, 1, 1)), ("/in/files/a_1.dat.gz", T(2024, 1, 3)), ("/in/files/a_1.done_bkp", T(2024, 1, 4)),
            ("/in/files/a_2.dat", T(2024, 1, 3)), ("/in/files/b.txt", T(2024, 1, 9))]
    files = spark.createDataFrame(rows, "path string, modified timestamp")
    chosen = listing.select_files(files, r"a_\d\.dat", allow_gz=True)
    assert {r.path for r in chosen.collect()} == {rows[0][0], rows[1][0], rows[3][0]}
    assert listing.newest_file(chosen).first().path == "/in/files/a_2.dat"
    assert listing.files_after(files, "2024-01-03 00:00:00").count() == 2
    assert listing.files_after(files, None).count() == 5
    assert listing.files_for_date(files, "a_2").count() == 1
    assert listing.glob_to_regex("a_?.da*") == r"^a_.\.da.*$"


def test_list_files(spark, shared):
    spark.range(3).write.parquet(f"{shared}/x/y")
    found = listing.list_files(spark, f"{shared}/x", sub_folders=True)
    assert found.count() >= 1 and found.columns == ["path", "modified", "length"]


def test_gate(spark):
    data = spark.createDataFrame([("t1", "/a/1.dat"), ("t1", "/a/2.dat"), ("t2", "/b/1.dat")], "table_name string, path string")
    seen = spark.createDataFrame([("/a/1.done",), ("/b/1.done",), ("/c/9.done",)], "path string")
    out = {r.table_name: (r.n_files, r.n_unmarked, r.ready) for r in listing.ready_tables(data, seen, ".dat", ".done").collect()}
    assert out == {"t1": (2, 1, False), "t2": (1, 0, True)}


def test_split_predicates_cover_every_row_once(spark):
    rows = [(None,)] + [(dt.date(2020, 1, 1) + dt.timedelta(days=37 * i),) for i in range(60)]
    df = spark.createDataFrame(rows, "d date").withColumn("n", F.datediff("d", F.lit("2020-06-01")))
    splits = [
        jdbc.split_predicates(jdbc.Split("d", "MM", 5)), jdbc.split_predicates(jdbc.Split("d", "dd", 4)),
        jdbc.split_predicates(jdbc.Split("d", "MMdd", 3)), jdbc.split_predicates(jdbc.Split("d", "yyyy", 4), [2020, 2021, 2022]),
        jdbc.split_predicates(jdbc.Split("d", "yyyyMM", 4), [202001, 202002, 202103]), jdbc.split_predicates(jdbc.Split("n", "mod", 4)),
    ]
    for predicates in splits:
        hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
        assert df.select(hits.alias("h")).distinct().collect() == [(1,)], predicates


def test_split_choices():
    assert jdbc.default_split("d", "DATE").how == "MM" and jdbc.default_split("d", "timestamp", "vertica").how is None
    assert jdbc.default_split("n", "int").how is None
    with pytest.raises(ValueError, match="needs its values"):
        jdbc.split_predicates(jdbc.Split("d", "yyyy"))
    with pytest.raises(ValueError, match="lowest and highest"):
        jdbc.jdbc_scan(None, "jdbc:x", "t", jdbc.Split("n"))
    assert set(jdbc.CATALOG_VIEWS) == set(jdbc.SPLIT_TYPES)


def test_blank_lines_are_no_records(spark, shared):
    from quayside.sources.delimited import delimited_scan

    for header, name in ((1, "one"), (2, "two")):
        with open(f"{shared}/{name}.csv", "w") as out:
            out.write("h1,h2\n" * header + "1,a\n\n  \n2,b\n\n")
        got = delimited_scan(spark, f"{shared}/{name}.csv", ["x", "y"], header_rows=header).collect()
        assert [tuple(r) for r in got] == [("1", "a"), ("2", "b")]


def test_outer_rows_are_marked_in_one_scan(spark, shared):
    from quayside.sources.lines import text_lines
    from tests.test_plans import plan

    with open(f"{shared}/many.txt", "w") as out:
        out.write("\n".join(["head"] * 2 + [f"row {i}" for i in range(5000)] + ["foot"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = text_lines(spark, f"{shared}/many.txt", header_rows=2, footer_rows=1)
        assert "FileScan text" not in plan(lines)  # of the pinned rows, not of the files again
        assert sorted(r[0] for r in lines.collect()) == sorted(f"row {i}" for i in range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
