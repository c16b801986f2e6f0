"""CSV over byte ranges against the reader that gives a file to one task."""

import csv
import io
import random

import pytest

from tidemark.sources import csv_ranges, readers

WORDS = ["a", "bc", "d e", 'q"q', "x,y", "line\nbreak", "\n\n", 'end"', '"', "", "NA", "7", "tab\t", "crlf\r\nin", "é漢", ",", '",\n"', "long " * 30]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, end="\n"):
    text = io.StringIO()
    w = csv.writer(text, lineterminator=end)
    w.writerows([("id", "first", "second"), *rows])
    path.write_bytes(text.getvalue().encode())
    return str(path)


def cells(df):
    return sorted(((r["id"], r["first"], r["second"]) for r in df.collect()), key=lambda r: (str(r[0]), str(r)))


def one_task(spark, path):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def by_ranges(spark, path):
    maps = csv_ranges.bit_maps(spark, path).checkpoint()
    rows = csv_ranges.records(spark, path, csv_ranges.first_bits(maps))
    return maps, rows.selectExpr("""from_csv(record, 'id string, first string, second string', map('escape', '"', 'multiLine', 'true')) AS r""").select("r.*")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task(spark, small_ranges, tmp_path, seed, end):
    rng = random.Random(seed)
    rows = [(i, rng.choice(WORDS), "".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))) for i in range(150)]
    path = written(tmp_path / "t.csv", rows, end)
    maps, got = by_ranges(spark, path)
    assert maps.count() > 8 and csv_ranges.lines_of(spark, path).rdd.getNumPartitions() > 8
    # in a file whose lines end in CRLF, the one-task reader also turns CRLF inside cells to LF; here cells stay as written
    same = [tuple(c and c.replace("\r\n", "\n") for c in r) if end == "\r\n" else r for r in cells(got)]
    assert same == cells(one_task(spark, path))
    want = sorted(((str(i), a or None, b or None) for i, a, b in rows), key=lambda r: (r[0], str(r)))
    assert cells(got) == want


def test_a_record_longer_than_several_ranges(spark, small_ranges, tmp_path):
    rows = [(1, "a", "b"), (2, "\n".join(f'line {i} "quoted", and more' for i in range(200)), "c"), (3, "d", "e\n")]
    path = written(tmp_path / "long.csv", rows)
    maps, got = by_ranges(spark, path)
    assert maps.where("NOT closed AND from_inside").count() > 5
    assert cells(got) == [(str(i), a, b) for i, a, b in rows]


def test_stray_quotes_do_not_open_cells(spark, small_ranges, tmp_path):
    path = tmp_path / "stray.csv"
    path.write_text('id,first,second\n' + "".join(f'{i},5" pipe {i},"x\ny"\n{i + 500},"say ""hi""\n",\'"\n' for i in range(60)))
    _, got = by_ranges(spark, str(path))
    assert cells(got) == cells(one_task(spark, str(path)))


def test_read_csv_takes_both_ways_and_many_files(spark, small_ranges, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    rows = [(i, f"word {i}", "x\ny" if i % 5 == 0 else "NA") for i in range(90)]
    for k in range(3):
        written(folder / f"p{k}.csv", rows[k::3])
    df = readers.read_csv(spark, str(folder))
    assert dict(df.dtypes) == {"id": "bigint", "first": "string", "second": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(i, a, None if b == "NA" else b) for i, a, b in rows]
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()
    plain = written(tmp_path / "plain.csv", [(i, 'say "hi", you', i / 2) for i in range(200)])
    df = readers.read_csv(spark, plain)
    assert dict(df.dtypes)["second"] == "double" and df.count() == 200 and df.rdd.getNumPartitions() > 8
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_header_only_and_empty_lines(spark, tmp_path):
    assert readers.read_csv(spark, written(tmp_path / "none.csv", [])).count() == 0
    path = tmp_path / "gaps.csv"
    path.write_text('id,first,second\n\n1,a,"b\nc"\n\n\n2,d,e')
    assert [tuple(r) for r in readers.read_csv(spark, str(path)).orderBy("id").collect()] == [(1, "a", "b\nc"), (2, "d", "e")]


@pytest.mark.parametrize(("line", "inside", "want"), [
    ("a,b", False, False), ('a,"b', False, True), ('b",c', True, False), ('a "quote" here', False, False), ('"a""', False, True),
    ('"a"""', False, False), ('""', True, True), ('x"y,"z', False, True), ('"a" b,"c', False, True), ('"a"\r', False, False), ("", True, True)])
def test_bit_of_a_line(line, inside, want):
    assert csv_ranges.ends_inside(line, inside) is want
