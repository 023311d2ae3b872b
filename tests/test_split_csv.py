"""Files read by many tasks against the same files read by one task each."""

import random

import pyarrow as pa
import pytest

from wavebook.sources import split_csv
from wavebook.sources.responses import read_responses


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def answer(chance):
    text = "".join(chance.choice(["a", "ä", ",", "\n", '"', '""', " ", "\r\n", "漢", "x" * 9]) for _ in range(chance.randrange(12)))
    return chance.choice([text, text, "", "007", " b ", "\n" * chance.randrange(3)])


def field(chance):
    text = answer(chance)
    bare = not set(text) & set(',"\n\r')
    return text if bare and chance.random() < 0.7 else '"' + text.replace('"', '""') + '"'


def write(path, seed, rows, end="\n", long=0):
    chance = random.Random(seed)
    lines = ["vID,V1,V11.1,V2"]
    for n in range(rows):
        lines.append(",".join([str(n), *(field(chance) for _ in range(3))]))
    if long:
        lines.insert(rows // 2, '-1,"' + 'line ""of"" it,\n' * long + '",,x')
    path.write_text(end.join(lines) + end * chance.randrange(3), encoding="utf-8", newline="")


def same(spark, path, split=True):
    many = read_responses(spark, str(path))
    one = read_responses(spark, str(path), split_above=1 << 40)
    assert many.columns == one.columns
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)
    found = "MapInArrow" in many._jdf.queryExecution().toString()
    assert found == split
    return many


@pytest.mark.parametrize("seed", range(4))
def test_equals_one_task_a_file(spark, tmp_path, small_ranges, seed):
    for n in range(2):
        write(tmp_path / f"{n}.csv", 10 * seed + n, 300, "\r\n" if seed == 2 else "\n", long=200 * n)
    many = same(spark, tmp_path)
    assert many.rdd.getNumPartitions() > 8


def test_an_answer_over_many_ranges(spark, tmp_path, small_ranges):
    write(tmp_path / "wave.csv", 5, 40, long=600)
    found = split_csv.ranges(spark, str(tmp_path))
    assert found.count() > 10 and found.where("inside").count() > 5
    assert same(spark, tmp_path).where("vID = '-1'").first()["V1"].count("line") == 600


def test_a_header_over_two_ranges_and_every_break(spark, tmp_path, small_ranges):
    """The same file with a comment moved along, so that ranges end at each place of a record."""
    for shift in range(0, 60, 7):
        folder = tmp_path / str(shift)
        folder.mkdir()
        rows = "".join(f'{n},"a\n""b""\n",{n}\n' for n in range(200))
        (folder / "a.csv").write_text('vID,"V\n1",V2\n' + "0," + "y" * shift + ",0\n" + rows, encoding="utf-8")
        same(spark, folder)
    wide = tmp_path / "wide"
    wide.mkdir()
    (wide / "a.csv").write_text('vID,"V' + "\n1" * 900 + '"\n' + "".join(f"{n},b\n" for n in range(300)))
    same(spark, wide)


@pytest.mark.parametrize("line", ['7,5" pipe,x,y', '7,"a" b,x,y', '7,a",x,y', '7,"never closed,x,y', "7,x,y,z\r"])
def test_what_breaks_the_format_is_left_to_the_other_reader(spark, tmp_path, small_ranges, line):
    write(tmp_path / "wave.csv", 6, 200)
    with open(tmp_path / "wave.csv", "a", encoding="utf-8", newline="") as file:
        file.write("1,2,3,4\n" + line + "\n")
    found = split_csv.ranges(spark, str(tmp_path))
    assert split_csv.need_one_task(found)
    same(spark, tmp_path, split=False)


def test_short_rows_and_empty_lines(spark, tmp_path, small_ranges):
    rows = "".join(f"{n}\n\n{n},a\n{n},,\n \n{n},a,b,c\n" for n in range(100))
    (tmp_path / "wave.csv").write_text("\nvID,V1,V2\n" + rows, newline="")
    same(spark, tmp_path)


def test_a_break_in_the_header_of_a_file_with_other_ends(spark, tmp_path, small_ranges):
    rows = "".join(f'{n},"a\n",b\r\n' for n in range(300))
    (tmp_path / "wave.csv").write_text('vID,"V\n1",V2\r\n' + rows, newline="")
    read_responses(spark, str(tmp_path)).collect()
    assert split_csv.need_one_task(split_csv.ranges(spark, str(tmp_path)))


def test_another_header_is_refused(spark, tmp_path, small_ranges):
    rows = "".join(f"{n},x\n" for n in range(500))
    (tmp_path / "a.csv").write_text("vID,V1\n" + rows)
    (tmp_path / "b.csv").write_text("V1,vID\n" + rows)
    with pytest.raises(Exception, match="header"):
        read_responses(spark, str(tmp_path)).collect()


def test_changed_files_are_noticed(spark, tmp_path, small_ranges):
    write(tmp_path / "wave.csv", 7, 200)
    frame = read_responses(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    with pytest.raises(Exception, match="read them again"):
        frame.collect()


def test_records_are_handed_on_by_batch():
    lines = ["vID,V1", "", *(line for n in range(500) for line in (f'{n},"a', "", 'b"', f"{n},c")), '9,"open']
    count = len(lines)
    columns = [pa.array(lines), *(pa.array([n] * count, pa.int64()) for n in (7, 0))]
    batch = pa.RecordBatch.from_arrays(
        [*columns, pa.array([False] * count), pa.array([False] * count)], ["value", "file", "start", "inside", "crlf"]
    )
    whole = [found for found in split_csv._assembled(iter([batch]), whole=True) if len(found)]
    assert len(whole) == 1, "not a batch for each record"
    rows = whole[0].to_pylist()
    assert [row["record"] for row in rows] == [
        "vID,V1", *(text for n in range(500) for text in (f'{n},"a\n\nb"', f"{n},c"))
    ]
    assert [row["heading"] for row in rows] == [True] + [False] * 1000
    fragments = [found.to_pylist() for found in split_csv._assembled(iter([batch]), whole=False) if len(found)]
    assert [[row["record"] for row in found] for found in fragments] == [['9,"open']]
