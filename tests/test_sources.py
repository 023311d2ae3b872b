import bz2
import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from wavebook.session import shared_folder
from wavebook.sources.definitions import _mounted, _unpacked, read_definitions, write_definitions
from wavebook.sources.responses import read_response_envelopes, read_responses, unpack_envelopes

CSV = 'vID,V1,V11.1,V2\n1,"zwei\nZeilen","sagt ""ja""",007\n2,"",,1.0\n3, x ,ä;ö,\n'


def test_text_is_taken_as_it_is(spark, tmp_path):
    (tmp_path / "wave.csv").write_text(CSV, encoding="utf-8")
    frame = read_responses(spark, str(tmp_path))
    assert set(dict(frame.dtypes).values()) == {"string"}
    assert [tuple(row) for row in frame.orderBy("vID").collect()] == [
        ("1", "zwei\nZeilen", 'sagt "ja"', "007"),
        ("2", "", None, "1.0"),
        ("3", " x ", "ä;ö", None),
    ]


def test_envelopes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, csv in enumerate([CSV, CSV.replace("\n1,", "\n11,"), "vID,V1,V11.1,V2\n4,a,b,c\n"]):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"data": csv}), encoding="utf-8")
    frame = read_response_envelopes(spark, str(tmp_path / "in"))
    assert frame.columns == ["vID", "V1", "V11.1", "V2"]
    assert sorted(row.vID for row in frame.collect()) == ["1", "11", "2", "2", "3", "3", "4"]
    assert frame.where("vID = '11'").first().V1 == "zwei\nZeilen"


def test_envelopes_share_a_folder_but_no_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(40):
        data = f'vID,V1\n{n},"a\nb"'
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"data": data}), encoding="utf-8")
    path = unpack_envelopes(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    files = [file for file in (tmp_path / "out").rglob("part-*") if file.is_file()]
    assert len(files) == 40 and len({file.parent for file in files}) == 1
    found = read_responses(spark, path).collect()
    assert sorted((int(row.vID), row.V1) for row in found) == [(n, "a\nb") for n in range(40)]


def test_envelope_without_responses(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"error": "none"}')
    with pytest.raises(Exception, match="no response text in .*bad.json"):
        read_response_envelopes(spark, str(tmp_path))


def test_columns_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("vID,V1\n1,x\n")
    (tmp_path / "b.csv").write_text("V1,vID\nx,1\n")
    with pytest.raises(Exception, match="header"):
        read_responses(spark, str(tmp_path)).select(F.count("vID"), F.count("V1")).collect()


def test_names_differing_by_case_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("vID,V1,v1\n1,x,y\n")
    with pytest.raises(ValueError, match="v1"):
        read_responses(spark, str(tmp_path))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_a_file_for_each_survey(spark, tmp_path):
    rows = [("a", "1"), ("ä+b c", "2"), ("a", "0"), (None, None), ("7", "zwei\nZeilen")]
    definitions = spark.createDataFrame(rows, "survey_id string, definition string").repartition(5)
    found = read_definitions(spark, write_definitions(definitions, str(tmp_path / "definitions")))
    assert {row.survey_id: row.definition for row in found.collect()} == {
        "a": "0\n1\n", "ä+b c": "2\n", "%": "\n", "7": "zwei\nZeilen\n",
    }
    assert not list(tmp_path.rglob(".*")), "no file is left unfinished, none has a checksum file"


def test_names_of_definition_files_meet_nowhere(spark, tmp_path):
    surveys = ["_a", ".a", "%", "%25", "", "-", "a/b", "a:b", "*", "a.json", "A"]
    definitions = spark.createDataFrame([(s, s) for s in surveys], "survey_id string, definition string")
    found = read_definitions(spark, write_definitions(definitions, str(tmp_path / "definitions")))
    rows = found.collect()
    assert sorted(row.definition for row in rows) == sorted(s + "\n" for s in surveys)
    assert len({row.survey_id for row in rows}) == len(surveys)


def test_only_mounted_paths_are_written_by_tasks(spark):
    assert _mounted(spark, "/tmp/a b") == _mounted(spark, "file:///tmp/a b") == "/tmp/a b"
    assert _mounted(spark, "file:/tmp/x") == "/tmp/x"
    assert _mounted(spark, "hdfs://host/tmp/x") is None and _mounted(spark, "s3a://b/x") is None


FILES = {
    "a.json": b"1\n", "ä+b c%41.json": "ä\r\nx".encode(), "bad.json": b"\xff\xfe", "d.e.json": b"2", "none": b"3",
    "empty.json": b"", "_hidden.json": b"4", ".hidden.json": b"5", "_x=1.json": b"6", "c._COPYING_": b"7",
    "p.json.gz": gzip.compress(b"8") + gzip.compress(b"9"), "q.json.bz2": bz2.compress(b"10"),
    "r.json.deflate": zlib.compress(b"11"), "e.gz": gzip.compress(b""),
    "s0/t.json": b"12", "s1/t.json": b"13", "s1/deep/u.json": b"14", "_s/v.json": b"15",
}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, content in FILES.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    return folder


@pytest.mark.parametrize("part", ["", "/", "/*", "/*.json", "/[a-d]*.json", "/{a,p}*", "/a.json", "/s?"])
def test_many_definition_files_are_read_as_few(spark, files, part):
    def found(rows):
        rows = rows.select("survey_id", F.hex("definition"))
        return sorted(map(tuple, rows.collect()))

    few = read_definitions(spark, f"{files}{part}")
    many = read_definitions(spark, f"file://{files}{part}", listed=0)
    assert few.dtypes == many.dtypes and few.inputFiles()
    assert found(few) == found(many) != []


def test_the_driver_holds_no_list_of_many_definition_files(spark, tmp_path):
    definitions = spark.range(40).selectExpr("cast(id as string) as survey_id", "'x' as definition")
    path = write_definitions(definitions, str(tmp_path / "definitions"))
    assert len(read_definitions(spark, path, listed=40).inputFiles()) == 40
    many = read_definitions(spark, path, listed=39)
    assert many.inputFiles() == []
    assert "Scan text" not in many._jdf.queryExecution().executedPlan().toString()
    assert many.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(row.survey_id, row.definition) for row in many.collect()} == {(str(n), "x\n") for n in range(40)}


def test_definition_files_of_partitions_and_of_no_folder(spark, tmp_path):
    for wave in (1, 2):
        (tmp_path / f"wave={wave}").mkdir()
        (tmp_path / f"wave={wave}" / f"{wave}.json").write_text("[]")
    assert {row.survey_id for row in read_definitions(spark, str(tmp_path), listed=0).collect()} == {"1", "2"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_definitions(spark, str(tmp_path / "none"), listed=0)


def test_definition_files_that_tasks_cannot_unpack(spark, tmp_path):
    spark.createDataFrame([("x",)], "definition string").coalesce(1).write.text(str(tmp_path / "in"), compression="snappy")
    assert [row.definition for row in read_definitions(spark, str(tmp_path / "in"), listed=0).collect()] == ["x\n"]
    with pytest.raises(ValueError, match="a.json.snappy.*tasks cannot unpack"):
        _unpacked(b"a.json.snappy", b"x")
