"""Survey definitions: JSON text in, one typed row per question out.

A definition is one JSON array of questions. Some fields arrive as ``[]`` where an
empty map or nothing is meant, so those are first read as plain text and then parsed.
"""

from __future__ import annotations

import bz2
import gzip
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.session import new_folder

# ---- fixed values: the question layout and its enumerations ----
DEFINITION_SCHEMA = """array<struct<
    id: string, pollId: string, pageId: string, position: string, type: string,
    question: string, description: string, anonym: string, mandatory: string,
    groups: array<struct<
        name: string, inputType: string, labels: array<string>, `range`: array<double>,
        varnames: array<string>, codes: array<string>,
        items: array<struct<id: string, name: string>>>>>>"""
QUESTION_TYPES = ["MATRIX", "CHOICE", "SCALE", "INPUT", "RANKING"]
INPUT_TYPES = [
    "SINGLELINE", "MULTILINE", "INTEGER", "FLOAT", "DATE", "TIME", "CAPTCHA", "UPLOAD",
]
# ---- end of fixed values ----


#: Definition files up to which the driver lists them and Spark's reader reads them.
LISTED = 10_000

#: How packed files are read by tasks, by ending; others that Spark's reader unpacks.
UNPACK = {b".gz": gzip.decompress, b".bz2": bz2.decompress, b".deflate": zlib.decompress}
UNREAD = {b".lz4", b".snappy", b".zst"}

#: Bytes of definitions that a reading task hands on together.
BATCH_BYTES = 4 * 1024 * 1024


def read_definitions(spark: SparkSession, path: str, listed: int = LISTED) -> DataFrame:
    """Definition files, one survey each; the survey id is the file name without ending.

    Spark's reader holds the status of every file in the driver and gives a task 32 small files.
    More than ``listed`` files in a mounted file system are listed and read by tasks instead.
    """
    places = _places(spark, path, listed)
    if places is None:
        # The name arrives percent-encoded, a plus sign as itself.
        encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
        name = F.url_decode(encoded)
        files = spark.read.text(path, wholetext=True).select(name.alias("name"), F.col("value").alias("definition"))
    else:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        folders = spark.createDataFrame(places, "folder binary, pattern string")
        names = folders.repartition(min(tasks, len(places))).mapInArrow(_listed, "folder binary, file binary")
        read = names.repartition(tasks, "folder", "file").mapInArrow(_contents, "name binary, definition binary")
        files = read.select(F.col("name").cast("string"), F.col("definition").cast("string"))
    return files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("survey_id"), "definition")


def write_definitions(definitions: DataFrame, target: str | None = None) -> str:
    """(survey_id, definition) to definition files, one per survey; returns their path.

    Rows of one survey are lines of its file. The target lies in the shared folder unless given.
    There is a folder for each task, so that neither writing nor listing goes survey by survey
    through the driver. A file is named after its survey, what no file name can hold as %XX. In a
    file system that is mounted the tasks write the files themselves; Spark's writer, which other
    file systems get, starts four processes there for each file, to set its rights.
    """
    spark = definitions.sparkSession
    target = target or new_folder(spark, "definitions")
    rows = definitions.select("survey_id", "definition")
    mounted = _mounted(spark, target)
    if mounted is None:
        rows.select("definition", "survey_id").write.partitionBy("survey_id").mode("errorifexists").text(target)
        return f"{target}/survey_id=*"
    if os.path.exists(mounted):
        raise FileExistsError(mounted)
    together = (
        rows.select("survey_id", F.col("definition").cast("binary").alias("definition"))
        .repartition("survey_id")
        .sortWithinPartitions("survey_id", "definition")
    )
    together.mapInArrow(lambda batches: _written(mounted, batches), "files long").agg(F.sum("files")).collect()
    return f"{target}/*"


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it by themselves, or null."""
    found = re.fullmatch(r"(?:(\w[\w+.-]*):(?://)?)?(/.*)", path)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    scheme = found and (found[1] or default.partition(":")[0])
    return found[2] if scheme == "file" else None


def _places(spark: SparkSession, path: str, listed: int) -> list[tuple[bytes, str | None]] | None:
    """Folders that hold more than ``listed`` definition files, each with a pattern of their names.

    Null if there are no more, or only Spark can open the path or unpack the files. Names are looked
    at one by one up to the limit: what is kept is a row for each folder.
    """
    mounted = _mounted(spark, path) if isinstance(path, str) else None
    folder, _, name = (mounted or "").rstrip("/").rpartition("/")
    if not os.path.isdir(folder) or re.search(r"[{}\[\]*?\\]", folder) or "/" in name:
        return None
    if not re.search(r"[{}\[\]*?\\]", name):
        places = [(os.fsencode(mounted), None)] if os.path.isdir(mounted) else []
    else:
        # Hadoop's own reading of the pattern
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(name).compiled().pattern()
        places, files = [], False
        with os.scandir(folder) as entries:
            for entry in entries:
                if re.fullmatch(pattern, entry.name, re.DOTALL):
                    if entry.is_dir():
                        places.append((os.fsencode(entry.path), None))
                    else:
                        files = True
        if files:
            places.append((os.fsencode(folder), pattern))
    found = itertools.chain.from_iterable(itertools.starmap(_files, places))
    seen = [os.path.splitext(name)[1] for _, name in itertools.islice(found, listed + 1)]
    return places if len(seen) > listed and UNREAD.isdisjoint(seen) else None


def _files(folder: bytes, pattern: str | None = None) -> Iterator[tuple[bytes, bytes]]:
    """Folder and name of a folder's files that Spark would read; with a pattern, those that match it.

    Hidden files are left out, and folders but those of partitions, ``name=value``.
    """
    with os.scandir(folder) as entries:
        for entry in entries:
            name = os.fsdecode(entry.name)
            hidden = name.startswith(".") or (name.startswith("_") and "=" not in name)
            if hidden or name.endswith("._COPYING_"):
                continue
            if not entry.is_dir():
                if pattern is None or re.fullmatch(pattern, name, re.DOTALL):
                    yield folder, entry.name
            elif pattern is None and "=" in name:
                yield from _files(entry.path)


def _batch(names: list[str], rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in columns], names)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of folders, a row each."""
    for batch in batches:
        for place in batch.to_pylist():
            found = _files(place["folder"], place["pattern"])
            for rows in itertools.batched(found, 10_000):
                yield _batch(["folder", "file"], rows)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names and contents of files; an empty file gives no row, as with Spark's reader."""
    rows, size = [], 0
    for batch in batches:
        for folder, name in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            with open(os.path.join(folder, name), "rb") as file:
                content = file.read()
            if content:
                rows.append((name, _unpacked(name, content)))
                size += len(rows[-1][1])
            if size >= BATCH_BYTES or len(rows) >= 10_000:
                yield _batch(["name", "definition"], rows)
                rows, size = [], 0
    yield _batch(["name", "definition"], rows)


def _unpacked(name: bytes, content: bytes) -> bytes:
    """A file's content; the ending of its name tells how it is packed, as for Spark's reader."""
    ending = os.path.splitext(name)[1]
    if ending in UNREAD:
        raise ValueError(f"{name!r}: tasks cannot unpack it; with a larger `listed` Spark's reader does")
    return UNPACK.get(ending, bytes)(content)


def _file_name(survey: str | None) -> str:
    if not survey:
        return "%.json" if survey is None else "%-.json"
    unsafe = r"^[._]|[^\w .+,;@=()'!~-]"
    return re.sub(unsafe, lambda m: "".join(f"%{byte:02X}" for byte in m[0].encode()), survey) + ".json"


def _written(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write rows sorted by survey; a file appears under its name once it is whole."""
    task = TaskContext.get()
    own = f"{folder}/{task.partitionId():06d}"
    unfinished = f"{own}/.{task.taskAttemptId()}"
    files, current, out = 0, None, None
    for batch in batches:
        for survey, definition in zip(*(column.to_pylist() for column in batch.columns)):
            if out is None or survey != current:
                if out is None:
                    os.makedirs(own, exist_ok=True)
                else:
                    out.close()
                    os.replace(unfinished, f"{own}/{_file_name(current)}")
                current, out, files = survey, open(unfinished, "wb"), files + 1
            out.write((definition or b"") + b"\n")
    if out is not None:
        out.close()
        os.replace(unfinished, f"{own}/{_file_name(current)}")
    yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])


def read_questions(definitions: DataFrame) -> DataFrame:
    """(survey_id, definition) to one row per question, in definition order.

    Position and page rank are taken inside the definition's own row, so no question
    is shuffled. A definition that cannot be read, or holds no question, gives one
    row without a position; :func:`definition_violations` reports it.
    """
    parsed = definitions.select(
        F.col("survey_id").cast("string").alias("survey_id"),
        F.from_json("definition", DEFINITION_SCHEMA).alias("questions"),
    )
    ids = F.transform("questions", lambda q: q["id"])
    pages = F.transform("questions", lambda q: q["pageId"].try_cast("bigint"))
    exploded = parsed.select(
        "survey_id",
        F.array_sort(F.array_distinct(pages)).alias("pages"),
        (F.array_size(F.array_distinct(ids)) == F.array_size(ids)).alias("unique_question_ids"),
        F.posexplode_outer("questions").alias("index", "q"),
    )
    return exploded.select(
        "survey_id",
        (F.col("index") + 1).cast("bigint").alias("question_position"),
        F.array_position("pages", F.col("q.pageId").try_cast("bigint")).alias("page_number"),
        "unique_question_ids",
        F.col("q.id").try_cast("bigint").alias("question_id"),
        F.col("q.pollId").try_cast("bigint").alias("poll_id"),
        F.col("q.pageId").try_cast("bigint").alias("page_id"),
        F.col("q.position").alias("position"),
        F.col("q.type").alias("type"),
        F.col("q.question").alias("question"),
        F.col("q.description").alias("description"),
        F.coalesce(F.col("q.anonym").try_cast("boolean"), F.lit(False)).alias("anonym"),
        F.coalesce(F.col("q.mandatory").try_cast("boolean"), F.lit(False)).alias("mandatory"),
        F.col("q.groups").alias("groups"),
    )


def _language_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def _map_or_empty(text: Column) -> Column:
    """``[]`` is an empty map; a missing field stays null."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.when(text == "[]", empty).otherwise(_language_map(text))


def normalize_questions(questions: DataFrame) -> DataFrame:
    """Parse the language maps and repair the empty lists standing for maps or nothing."""

    def item(raw: Column) -> Column:
        return F.struct(raw["id"].alias("id"), _map_or_empty(raw["name"]).alias("name"))

    def group(raw: Column) -> Column:
        return F.struct(
            _map_or_empty(raw["name"]).alias("name"),
            raw["inputType"].alias("input_type"),
            F.transform(raw["labels"], _map_or_empty).alias("labels"),
            F.when(F.array_size(raw["range"]) > 0, raw["range"]).alias("range"),
            raw["varnames"].alias("varnames"),
            raw["codes"].alias("codes"),
            F.transform(raw["items"], item).alias("items"),
        )

    position = F.col("position").try_cast("bigint")
    parsed = F.struct(
        position.alias("position"),
        (F.col("position").isNotNull() & (F.coalesce(position, F.lit(0)) < 1)).alias(
            "has_bad_position"
        ),
        _language_map(F.col("question")).alias("question"),
        _language_map(F.col("description")).alias("description"),
        F.transform("groups", group).alias("groups"),
    )
    kept = [c for c in questions.columns if c not in ("position", "question", "description", "groups")]
    # As the output of a generator the parsed fields are computed once per question:
    # a filter on anything derived from them is not pushed below, where the parsing
    # would be repeated for every place the filter mentions it.
    return questions.select(*kept, F.inline(F.array(parsed)))


def definition_violations() -> Column:
    """Messages about fields that are missing or out of bounds, for normalized rows."""

    def below_one(name: str) -> Column:
        return F.coalesce(F.col(name) < 1, F.lit(True))

    def any_group(test) -> Column:
        return F.coalesce(F.exists("groups", test), F.lit(False))

    def incomplete(group: Column) -> Column:
        return (
            group["name"].isNull()
            | group["labels"].isNull()
            | group["varnames"].isNull()
            | group["codes"].isNull()
            | group["items"].isNull()
        )

    checks = [
        (~F.coalesce("unique_question_ids", F.lit(True)), "question ids are not unique"),
        (below_one("question_id"), "id must be a whole number of at least 1"),
        (below_one("poll_id"), "pollId must be a whole number of at least 1"),
        (below_one("page_id"), "pageId must be a whole number of at least 1"),
        (F.col("has_bad_position"), "position must be a whole number of at least 1"),
        (~F.coalesce(F.col("type").isin(QUESTION_TYPES), F.lit(False)), "type is not known"),
        (any_group(incomplete), "a group lacks name, labels, varnames, codes or items"),
        (
            any_group(lambda g: ~g["input_type"].isin(INPUT_TYPES)),
            "inputType is not known",
        ),
        (
            any_group(lambda g: g["range"].isNotNull() & (F.array_size(g["range"]) != 3)),
            "range must hold minimum, maximum and step",
        ),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in checks]))


def is_unreadable() -> Column:
    """The one row standing for a definition without a readable question."""
    return F.col("question_position").isNull()
