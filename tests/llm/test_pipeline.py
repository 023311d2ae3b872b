"""The stages one after another, and what each of them takes out."""

from __future__ import annotations

import pytest
from awkward import CLASHING, awkward_rows, prose

import corpus_pipeline
from wavebook.llm.toxicity import Machine, term_places

LINE = prose(500, 30)
ITEM = prose(600, 40)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(n, prose(2000 + n, 60) + (" scoundrel" if n % 3 == 0 else ""), "aa", "s", 5) for n in range(300)]
    rows += [(1000, prose(501, 40) + "\n" + LINE, "aa", "s", 5), (1001, prose(502, 40) + "\n" + LINE + "!", "aa", "s", 5)]
    near = prose(503, 100)
    rows += [(1010, near, "aa", "s", 5), (1011, near + " end", "aa", "s", 5)]
    rows += [(1020, ITEM + " " + prose(504, 20), "aa", "s", 5), (1021, prose(505, 900) + " " + ITEM[:90], "aa", "s", 5)]
    rows += [((k or 0) + 5000 if k is not None else None, t, None, None, None) for k, t in awkward_rows()]
    columns = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING)
    frame = spark.createDataFrame([(*r, *["1"] * len(CLASHING)) for r in rows], columns)
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(n, int(n % 3 == 0)) for n in range(300)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = kept["toxicity"]
    assert not [n for n in toxic if n is not None and n < 300 and n % 3 == 0]
    assert len([n for n in toxic if n is not None and n < 300]) == 200
    lines = kept["line dedup"]
    assert lines[1000] == toxic[1000] and lines[1001] == prose(502, 40)
    near = kept["near duplicates"]
    assert set(lines) - set(near) >= {1011} and 1010 in near
    clean = kept["decontamination"]
    assert set(near) - set(clean) == {1020}
    packed = {r.doc_id for r in docs.collect()}
    assert packed == set(clean)


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.length > 0 for r in rows)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_machine_counts_pairs():
    places = term_places("alpha beta gamma")
    import numpy as np

    chance = np.random.default_rng(0)
    machine = Machine(0.1, chance.normal(size=1 << 18), chance.normal(size=(1 << 18, 3)))
    pairs = sum(
        float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(places) for b in places[:n]
    )
    assert machine.raw(places) == pytest.approx(0.1 + machine.weights[places].sum() + pairs)
