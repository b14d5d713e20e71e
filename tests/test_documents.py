"""Documents with all their fields, reports in parts, and progress of a run."""

import json

import pytest
from pyspark.sql import functions as F

from foliowright.sources import pages as src
from foliowright.sources import sinks
from foliowright.streaming import pages as stream
from foliowright.streaming import progress

DOCUMENT = {
    "title": "T é", "n": 1, "s": "1", "nested": {"a": [1, "x", None, 1.5], "pages": [1]}, "z": None, "empty": {},
    "pages": [
        {"index": 0, "markdown": "a\n\"q\" é\u2028", "foo": {"k": [1, 2, {"x": None}]}, "bar": "7", "num": 7, "null": None},
        {"index": 1, "global_index": 5, "markdown": "", "header": "H"}, {"index": 2, "markdown": "third", "images": []},
    ],
}


def parts(folder):
    """What the files of a folder say, by name."""
    return "".join(p.read_text() for p in sorted(folder.rglob("part-*")))


def test_all_fields_come_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "v.json").write_text(json.dumps(DOCUMENT, indent=2))
    (tmp_path / "in" / "w.json").write_text(json.dumps(DOCUMENT["pages"], ensure_ascii=False))
    path = str(tmp_path / "in")
    pages, documents = src.read_whole_pages(spark, path), src.read_document_fields(spark, path)
    plain = src.read_pages(spark, path)
    assert sorted(pages.drop("extra").collect(), key=str) == sorted(plain.collect(), key=str)
    sinks.write_whole_documents(pages.repartition(3), str(tmp_path / "out"), documents)
    assert json.loads(parts(tmp_path / "out" / "volume=v")) == DOCUMENT
    assert json.loads(parts(tmp_path / "out" / "volume=w")) == {"pages": DOCUMENT["pages"]}


def test_pages_alone_and_documents_without_pages(spark, tmp_path):
    pages = spark.createDataFrame([("a", 0, 0, 0, "x", None, None), ("a", 3, 1, None, "y", "H", '{"k":1}')], "volume string, pos long, index long, global_index long, markdown string, header string, extra string")
    sinks.write_whole_documents(pages, str(tmp_path / "a"))
    assert json.loads(parts(tmp_path / "a" / "volume=a")) == {"pages": [{"index": 0, "global_index": 0, "markdown": "x"}, {"index": 1, "markdown": "y", "header": "H", "k": 1}]}
    documents = spark.createDataFrame([("a", '{"t":[1]}'), ("b", None), ("c", "{}")], "volume string, extra string")
    sinks.write_whole_documents(pages.drop("extra"), str(tmp_path / "b"), documents)
    assert json.loads(parts(tmp_path / "b" / "volume=a"))["t"] == [1]
    assert [json.loads(parts(tmp_path / "b" / f"volume={v}")) for v in "bc"] == [{"pages": []}, {"pages": []}]


def test_a_document_is_written_by_many_tasks(spark, tmp_path):
    pages = spark.range(20_000).select(F.lit("v").alias("volume"), F.col("id").alias("pos"), F.col("id").alias("index"), F.col("id").alias("global_index"), F.repeat(F.lit("text "), 20).alias("markdown"), F.lit(None).cast("string").alias("header"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_whole_documents(pages.repartition(4), str(tmp_path / "big"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "big" / "volume=v").glob("part-*"))
    assert len(files) > 1
    assert [p["index"] for p in json.loads(parts(tmp_path / "big" / "volume=v"))["pages"]] == list(range(20_000))


def test_pages_that_are_no_objects(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"other": []}')
    with pytest.raises(Exception, match="is expected"):
        src.read_whole_pages(spark, str(tmp_path / "x.json")).collect()


@pytest.mark.parametrize("n", [0, 1, 300_000])
def test_report_of_any_length(spark, tmp_path, n):
    rows = spark.range(n).select((F.col("id") % 1000).alias("count"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("w"), F.col("id"))).alias("word"))
    pairs = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    head = spark.range(1).select(F.lit(3).alias("total"), F.lit(None).cast("string").alias("note"))
    sinks.write_report_parts(head, {"words": (rows, [-F.col("count"), F.col("word")]), "pairs \"x\"": (pairs, [F.col("k")])}, str(tmp_path / "r"))
    got = json.loads("".join(parts(folder) for folder in sorted((tmp_path / "r").iterdir())))
    assert (got["total"], got["note"], got['pairs "x"']) == (3, None, [{"k": "a", "v": 1}, {"k": "a", "v": 1}, {"k": "b", "v": None}])
    assert len(got["words"]) == n
    keys = [(-w["count"], w["word"] is not None, w["word"] or "") for w in got["words"]]
    assert keys == sorted(keys)


def test_discovery_report_in_parts_equals_the_row(spark, tmp_path):
    from foliowright.operators import discovery, reports

    counts = spark.createDataFrame([("house", 50), ("houfe", 2), ("hovse", 1), ("lords", 40), ("lorda", 1)], "word string, n long")
    found = discovery.candidates(counts)
    sinks.write_report_parts(*reports.discovery_parts(counts, found), str(tmp_path / "d"))
    got = json.loads("".join(parts(folder) for folder in sorted((tmp_path / "d").iterdir())))
    assert got["error_candidates"] and got == json.loads(reports.discovery_report(counts, found).select(F.to_json(F.struct("*"))).first()[0])


def test_progress_while_it_runs(spark, tmp_path):
    for k in range(4):
        rows = spark.createDataFrame([("v", i, i, i, f"page {i}", None) for i in range(10 * k, 10 * k + 10)], stream.SCHEMA)
        rows.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    told = []
    rows = progress.run(spark, stream.read_stream(spark, str(tmp_path / "in"), files=1), stream.clean, str(tmp_path / "out"), str(tmp_path / "check"), total=40, told=told.append)
    assert [r["pages"] for r in rows] == [10, 20, 30, 40] and told == rows
    assert all(r["pages_per_second"] > 0 for r in rows)
    assert [r["seconds_left"] > 0 for r in rows] == [True, True, True, False]
    assert spark.read.schema(stream.SCHEMA).json(str(tmp_path / "out")).count() == 40
    # nothing new: no progress, and nothing is done twice
    again = progress.run(spark, stream.read_stream(spark, str(tmp_path / "in"), files=1), stream.clean, str(tmp_path / "out"), str(tmp_path / "check"), name="again")
    assert again == [] and spark.read.schema(stream.SCHEMA).json(str(tmp_path / "out")).count() == 40
