"""Files under their own names, all or none."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import files, sink


def seen(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) if folder.exists() else []


def hidden(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith(".")) if folder.exists() else []


def table(spark, n, width=10):
    return spark.range(n).select(F.col("id").alias("i"), F.repeat(F.lit("가"), width).alias("s"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("file"))


def test_one_named_file(spark, tmp_path):
    path = tmp_path / "out" / "rows.jsonl"
    files.write_jsonl_file(table(spark, 50).repartition(7), str(path), ["i"])
    lines = [json.loads(x) for x in path.read_text().splitlines()]
    assert [x["i"] for x in lines] == list(range(50)) and lines[0] == {"i": 0, "s": "가" * 10, "file": None}
    files.write_jsonl_file(table(spark, 3), f"file:{path}", ["i"], overwrite=False)
    assert [json.loads(x)["i"] for x in path.read_text().splitlines()] == [*range(50), 0, 1, 2]
    files.write_jsonl_file(table(spark, 2), str(path), ["i"])
    assert len(path.read_text().splitlines()) == 2 and seen(path.parent) == ["rows.jsonl"] and hidden(path.parent) == []
    files.write_jsonl_file(table(spark, 0), str(tmp_path / "new" / "none.jsonl"))
    assert seen(tmp_path / "new") == []  # no rows, no file


def test_split_files_are_files(spark, tmp_path):
    """Equal counts in order; what an earlier write left over goes, other files stay."""
    (tmp_path / "other.jsonl").write_text("{}\n")
    (tmp_path / "out_9x.jsonl").write_text("{}\n")
    df = table(spark, 1000, 400).repartition(5)
    n = files.write_multi_jsonl(df, str(tmp_path), "out", ["i"], 0.25)
    assert n == 5 and seen(tmp_path) == ["other.jsonl", *[f"out_{k}.jsonl" for k in range(5)], "out_9x.jsonl"]
    got = [[json.loads(x)["i"] for x in (tmp_path / f"out_{k}.jsonl").read_text().splitlines()] for k in range(5)]
    assert got == [list(range(200 * k, 200 * k + 200)) for k in range(5)]
    assert files.write_multi_jsonl(table(spark, 10), str(tmp_path), "out", ["i"]) == 1
    assert seen(tmp_path) == ["other.jsonl", "out_0.jsonl", "out_9x.jsonl"] and hidden(tmp_path) == []


def test_a_task_that_fails_halfway_leaves_no_file(spark, tmp_path):
    """Old files stay as they were; nothing new is seen, nothing is left staged."""
    files.write_multi_jsonl(table(spark, 40, 3000), str(tmp_path), "out", ["i"], 0.1)
    before = {p.name: p.read_text() for p in tmp_path.iterdir()}
    bad = table(spark, 5000, 300).withColumn("s", F.when(F.col("i") == 4321, F.raise_error(F.lit("half way")).cast("string")).otherwise(F.col("s")))
    rows = bad.select(F.concat(F.lit("out_"), (F.col("i") / 500).cast("int").cast("string"), F.lit(".jsonl")).alias("file"), F.to_json(F.struct("i", "s")).alias("line"))
    for overwrite in (True, False):
        with pytest.raises(Exception, match="half way"):
            sink.write_lines(rows.repartition(4, "file").sortWithinPartitions("file"), str(tmp_path), r"out_\d+\.jsonl", overwrite)
        assert {p.name: p.read_text() for p in tmp_path.iterdir()} == before


def test_a_file_from_several_tasks_is_refused(spark, tmp_path):
    rows = spark.range(100).select(F.lit("a.txt").alias("file"), F.col("id").cast("string").alias("line"))
    with pytest.raises(Exception, match="several tasks"):
        sink.write_lines(rows.repartition(3), str(tmp_path))
    mixed = rows.withColumn("file", F.when(F.col("line") % 2 == 0, "a.txt").otherwise("b.txt")).coalesce(1)
    with pytest.raises(Exception, match="sorted by file"):
        sink.write_lines(mixed, str(tmp_path))
    for name in (None, "../a", ".a"):
        with pytest.raises(Exception, match="no name of a file"):
            sink.write_lines(rows.withColumn("file", F.lit(name).cast("string")).coalesce(1), str(tmp_path))
    assert seen(tmp_path) == [] == hidden(tmp_path)


@pytest.mark.parametrize("after", [0, 1, 3, 4])
def test_a_commit_that_dies_is_finished(tmp_path, monkeypatch, after):
    """The journal holds what is left to do, whenever the driver stops after it; before it nothing is seen."""
    import pyarrow as pa
    from pyarrow import fs

    (tmp_path / "f_0.txt").write_text("old\n")
    (tmp_path / "f_8.txt").write_text("old\n")
    writer = sink.Writer(str(tmp_path), r"f_\d\.txt", False)
    batch = lambda names: pa.RecordBatch.from_pydict({"file": [f"f_{n}.txt" for n in names], "line": [str(n) for n in names]})
    told = [writer.write(iter([batch([0, 0, 1]), batch([1, 2])])), writer.write(iter([])), writer.write(iter([batch([3])])), None]
    assert seen(tmp_path) == ["f_0.txt", "f_8.txt"]
    moves = [0]

    real = fs.LocalFileSystem()

    class Local:
        def __getattr__(self, name):
            return getattr(real, name)

        def move(self, a, b):
            if moves[0] == after:
                raise KeyboardInterrupt
            moves[0] += 1
            real.move(a, b)

    with monkeypatch.context() as m:
        m.setattr(sink, "place", lambda path: (Local(), path))
        with pytest.raises(KeyboardInterrupt):
            writer.commit(told)
    if after == 0:  # no journal yet
        assert seen(tmp_path) == ["f_0.txt", "f_8.txt"] and (tmp_path / "f_0.txt").read_text() == "old\n" and sink.recover(str(tmp_path)) == 0
        writer.abort(told)
        return
    assert sink.recover(str(tmp_path)) == 1 and sink.recover(str(tmp_path)) == 0
    assert seen(tmp_path) == [f"f_{k}.txt" for k in range(4)] and hidden(tmp_path) == []
    assert [(tmp_path / f"f_{k}.txt").read_text() for k in range(4)] == ["0\n0\n", "1\n1\n", "2\n", "3\n"]
