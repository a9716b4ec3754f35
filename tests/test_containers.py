import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import titleloom as tl
from titleloom.sources import containers

SCHEMA = "name string, text string"


def files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.ziphuff"))


def read(spark, path):
    rows = containers.read_container_text(spark, str(path)).select(containers.container_name(F.col("path")).alias("name"), "text")
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def test_files_hold_what_was_written(spark, tmp_path):
    rows = [("a/b c%,3", "hello"), ("a/b c%,3", "again"), (None, "no name"), ("ü+.ziphuff", "ñ😀"), ("gone", None), ("empty", ""), ("..", "dots")]
    path = tmp_path / "out"
    containers.write_container_files(tl.compress_alone(spark.createDataFrame(rows, SCHEMA), tasks=2), str(path))
    assert read(spark, path) == sorted((row for row in rows if row[1]), key=repr)
    assert len(files(path)) == 5 and not (path / "_writing").exists()
    one = tl.compress_alone(spark.createDataFrame([("n" * 1000, "long name")], SCHEMA))
    containers.write_container_files(one, f"file://{path}")
    assert len(read(spark, path)) == 6
    containers.write_container_files(one, str(path), overwrite=True)
    ((name, text),) = read(spark, path)
    assert name.startswith("nnn") and text == "long name"


def test_files_of_an_odd_random_text(spark, tmp_path):
    draw = random.Random(4)
    rows = [(str(i), "".join(draw.choices("abcñ\n 😀", k=draw.choice([1, 40, 4000])))) for i in range(80)]
    containers.write_container_files(tl.compress_alone(spark.createDataFrame(rows, SCHEMA)), str(tmp_path / "out"))
    assert read(spark, tmp_path / "out") == sorted(rows, key=repr)


def batch(*names):
    return iter([pa.RecordBatch.from_pydict({"name": list(names), "content": [b"x"] * len(names)})])


def test_only_committed_attempts_are_seen(tmp_path):
    """A task that ran twice, and one whose attempt failed."""
    writer = containers.ContainerWriter({"path": str(tmp_path)}, False)
    writer.write(batch("a", "b"))
    second, other = writer.write(batch("a", "b")), writer.write(batch())
    assert {name.split("/")[0] for name in files(tmp_path)} == {"_writing"}
    writer.commit([second, other, None])
    assert [name.split("/")[1] for name in files(tmp_path)] == ["a,0.ziphuff", "b,1.ziphuff"]
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["part"]


def test_abort_leaves_nothing(tmp_path):
    kept = containers.ContainerWriter({"path": str(tmp_path)}, False)
    kept.commit([kept.write(batch("old"))])
    running = containers.ContainerWriter({"path": str(tmp_path)}, False)
    done = running.write(batch("running"))
    failed = containers.ContainerWriter({"path": str(tmp_path)}, True)
    failed.write(batch("new"))
    failed.abort([None])
    running.commit([done])
    assert [name.split("/")[1] for name in files(tmp_path)] in (["old,0.ziphuff", "running,0.ziphuff"], ["running,0.ziphuff", "old,0.ziphuff"])
    assert not (tmp_path / "_writing").exists()


def test_a_failing_job_leaves_the_files_there(spark, tmp_path):
    path = tmp_path / "out"
    rows = tl.compress_alone(spark.createDataFrame([("a", "text")], SCHEMA))
    containers.write_container_files(rows, str(path))
    before = files(path)
    broken = rows.withColumn("blob", F.when(F.raise_error(F.lit("broken")).isNull(), F.col("blob")))
    with pytest.raises(Exception, match="broken"):
        containers.write_container_files(broken, str(path), overwrite=True)
    assert files(path) == before and not (path / "_writing").exists()


def test_titles_from_files(spark, tmp_path):
    rows = [(f"f{i}", "id,title,url\n" + "".join(f'{i}{j},"t ""{j}""\nx",u{j}\n' for j in range(i))) for i in range(4)]
    containers.write_container_files(tl.compress_alone(spark.createDataFrame(rows, SCHEMA)), str(tmp_path / "out"))
    got = sorted((r.id, r.title, r.url) for r in containers.read_titles_container(spark, str(tmp_path / "out")).collect())
    assert got == sorted((f"{i}{j}", f't "{j}"\nx', f"u{j}") for i in range(4) for j in range(i))
