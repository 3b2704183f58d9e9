"""Lines of growing files, cut anywhere, and a query that follows them over restarts."""

import json
import random

import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from footfall.sources import growing
from footfall.sources.growing import GrowingReader, lines_of, pieces, stream_growing_files


@pytest.mark.parametrize("split", [1, 2, 3, 7, 100])
@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_each_line_comes_once(tmp_path, monkeypatch, split, block):
    monkeypatch.setattr(growing, "BLOCK_BYTES", block)
    draw = random.Random(split)
    lines = ["x" * draw.choice([0, 0, 1, 2, 9]) for _ in range(40)]
    (tmp_path / "a").write_bytes("".join(line + "\n" for line in lines).encode())
    size = (tmp_path / "a").stat().st_size
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "a")) as file:
        found = [
            pair
            for piece in pieces("a", 0, size, split)
            for some, places in lines_of(file, piece)
            for pair in zip(places, some)
        ]
    assert [line.decode() for _, line in found] == lines
    at = 0
    for place, line in found:
        assert place == at
        at += len(line) + 1


def test_offsets_end_behind_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK_BYTES", 3)
    reader = GrowingReader({"path": str(tmp_path)})
    ends = lambda: json.loads(reader.latestOffset()["files"])
    assert ends() == {}
    (tmp_path / "a").write_text("one\ntwo\nthr")
    (tmp_path / "b").write_text("no end yet")
    (tmp_path / "_c").write_text("hidden\n")
    first = reader.latestOffset()
    assert json.loads(first["files"]) == {"a": 8}
    with open(tmp_path / "a", "a") as file:
        file.write("ee\r\nfour")
    second = reader.latestOffset()
    assert json.loads(second["files"]) == {"a": 8 + 7}
    got = [b for p in reader.partitions(first, second) for b in reader.read(p)]
    assert pa.Table.from_batches(got).to_pylist() == [{"value": "three", "file": "a", "position": 8}]
    assert reader.partitions(second, second) == []
    # A shorter file is a new one; a file that is gone is forgotten.
    (tmp_path / "a").write_text("new\n")
    (tmp_path / "b").unlink()
    third = reader.latestOffset()
    got = [b for p in reader.partitions(second, third) for b in reader.read(p)]
    assert pa.Table.from_batches(got)["value"].to_pylist() == ["new"]


def test_query_follows_files_over_restarts(spark, tmp_path):
    logs, out, checkpoint = (str(tmp_path / n) for n in ("logs", "out", "checkpoint"))
    (tmp_path / "logs").mkdir()

    def run():
        stream = stream_growing_files(spark, logs, suffix=".log", split_bytes=5)
        writer = stream.writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return {r.value: r.n for r in spark.read.parquet(out).groupBy("value").agg(F.count("*").alias("n")).collect()}

    def append(name, text):
        with open(tmp_path / "logs" / name, "a", encoding="utf-8") as file:
            file.write(text)

    append("a.log", "eins\nzwei\ndr")
    append("other.txt", "left out\n")
    assert run() == {"eins": 1, "zwei": 1}
    append("a.log", "ei\nvier\n")
    append("b.log", "fünf\n")
    assert run() == {"eins": 1, "zwei": 1, "drei": 1, "vier": 1, "fünf": 1}
    assert run() == {"eins": 1, "zwei": 1, "drei": 1, "vier": 1, "fünf": 1}
