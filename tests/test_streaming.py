"""Streams of files give what the batch gives."""

import json

from corpusloom.streaming import jobs


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"id": str(i), "text": ("これは十分に長い説明の文章である。" * 2 + str(i % 3)), "source": "s", "loaded_at": "2024-01-01T00:00:00"} for i in range(9)]
    rows.append({"id": "x", "text": "短い", "source": None, "loaded_at": "2024-01-01T00:00:00"})
    (src / "a.json").write_text("\n".join(map(json.dumps, rows)) + "\n{bad")
    stream = jobs.first_seen(jobs.cleaned(jobs.read(spark, str(src))))
    jobs.write(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 3 and out.where("est_tokens > 0").count() == 3
