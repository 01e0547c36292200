"""Picture tags: small, described, text-only, missing, remote."""

import struct

from corpusloom.operators import images


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", w, h) + b"\0" * 8


def test_images(spark, tmp_path):
    (tmp_path / "s.png").write_bytes(png(10, 400))
    (tmp_path / "b.png").write_bytes(png(80, 60))
    (tmp_path / "t.png").write_bytes(png(81, 60))
    (tmp_path / "x.png").write_bytes(b"junk")

    def describe(data):
        return "TEXT_ONLY: 文字" if data[19] == 81 else "写真"

    rows = ["a\n\n![](s.png)\n\nb", "![名](b.png)", "p![](t.png)q", "![](none.png) ![](http://x/y.png) ![](x.png)", None, ""]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    got = [r["text"] for r in images.describe_images(df, str(tmp_path), describe).orderBy("i").collect()]
    assert got == ["ab", "\n\n### 図: 名\n![名](b.png)\n**説明**: 写真\n\n", "p\n\n文字\n\nq", rows[3], None, ""]
    assert images.picture_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)
    assert images.picture_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 7, 9) + b"\0") == (9, 7)
