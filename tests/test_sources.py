"""Remote listings and downloads over file:// addresses; page images."""

import io
import json

import numpy as np

from leafmill.sources import images, remote


def test_listing_and_fetch(spark, tmp_path):
    far, near = tmp_path / "far", tmp_path / "near"
    (far / "sub").mkdir(parents=True)
    near.mkdir()
    (far / "a.pdf").write_bytes(b"x" * 10)
    (far / "sub" / "b.pdf").write_bytes(b"y" * 20)
    (near / "kept.pdf").write_bytes(b"zzz")
    entries = [{"type": "file", "path": "a.pdf", "size": 10}, {"type": "directory", "path": "sub"}, {"type": "file", "path": "sub/b.pdf", "size": 99}, {"type": "file", "path": "kept.pdf", "size": 3}, {"type": "file", "path": "gone.pdf"}, {"type": "file", "path": "../out.pdf"}]
    (tmp_path / "tree.json").write_text(json.dumps(entries))
    listed = remote.list_files(spark, (tmp_path / "tree.json").as_uri(), far.as_uri())
    assert listed.count() == 5
    got = {r["path"]: (r["status"], r["bytes"], bool(r["message"])) for r in remote.fetch(listed, str(near), tries=1).collect()}
    assert got == {"a.pdf": ("fetched", 10, False), "sub/b.pdf": ("fetched", 20, True), "kept.pdf": ("skipped", 3, False), "gone.pdf": ("failed", 0, True), "../out.pdf": ("failed", 0, True)}
    assert (near / "sub" / "b.pdf").read_bytes() == b"y" * 20 and not (tmp_path / "out.pdf").exists()


def test_fetch_goes_on_after_a_break(spark, tmp_path):
    (tmp_path / "c.pdf.part").write_bytes(b"abc")

    def opener(url, start=0):
        assert start == 3
        return io.BytesIO(b"defg"), True

    rows = spark.createDataFrame([("c.pdf", 7, "far")], "path string, size long, url string")
    assert [tuple(r) for r in remote.fetch(rows, str(tmp_path), opener).collect()] == [("c.pdf", "fetched", 7, "")]
    assert (tmp_path / "c.pdf").read_bytes() == b"abcdefg"


def test_images():
    page = np.full((120, 160), 240, np.uint8)
    for y in range(20, 100, 10):
        page[y : y + 3, 20:140] = 10
    assert images.skew(page) == 0 and abs(images.skew(images._turned(page, 2.0)) + 2.0) <= 0.5
    assert images.grey(np.stack([page] * 3, -1)).shape == page.shape
    black = images.threshold(page)
    assert set(np.unique(black)) <= {0, 255} and black[21, 80] == 0 and black[5, 5] == 255
    speck = np.full((9, 9), 255, np.uint8)
    speck[4, 4] = 0
    assert images.denoise(speck).min() == 255

    def broken(_):
        raise ValueError

    assert images.prepare(page, (broken, images.grey)) is page
    read = images.page_reader(lambda c, p: page, lambda a: f" {a.shape[0]} ")
    assert read(b"", 1) == "120" and images.page_reader(broken, broken)(b"", 1) == ""
