import struct

import numpy as np
import pytest

from tilewright.operators import rasters as R
from tilewright.sources import images as I

OUTLINE = np.array([(1037, 2213), (5121, 2003), (6890, 4417), (4400, 7311), (1500, 6100)])  # fixed values of a case


def rectangle(x0, y0, x1, y1):
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def grid(region, size, step, slide=None):
    return [(x, y) for x, y, _ in R.tiles_of(region, size, step, slide)]


def test_tiles_of_boxes():
    assert grid([(rectangle(0, 0, 1000, 450), [])], 224, 224) == [(x, y) for x in (0, 224, 448, 672, 896) for y in (0, 224, 448)]
    assert grid([(rectangle(0, 0, 1000, 450), [])], 224, 224, (1000, 460)) == [(x, y) for x in (0, 224, 448, 672) for y in (0, 224)]
    assert min(grid([(rectangle(10, 10, 300, 300), [])], 224, 200)) == (0, 0)
    assert grid([(rectangle(0, 0, 224, 224), []), (rectangle(224, 224, 448, 448), [])], 224, 224) == [(0, 0), (224, 224)]
    assert grid([(rectangle(0, 0, 225, 224), [])], 224, 224) == [(0, 0), (224, 0)]
    assert grid([], 224, 224) == []


def test_tiles_cover_an_outline():
    for step in (224, 200):
        found = list(R.tiles_of([(OUTLINE, [])], 224, step))
        if step == 224:  # tiles side by side: the parts of the outline add up
            assert abs(sum(s for _, _, s in found) * 224 * 224 - R.ring_area(OUTLINE)) < 1e-3
        inside = np.random.default_rng(1).uniform(OUTLINE.min(0), OUTLINE.max(0), (400, 2))
        for x, y in inside:
            if R.contains(OUTLINE, x, y):
                assert any(a <= x <= a + 224 and b <= y <= b + 224 for a, b, _ in found)
    solid = list(R.tiles_of([(OUTLINE, [])], 224, 224, least_share=0.999999))
    assert 0 < len(solid) < len(list(R.tiles_of([(OUTLINE, [])], 224, 224)))


def test_holes_and_islands():
    outer, hole, island = rectangle(0, 0, 400, 400), rectangle(100, 100, 300, 300), rectangle(150, 150, 250, 250)
    share = lambda regions: sum(s for _, _, s in R.tiles_of(regions, 100, 100)) * 10_000
    assert abs(share([(outer, [hole])]) - 120_000) < 1e-6
    assert abs(share([(outer, [hole]), (island, [])]) - 120_000) < 1e-6  # it lies in a hole that stays
    assert abs(share([(outer, []), (island, [])]) - 160_000) < 1e-6  # its hole was too small to stay
    assert (100, 100) not in grid([(outer, [hole])], 100, 100)


def test_borders_of_a_ring_with_an_island():
    mask = np.zeros((12, 14), np.uint8)
    mask[1:11, 1:13] = 255
    mask[3:9, 3:11] = 0
    mask[5:7, 6:8] = 255
    found = R.borders(mask)
    assert [b.hole for b in found] == [False, True, False] and found[1].parent == 0
    assert found[0].area == 9 * 11 and found[2].area == 1  # through the centres of the pixels
    assert found[1].area == 7 * 9 - 4 * 0.5 and len(found[0].points) == 2 * (11 + 9)
    kept = R.tissue_borders(found, 5, 10, 8)
    assert len(kept) == 1 and len(kept[0][1]) == 1
    assert R.borders(np.zeros((3, 3), np.uint8)) == [] and len(R.borders(np.eye(3, dtype=np.uint8))) == 1
    assert R.borders(np.ones((1, 1), np.uint8))[0].points.tolist() == [[0, 0]]


def test_borders_of_random_masks():
    rng = np.random.default_rng(4)
    for _ in range(60):
        mask = (rng.random((rng.integers(1, 14), rng.integers(1, 14))) < rng.random()).astype(np.uint8)
        label = np.zeros(mask.shape, int)
        n = 0
        for start in zip(*np.nonzero(mask)):  # components by flood
            if not label[start]:
                n, stack = n + 1, [start]
                while stack:
                    i, j = stack.pop()
                    if 0 <= i < mask.shape[0] and 0 <= j < mask.shape[1] and mask[i, j] and not label[i, j]:
                        label[i, j] = n
                        stack += [(i + a, j + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        back = np.pad(1 - mask, 1, constant_values=1)
        seen, holes = np.zeros(back.shape, bool), -1
        for start in zip(*np.nonzero(back)):  # background by its four neighbours, less the outside
            if not seen[start]:
                holes, stack = holes + 1, [start]
                while stack:
                    i, j = stack.pop()
                    if 0 <= i < back.shape[0] and 0 <= j < back.shape[1] and back[i, j] and not seen[i, j]:
                        seen[i, j] = True
                        stack += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
        found = R.borders(mask)
        assert sum(not b.hole for b in found) == n and sum(b.hole for b in found) == holes
        for b in found:
            x, y = b.points[0]
            own = label[y, x]
            assert all(label[q, p] == own for p, q in b.points)
            if b.hole:
                x0, y0 = found[b.parent].points[0]
                assert not found[b.parent].hole and label[y0, x0] == own


def test_filters_of_pixels():
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (9, 11)).astype(np.uint8)
    blurred = R.median_blur(image, 3)
    padded = np.pad(image, 1, mode="edge")
    assert all(blurred[i, j] == np.median(padded[i : i + 3, j : j + 3]) for i in range(9) for j in range(11))
    dots = np.zeros((9, 9), np.uint8)
    dots[4, 2] = dots[4, 4] = 255
    closed = R.closing(dots, 3)
    assert closed[4, 3] == 255 and closed.sum() == 3 * 255 and R.closing(dots, 0) is dots
    rgb = np.array([[[0, 0, 0], [255, 0, 0], [200, 100, 100], [10, 10, 10]]], np.uint8)
    assert R.saturation(rgb).tolist() == [[0, 255, 127, 0]]  # by the table, which rounds 127.5 down
    two = np.r_[np.full(50, 20), np.full(50, 200)].astype(np.uint8).reshape(10, 10)
    assert 20 <= R.otsu_of(two) < 200
    white, black = np.full((4, 4, 3), 250, np.uint8), np.full((4, 4, 3), 5, np.uint8)
    assert R.is_white(white) and not R.is_white(rgb) and R.is_black(black) and R.share_black(black) and R.share_white(white) and not R.share_white(black)
    assert R.shrunk_size(1000, 400, 2.0, 250) == (250, 100)


def test_points_and_tiles_in_contours():
    ring = rectangle(0, 0, 100, 100)
    assert R.contains(ring, 0, 50) and R.contains(ring, 99.9, 99.9) and not R.contains(ring, 101, 50)
    assert R.tile_in_contour(ring, 100, 100, 10, "corner") and not R.tile_in_contour(ring, 96, 96, 10, "centre")
    assert R.tile_in_contour(ring, 94, 94, 10, "any") and not R.tile_in_contour(ring, 94, 94, 10, "all")


def test_bounded_selection_and_artifacts():
    proposal = np.zeros((10, 10), np.uint8)
    proposal[2, 3] = 1
    found = R.bounded_candidates(proposal, (100, 100), (10, 10), 20, 20, 1)
    assert found == [(20, 20)] and len(R.bounded_candidates(proposal * 0, (100, 90), (10, 10), 20, 20, 1, "first")) == 25
    asked = []
    taken = R.bounded_selection([(i, 0) for i in range(50)], lambda part: asked.extend(part) or [x % 2 == 0 for x, _ in part], 5, 40, batch=4)
    assert taken == [(0, 0), (2, 0), (4, 0), (6, 0), (8, 0)] and len(asked) == 12
    mask = np.full((4, 4), 255, np.uint8)
    classes = np.where(np.arange(4) < 2, 4, 1)[None, :].repeat(4, axis=0)
    assert np.count_nonzero(R.without_artifacts(mask, classes, {4})[0]) == 8
    assert R.without_artifacts(mask, classes, {1, 4})[1]


def test_image_formats(tmp_path, spark):
    rng = np.random.default_rng(6)
    for image in (rng.integers(0, 256, (5, 7, 3)).astype(np.uint8), rng.integers(0, 256, (5, 7)).astype(np.uint8)):
        assert (I.read_png(I.write_png(image)) == image).all()
    grey = rng.integers(0, 4, (3, 5)).astype(np.uint8)
    lines = b"".join(bytes(r) + b"\0" * 3 for r in grey[::-1])
    data = b"BM" + struct.pack("<IHHI", 1078 + len(lines), 0, 0, 1078) + struct.pack("<IiiHHIIiiII", 40, 5, 3, 1, 8, 0, len(lines), 0, 0, 0, 0) + bytes(1024) + lines
    assert (I.read_bmp(data) == grey).all()
    (tmp_path / "s1.bmp").write_bytes(data)
    (tmp_path / "s2.bmp").write_bytes(b"broken")
    found = {r["slide_id"]: r for r in I.read_rasters(spark, str(tmp_path)).collect()}
    assert found["s1"]["width"] == 5 and found["s1"]["channels"] == 1 and found["s2"]["pixels"] is None and "ValueError" in found["s2"]["error"]
    pixels = I.label_pixels(I.read_rasters(spark, str(tmp_path))).collect()
    assert sorted((r["px"], r["py"], r["raw"]) for r in pixels) == sorted((int(x), int(y), int(grey[y, x])) for y, x in zip(*np.nonzero(grey)))
    with pytest.raises(ValueError):
        I.reader_of("x.svs")
