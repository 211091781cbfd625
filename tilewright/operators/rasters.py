"""Masks, contours and tiles of one raster at a time: numpy functions for Arrow batches of rasters.

A raster is a level of a slide, so it fits into a task. Conventions are those of the usual image library: 8-bit HSV saturation by its fixed-point
table, replicated borders of the median, kernels anchored at half their size, borders that run through the pixels of a component, areas of
the polygons through pixel centres.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def saturation(rgb: np.ndarray) -> np.ndarray:
    """8-bit saturation of an (h, w, 3) image."""
    high, low = rgb.max(axis=2).astype(np.int64), rgb.min(axis=2).astype(np.int64)
    table = np.r_[0, np.rint((255 << 12) / np.arange(1, 256))].astype(np.int64)
    return (((high - low) * table[high] + (1 << 11)) >> 12).astype(np.uint8)


def median_blur(image: np.ndarray, size: int) -> np.ndarray:
    """Median of the ``size`` x ``size`` window round each pixel, an odd size; rows at a time, so that windows take bounded memory."""
    if size <= 1:
        return image
    if size % 2 == 0:
        raise ValueError("the window of a median must be odd")
    padded, half = np.pad(image, size // 2, mode="edge"), size * size // 2
    rows = max(1, (1 << 22) // (image.shape[1] * size * size))
    parts = []
    for a in range(0, image.shape[0], rows):
        windows = sliding_window_view(padded[a : a + rows + size - 1], (size, size))
        flat = windows.reshape(windows.shape[0], windows.shape[1], -1)
        parts.append(np.partition(flat, half, axis=2)[:, :, half])
    return np.concatenate(parts)


def _extreme(mask: np.ndarray, size: int, largest: bool) -> np.ndarray:
    """Maximum or minimum over the window whose anchor is at half its size; places outside the image don't count."""
    fill = 0 if largest else 255
    pick = np.max if largest else np.min
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (size // 2, size - 1 - size // 2)
        mask = pick(sliding_window_view(np.pad(mask, pad, constant_values=fill), size, axis=axis), axis=-1)
    return mask


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    return _extreme(mask, size, True) if size > 1 else mask


def closing(mask: np.ndarray, size: int) -> np.ndarray:
    """Dilation, then erosion, with a square; a size of 0 changes nothing."""
    return _extreme(_extreme(mask, size, True), size, False) if size > 0 else mask


def otsu_of(image: np.ndarray) -> int:
    """The threshold that maximises the variance between the pixels up to it and those over it; the least of equals."""
    n = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    w0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    w1, s1 = w0[-1] - w0, s0[-1] - s0
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where((w0 > 0) & (w1 > 0), w0 * w1 * (s0 / w0 - s1 / w1) ** 2, -1.0)
    return int(between.argmax())


def tissue_mask(rgb: np.ndarray, threshold: int, blur: int, close: int, otsu: bool = False) -> np.ndarray:
    """255 where the blurred saturation is over the threshold, 0 elsewhere, then closed."""
    grey = median_blur(saturation(rgb), blur)
    return closing(np.where(grey > (otsu_of(grey) if otsu else threshold), np.uint8(255), np.uint8(0)), close)


def proposal_mask(rgb: np.ndarray) -> np.ndarray:
    """1 where a thumbnail may hold tissue: some colour, or not white; closed and dilated by 3."""
    seen = ((saturation(rgb) >= 5) | (rgb.max(axis=2) < 245)).astype(np.uint8) * 255
    return dilate(closing(seen, 3), 3) // 255


#: Neighbours of a pixel clockwise, as (row, column) steps, from the one on its right.
RING = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]


@dataclass
class Border:
    """``points`` (x, y) of a border; a hole's ``parent`` is the place of the outer border of its component in the list, -1 for outer ones."""

    points: np.ndarray
    hole: bool
    parent: int = -1

    @property
    def area(self) -> float:
        return ring_area(self.points)


def ring_area(points: np.ndarray) -> float:
    """Area of the polygon through ``points``."""
    x, y = points[:, 0].astype(np.float64), points[:, 1].astype(np.float64)
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def borders(mask: np.ndarray) -> list[Border]:
    """Outer borders and hole borders of the 8-connected components of a mask, every pixel of a border listed, by border following.

    A border starts where a raster scan meets it first. Pixels keep the number of the border that was followed through them, negative where
    the background is on their right, which tells which borders have been followed and inside which border a new one lies.
    """
    held = np.pad((mask != 0).astype(np.int32), 1)
    rows, columns = np.nonzero(held)
    outer = held[rows, columns - 1] == 0
    inner = held[rows, columns + 1] == 0
    found: list[Border] = []
    for i, j, is_outer, is_inner in zip(rows.tolist(), columns.tolist(), outer.tolist(), inner.tolist()):
        if not (is_outer or is_inner):
            continue
        if is_outer and held[i, j] == 1:
            hole, start = False, 4
        elif is_inner and held[i, j] >= 1:
            hole, start = True, 0
        else:
            continue
        parent = -1
        if hole:
            row = held[i, : j + 1]
            near = np.flatnonzero((row > 1) | (row < 0))
            near = int(abs(row[near[-1]])) - 2 if len(near) else -1
            parent = found[near].parent if near >= 0 and found[near].hole else near
        found.append(Border(_follow(held, i, j, start, len(found) + 2), hole, parent))
    return found


def _follow(held: np.ndarray, i: int, j: int, start: int, number: int) -> np.ndarray:
    """Points of the border that begins at a pixel, whose neighbour in direction ``start`` is background; numbers its pixels."""
    for k in range(8):
        d = (start + k) % 8
        if held[i + RING[d][0], j + RING[d][1]]:
            break
    else:
        held[i, j] = -number
        return np.array([[j - 1, i - 1]])
    first = (i + RING[d][0], j + RING[d][1])
    back, at, points = d, (i, j), []
    while True:
        points.append((at[1] - 1, at[0] - 1))
        right_is_background = False
        for k in range(1, 9):  # counterclockwise from the pixel that it came from
            d = (back - k) % 8
            to = (at[0] + RING[d][0], at[1] + RING[d][1])
            if held[to]:
                break
            right_is_background |= d == 0
        if right_is_background:
            held[at] = -number
        elif held[at] == 1:
            held[at] = number
        if to == (i, j) and at == first:
            return np.array(points)
        back, at = (d + 4) % 8, to


def tissue_borders(found: list[Border], least_area: float, least_hole: float, most_holes: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Outer borders, last found first, whose area without their holes is over ``least_area``, each with its largest ``most_holes`` holes over ``least_hole``."""
    out = []
    for k in reversed(range(len(found))):
        if found[k].hole:
            continue
        holes = sorted((b for b in reversed(found) if b.hole and b.parent == k), key=lambda b: -b.area)
        area = found[k].area - sum(b.area for b in holes)
        if area and area > least_area:
            out.append((found[k].points, [b.points for b in holes[:most_holes] if b.area > least_hole]))
    return out


def chosen(items: list, keep: list[int], exclude: list[int]) -> list:
    """The items with the places ``keep`` (none: all) without ``exclude``."""
    return [items[k] for k in sorted(set(keep or range(len(items))) - set(exclude))]


def scaled(points: np.ndarray, sx: float, sy: float) -> np.ndarray:
    """Points times the downsample of a level, cut to whole pixels."""
    return (points * np.array([sx, sy])).astype(np.int32)


def contains(ring: np.ndarray, x: float, y: float) -> bool:
    """Whether a polygon holds a point; its border belongs to it."""
    a, b = ring.astype(np.float64), np.roll(ring, -1, axis=0).astype(np.float64)
    cross = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
    inside_box = (np.minimum(a[:, 0], b[:, 0]) <= x) & (x <= np.maximum(a[:, 0], b[:, 0])) & (np.minimum(a[:, 1], b[:, 1]) <= y) & (y <= np.maximum(a[:, 1], b[:, 1]))
    if bool(((cross == 0) & inside_box).any()):
        return True
    rising = (a[:, 1] <= y) & (y < b[:, 1]) & (cross > 0)
    falling = (b[:, 1] <= y) & (y < a[:, 1]) & (cross < 0)
    return bool((rising.sum() + falling.sum()) % 2)


def tile_in_contour(ring: np.ndarray, x: int, y: int, size: int, rule: str, shift: float = 0.5) -> bool:
    """Whether a tile counts as inside: its ``corner``, its ``centre``, or ``any`` or ``all`` of four points round its centre."""
    cx, cy, s = x + size // 2, y + size // 2, int(size // 2 * shift)
    if rule == "corner":
        return contains(ring, x, y)
    points = [(cx, cy)] if rule == "centre" or s <= 0 else [(cx - s, cy - s), (cx + s, cy + s), (cx + s, cy - s), (cx - s, cy + s)]
    if rule not in ("centre", "any", "all"):
        raise ValueError(f"unknown rule {rule!r}")
    return (any if rule == "any" else all)(contains(ring, *p) for p in points)


def clipped(points: np.ndarray, axis: int, limit: float, above: bool) -> np.ndarray:
    """The part of a polygon on one side of a line that is parallel to an axis; edges along the line enclose nothing."""
    if not len(points):
        return points
    p, q = points, np.roll(points, -1, axis=0)
    inside_p, inside_q = ((p[:, axis] >= limit, q[:, axis] >= limit) if above else (p[:, axis] <= limit, q[:, axis] <= limit))
    crosses = inside_p != inside_q
    rise = np.where(crosses, q[:, axis] - p[:, axis], 1.0)
    at = p + (q - p) * np.where(crosses, (limit - p[:, axis]) / rise, 0.0)[:, None]
    both = np.stack([p, at], axis=1).reshape(-1, 2)
    return both[np.stack([inside_p, crosses], axis=1).ravel()]


def outermost(regions: list[tuple[np.ndarray, list[np.ndarray]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The rings that count of a union of outlines less all holes: outlines inside no other outline, holes inside no other hole.

    Outlines of different components, and holes, are apart or nested. What lies in a hole that stays is taken out with it, and what
    lies in one that doesn't is covered by the outline round it.
    """

    def top(rings: list[np.ndarray]) -> list[np.ndarray]:
        size = [ring_area(r) for r in rings]
        box = [(*r.min(axis=0), *r.max(axis=0)) for r in rings]
        inside = lambda i, k: box[k][0] <= box[i][0] and box[k][1] <= box[i][1] and box[k][2] >= box[i][2] and box[k][3] >= box[i][3] and contains(rings[k], *map(float, rings[i][0]))
        return [r for i, r in enumerate(rings) if not any(size[k] > size[i] and inside(i, k) for k in range(len(rings)))]

    held = [(o, h) for o, h in regions if len(o) >= 4]  # fewer points enclose nothing
    return top([o for o, _ in held]), top([x for _, h in regions for x in h if len(x) >= 4])


def origins(low: float, high: float, step: int, size: int, limit: int | None = None) -> range:
    """Multiples of ``step`` whose tile meets ``[low, high)``, none under 0; with ``limit`` none that ends past it."""
    begin = max(0, (int(np.floor((low - size) / step)) + 1) * step)
    end = int(np.ceil(high))
    return range(begin, end if limit is None else min(end, limit - size + 1), step)


def tiles_of(regions: list[tuple[np.ndarray, list[np.ndarray]]], size: int, step: int, slide_size: tuple[int, int] | None = None, least_share: float = 0.0) -> Iterator[tuple[int, int, float]]:
    """``(x, y, share)`` of the lattice tiles with a positive area in the regions, x before y; ``share`` is that area's part of the tile.

    Tiles that only touch hold nothing; with ``least_share`` a tile needs that part at least. Rings are cut into columns first, so a tile
    sees the points of its column only.
    """
    outlines, holes = outermost(regions)
    if not outlines:
        return
    rings = [(r.astype(np.float64), 1.0) for r in outlines] + [(r.astype(np.float64), -1.0) for r in holes]
    low, high = np.min([r.min(axis=0) for r in outlines], axis=0), np.max([r.max(axis=0) for r in outlines], axis=0)
    width, height = slide_size if slide_size else (None, None)
    for x in origins(low[0], high[0], step, size, width):
        strips = [(clipped(clipped(r, 0, x, True), 0, x + size, False), sign) for r, sign in rings if r[:, 0].max() > x and r[:, 0].min() < x + size]
        strips = [(s, sign) for s, sign in strips if len(s) > 2]
        for y in origins(low[1], high[1], step, size, height):
            area = sum(sign * ring_area(cell) for s, sign in strips if s[:, 1].max() > y and s[:, 1].min() < y + size and len(cell := clipped(clipped(s, 1, y, True), 1, y + size, False)) > 2)
            if area > 1e-6 and area / (size * size) >= least_share:
                yield x, y, area / (size * size)


def is_white(rgb: np.ndarray, threshold: float = 5) -> bool:
    return bool(saturation(rgb).mean() < threshold)


def is_black(rgb: np.ndarray, threshold: float = 40) -> bool:
    return bool((rgb.reshape(-1, rgb.shape[-1]).mean(axis=0) < threshold).all())


def share_black(rgb: np.ndarray, threshold: int = 20, share: float = 0.05) -> bool:
    return bool((rgb < threshold).all(axis=2).sum() > rgb.shape[0] * rgb.shape[1] * share)


def share_white(rgb: np.ndarray, threshold: int = 220, share: float = 0.2) -> bool:
    return bool((rgb > threshold).all(axis=2).sum() > rgb.shape[0] * rgb.shape[1] * share)


def shrunk_size(width: int, height: int, downsample: float | None, largest: int | None) -> tuple[int, int]:
    """Size of a drawing after a downsample and then a limit on its longer side."""
    if downsample and downsample > 1:
        width, height = int(width / downsample), int(height / downsample)
    if largest is not None and max(width, height) > largest:
        factor = largest / width if width > height else largest / height
        width, height = int(width * factor), int(height * factor)
    return width, height


def bounded_candidates(proposal: np.ndarray, slide_size: tuple[int, int], downsample: tuple[float, float], size: int, step: int, seed: int, strategy: str = "random") -> list[tuple[int, int]]:
    """Origins, to the far edges, of tiles of which a hundredth is proposed, or of all if none is; in seeded order, or row by row."""

    def along(length: int) -> list[int]:
        if length <= size:
            return [0]
        return sorted({*range(0, length - size + 1, step), length - size})

    def span(origin: int, factor: float, limit: int) -> tuple[int, int]:
        a = max(0, int(np.floor(origin / factor)))
        return a, min(limit, max(a + 1, int(np.ceil((origin + size) / factor))))

    xs, ys = along(slide_size[0]), along(slide_size[1])
    total = np.pad(np.cumsum(np.cumsum(proposal.astype(np.int64), axis=0), axis=1), ((1, 0), (1, 0)))
    found = []
    for y in ys:
        r0, r1 = span(y, downsample[1], proposal.shape[0])
        for x in xs:
            c0, c1 = span(x, downsample[0], proposal.shape[1])
            n = max(0, r1 - r0) * max(0, c1 - c0)
            if n and (total[r1, c1] - total[r0, c1] - total[r1, c0] + total[r0, c0]) / n >= 0.01:
                found.append((x, y))
    found = found or [(x, y) for y in ys for x in xs]
    return [found[k] for k in np.random.default_rng(seed).permutation(len(found))] if strategy == "random" else found


def bounded_selection(candidates: list[tuple[int, int]], accepts, most: int | None, budget: int | None, batch: int = 8) -> list[tuple[int, int]]:
    """Candidates that ``accepts(list) -> list of bool`` takes, in order, until ``most`` are taken or ``budget`` were asked."""
    taken: list[tuple[int, int]] = []
    asked = candidates if budget is None else candidates[:budget]
    for k in range(0, len(asked), batch):
        part = asked[k : k + batch]
        taken += [c for c, ok in zip(part, accepts(part), strict=True) if ok]
        if most is not None and len(taken) >= most:
            return taken[:most]
    return taken


def without_artifacts(mask: np.ndarray, classes: np.ndarray, excluded: set[int], least_left: float = 0.1) -> tuple[np.ndarray, bool]:
    """The mask without the pixels of excluded classes, and whether it was reverted: nine tenths or more gone, or nothing there before."""
    classes = classes[np.ix_(np.arange(mask.shape[0]) * classes.shape[0] // mask.shape[0], np.arange(mask.shape[1]) * classes.shape[1] // mask.shape[1])]
    left = np.where(np.isin(classes, sorted(excluded)), 0, mask).astype(mask.dtype)
    before, after = np.count_nonzero(mask), np.count_nonzero(left)
    gone = 1.0 - after / before if before else 1.0
    return (mask, True) if gone >= 1.0 - least_left else (left, False)
