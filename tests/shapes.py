"""Small geometry helpers of the tests."""

import random
import struct

RINGS = "array<array<struct<x:double,y:double>>>"


def ring(*corners):
    """Closed ring from corners."""
    return [(float(x), float(y)) for x, y in (*corners, corners[0])]


def box(minx, miny, maxx, maxy):
    return [ring((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy))]


def star(rng: random.Random, cx, cy, radius, corners=9):
    """Random star-shaped polygon (simple, usually concave)."""
    from math import cos, pi, sin

    spots = []
    for k in range(corners):
        r = radius * rng.uniform(0.3, 1.0)
        angle = 2 * pi * k / corners
        spots.append((cx + r * cos(angle), cy + r * sin(angle)))
    return [ring(*spots)]


def inside(rings, x, y):
    """Even-odd test, outline counts as inside (plain Python reference)."""
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def area(rings):
    total = 0.0
    for r in rings:
        total += abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:]))) / 2
    return total


def write_shapefile(stem, polygons, heights, wkt=None, name_encoding="utf-8", names=None):
    """Minimal polygon shapefile with the fields Height (N) and NAME (C)."""
    body, index, at = b"", b"", 50
    for number, rings_ in enumerate(polygons, 1):
        if rings_ is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings_ for p in r]
            starts = [sum(len(q) for q in rings_[:k]) for k in range(len(rings_))]
            xs, ys = [p[0] for p in points], [p[1] for p in points]
            content = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings_), len(points))
            content += struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        words = len(content) // 2
        index += struct.pack(">2i", at, words)
        body += struct.pack(">2i", number, words) + content
        at += words + 4

    def head(size):
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, 5, *([0.0] * 8))

    stem.with_suffix(".shp").write_bytes(head(100 + len(body)) + body)
    stem.with_suffix(".shx").write_bytes(head(100 + len(index)) + index)
    fields = [("Height", b"N", 12), ("NAME", b"C", 20)]
    row_length = 1 + sum(f[2] for f in fields)
    table = struct.pack("<4BI2H20x", 3, 24, 1, 1, len(polygons), 32 + 32 * len(fields) + 1, row_length)
    for name, kind, width in fields:
        table += name.encode().ljust(11, b"\0") + kind + b"\0" * 4 + bytes([width, 0]) + b"\0" * 14
    table += b"\r"
    for k, height in enumerate(heights):
        number = ("" if height is None else f"{height:g}").rjust(12).encode()
        label = (names[k] if names else f"n{k}").encode(name_encoding).ljust(20)
        table += b" " + number + label
    stem.with_suffix(".dbf").write_bytes(table + b"\x1a")
    if wkt:
        stem.with_suffix(".prj").write_text(wkt)
