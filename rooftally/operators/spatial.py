"""Spatial joins and filters.

All joins follow one pattern: both sides are bucketed by square cells, joined on the cell as an equi-join, and
the exact test runs only where a cell is not known to lie fully inside. A boundary is first cut into *cover*
rows, one per cell, each carrying just the edges the test in that cell needs; so no task ever handles a whole
boundary against many features, and the cover of a large boundary is built by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftally.fixed_values import WORLD_MIN_X, WORLD_MIN_Y
from rooftally.functions import geometry as geo
from rooftally.functions import grid
from rooftally.functions import kernels
from rooftally.functions import parts as multi
from rooftally.session import has_at_most, lookup_join, stage

# Cells are compared with this much slack (degrees), so that rounding can only add exact tests, never skip one.
SLACK = 1e-9


def box_columns(prefix: str = "") -> dict[str, Column]:
    return {n: F.col(prefix + n) for n in ("minx", "miny", "maxx", "maxy")}


def once(df: DataFrame, made: Column, drop: list[str] | None = None) -> DataFrame:
    """Add the fields of the struct ``made``, computed one time per row even if later filters use them.

    A filter on a computed column is pushed below the projection, which repeats a costly expression; it is not
    pushed below a generator.
    """
    kept = [c for c in df.columns if c not in (drop or [])]
    return df.select(*kept, F.inline(F.array(made)))


def with_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add ``minx, miny, maxx, maxy`` from the geometry."""
    return once(df, geo.bounds_of(F.col(rings)), drop=["minx", "miny", "maxx", "maxy"])


# --- filters --------------------------------------------------------------------------------------------------

def scan_bbox(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose bounds meet the rectangle; plain comparisons, so they reach the Parquet scan."""
    return df.filter(
        (F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny)
    )


def filter_rectangle(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose geometry itself meets the rectangle (edges and corners count)."""
    corners = [F.lit(float(v)) for v in (minx, miny, maxx, maxy)]
    return scan_bbox(df, minx, miny, maxx, maxy).filter(geo.rings_meet_box(F.col("rings"), *corners))


# --- grid -----------------------------------------------------------------------------------------------------

def _edge_rows(boundaries: DataFrame, key: str, margin: Column | None = None) -> DataFrame:
    """Edges of the distinct polygons of each boundary: ``key, _poly, _margin, e``."""
    margin = F.lit(SLACK) if margin is None else margin + F.lit(SLACK)
    polygons = multi.polygon_rows(boundaries.withColumn("_margin", margin), [key, "_margin"])
    distinct = polygons.filter(geo.has_geometry(F.col("rings"))).select(key, "rings", "_margin").dropDuplicates([key, "rings"])
    return distinct.select(key, F.xxhash64("rings").alias("_poly"), "_margin", F.explode(geo.edges_of(F.col("rings"))).alias("e"))


def _cell_corner(size: float) -> tuple[Column, Column]:
    return F.col("cell_i") * F.lit(float(size)) + F.lit(float(WORLD_MIN_X)), F.col("cell_j") * F.lit(float(size)) + F.lit(float(WORLD_MIN_Y))


def _crossed_cells(edges: DataFrame, size: float) -> DataFrame:
    """One row per edge and cell it comes within the margin of: ``edges`` with ``cell_i, cell_j``."""
    e, margin = F.col("e"), F.col("_margin")
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    rows = edges.withColumn("cell_j", F.explode(F.sequence(grid.join_cell(low - margin, WORLD_MIN_Y, size), grid.join_cell(high + margin, WORLD_MIN_Y, size))))
    bottom = F.col("cell_j") * F.lit(float(size)) + F.lit(float(WORLD_MIN_Y))

    def at(y: Column) -> Column:
        """Where the edge is at a height, kept within its own range."""
        held = F.greatest(low, F.least(high, y))
        there = e["x1"] + (held - e["y1"]) * ((e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)))
        return F.greatest(F.least(e["x1"], e["x2"]), F.least(F.greatest(e["x1"], e["x2"]), there))

    ends = [at(bottom - margin), at(bottom + F.lit(float(size)) + margin)]
    flat = e["y1"] == e["y2"]
    # the division above is right to some bits of the largest coordinate
    slack = margin + F.greatest(F.abs(e["x1"]), F.abs(e["x2"])) * 1e-12
    first = F.when(flat, F.least(e["x1"], e["x2"])).otherwise(F.least(*ends)) - slack
    last = F.when(flat, F.greatest(e["x1"], e["x2"])).otherwise(F.greatest(*ends)) + slack
    cells = rows.withColumn("cell_i", F.explode(F.sequence(grid.join_cell(first, WORLD_MIN_X, size), grid.join_cell(last, WORLD_MIN_X, size))))
    x, y = _cell_corner(size)
    return cells.filter(geo.edge_meets_box(e, x - margin, y - margin, x + F.lit(float(size)) + margin, y + F.lit(float(size)) + margin))


def _corners_inside(edges: DataFrame, size: float, key: str) -> DataFrame:
    """Cells whose lower left corner a polygon holds: ``key, _poly, cell_i, cell_j``.

    An edge that crosses the lower line of a row of cells flips all corners left of the crossing. Crossings are counted per
    cell; between an odd and the next one along the line lie the corners inside. Only crossings and covered cells become rows.
    """
    e = F.col("e")
    rows = edges.withColumn("cell_j", F.explode(F.sequence(grid.join_cell(F.least("e.y1", "e.y2"), WORLD_MIN_Y, size), grid.join_cell(F.greatest("e.y1", "e.y2"), WORLD_MIN_Y, size) + 1)))
    line = F.col("cell_j") * F.lit(float(size)) + F.lit(float(WORLD_MIN_Y))
    crossing = rows.filter((e["y1"] > line) != (e["y2"] > line))
    near = grid.join_cell(e["x1"] + (line - e["y1"]) * ((e["x2"] - e["x1"]) / (e["y2"] - e["y1"])), WORLD_MIN_X, size)

    def left_of_it(i: Column) -> Column:
        return geo.crosses_right(e, i * F.lit(float(size)) + F.lit(float(WORLD_MIN_X)), line)

    # the last corner left of the crossing, by the test that points get too: the division may be a cell off
    last = F.when(left_of_it(near + 1), near + 1).when(left_of_it(near), near).otherwise(near - 1)
    odd = crossing.select(key, "_poly", "cell_j", last.alias("_last")).groupBy(key, "_poly", "cell_j", "_last").agg(F.count(F.lit(1)).alias("_n")).filter("_n % 2 = 1")
    along = Window.partitionBy(key, "_poly", "cell_j").orderBy(F.desc("_last"))
    spans = odd.withColumns({"_k": F.row_number().over(along), "_before": F.lead("_last").over(along)}).filter("_k % 2 = 1 AND _before IS NOT NULL")
    return spans.select(key, "_poly", F.explode(F.sequence(F.col("_before") + 1, F.col("_last"))).alias("cell_i"), "cell_j")


def boundary_to_grid(boundaries: DataFrame, size: float, key: str = "boundary_id") -> DataFrame:
    """Canonical grid cells that meet each boundary (``key`` and ``rings`` or ``parts``), touching included.

    Candidates run from the cell of the lower edge to the last cell the upper edge reaches into. An edge becomes a row per cell that it
    crosses, the cells between come from the crossings along each row of cells, so rows grow with the edges and the cells found.
    """
    edges = _edge_rows(boundaries, key)
    # several polygons may share a key: they form one dissolved boundary
    extent = edges.groupBy(key).agg(
        F.min(F.least("e.x1", "e.x2")).alias("minx"), F.min(F.least("e.y1", "e.y2")).alias("miny"), F.max(F.greatest("e.x1", "e.x2")).alias("maxx"), F.max(F.greatest("e.y1", "e.y2")).alias("maxy")
    )
    i0, i1, j0, j1 = grid.cell_ranges(*box_columns().values(), size=size)
    extent = extent.select(key, i0.alias("i0"), i1.alias("i1"), j0.alias("j0"), j1.alias("j1"))
    bounds = grid.cell_bounds(F.col("cell_i"), F.col("cell_j"), size)
    on_outline = _crossed_cells(edges, size).filter(geo.edge_meets_box(F.col("e"), *bounds.values())).select(key, "cell_i", "cell_j")
    found = on_outline.unionByName(_corners_inside(edges, size, key).select(key, "cell_i", "cell_j")).distinct()
    held = lookup_join(found, extent, [key]).filter("cell_i BETWEEN i0 AND i1 AND cell_j BETWEEN j0 AND j1")
    cells = held.select(key, F.col("cell_i").alias("grid_i"), F.col("cell_j").alias("grid_j"))
    bounds = grid.cell_bounds(F.col("grid_i"), F.col("grid_j"), size)
    return cells.select(
        key, grid.grid_id(F.col("grid_i"), F.col("grid_j"), size).alias("grid_id"),
        "grid_i", "grid_j", F.lit(float(size)).alias("grid_size"), *[c.alias(n) for n, c in bounds.items()],
    )


def cover_cells(boundaries: DataFrame, size: float, key: str = "boundary_id", grow: Column | None = None) -> DataFrame:
    """Join cells of each boundary polygon: ``key, _poly, cell_i, cell_j, corner_inside, edges``.

    ``edges`` are those that meet the cell (with ``grow``, degrees: that come so near). A point of the cell is inside if its lower
    left corner is, unless the way there crosses an odd number of them. A cell without an edge lies fully inside (``edges`` NULL).
    """
    edges = _edge_rows(boundaries, key, grow)
    met = _crossed_cells(edges, size).select(key, "_poly", "cell_i", "cell_j", F.lit(False).alias("corner_inside"), "e")
    inside = _corners_inside(edges, size, key).select(key, "_poly", "cell_i", "cell_j", F.lit(True).alias("corner_inside"), F.lit(None).cast(geo.EDGE).alias("e"))
    cells = met.unionByName(inside).groupBy(key, "_poly", "cell_i", "cell_j").agg(F.max("corner_inside").alias("corner_inside"), F.collect_list("e").alias("edges"))
    return cells.withColumn("edges", F.when(F.size("edges") > 0, F.col("edges")))


def _covers(polygons: Column, x: Column, y: Column, size: float) -> Column:
    """Whether one of the polygons of a cell (``corner_inside``, ``edges``) covers a point of it, outline included."""
    left, bottom = _cell_corner(size)
    return F.exists(
        polygons,
        lambda p: F.exists(p["edges"], lambda e: geo._on_edge(e, x, y)) | (p["corner_inside"] != geo.odd_on_the_way(p["edges"], left, bottom, x, y)),
    )


def _row_cover(
    boundaries: DataFrame, size: float, key: str = "boundary_id", grow: Column | None = None, edges_everywhere: bool = False
) -> DataFrame:
    """Join cells of each boundary polygon: ``key, cell_i, cell_j, fully_inside, edges``.

    ``edges`` holds what the point test in that cell needs: the edges of the cell's row that do not lie wholly
    left of it. Cells without an edge are either fully inside (kept, ``edges`` NULL unless ``edges_everywhere``)
    or outside (dropped). With ``grow`` (degrees, a column of the boundary) also cells that near are kept, with
    the edges that near.
    """
    margin = F.lit(SLACK) if grow is None else grow + F.lit(SLACK)
    edges = (
        boundaries.filter(geo.has_geometry(F.col("rings")))
        .select(key, "rings", margin.alias("_margin"))
        .dropDuplicates([key, "rings"])
        .select(key, F.xxhash64("rings").alias("_poly"), "_margin", F.explode(geo.edges_of(F.col("rings"))).alias("e"))
    )
    low, high = F.least("e.y1", "e.y2") - F.col("_margin"), F.greatest("e.y1", "e.y2") + F.col("_margin")
    rows = (
        edges.withColumn(
            "cell_j",
            F.explode(F.sequence(grid.join_cell(low, WORLD_MIN_Y, size), grid.join_cell(high, WORLD_MIN_Y, size))),
        )
        .groupBy(key, "_poly", "cell_j")
        .agg(
            F.collect_list("e").alias("band"),
            F.max("_margin").alias("_margin"),
            F.min(F.least("e.x1", "e.x2")).alias("_left"),
            F.max(F.greatest("e.x1", "e.x2")).alias("_right"),
        )
    )
    cells = rows.withColumn(
        "cell_i",
        F.explode(
            F.sequence(
                grid.join_cell(F.col("_left") - F.col("_margin"), WORLD_MIN_X, size),
                grid.join_cell(F.col("_right") + F.col("_margin"), WORLD_MIN_X, size),
            )
        ),
    )
    left = F.col("cell_i") * F.lit(float(size)) + F.lit(float(WORLD_MIN_X))
    bottom = F.col("cell_j") * F.lit(float(size)) + F.lit(float(WORLD_MIN_Y))
    cells = cells.withColumns({"_x": left, "_y": bottom})
    pad = F.col("_margin")
    padded = [F.col("_x") - pad, F.col("_y") - pad, F.col("_x") + F.lit(size) + pad, F.col("_y") + F.lit(size) + pad]
    on_outline = F.exists("band", lambda e: geo.edge_meets_box(e, *padded))
    centre_inside = geo.odd_crossings(F.col("band"), F.col("_x") + F.lit(size / 2), F.col("_y") + F.lit(size / 2))
    near = F.filter("band", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("_x") - pad)
    tested = once(cells, F.struct(on_outline.alias("_outline"), centre_inside.alias("_inside")))
    return tested.filter(F.col("_outline") | F.col("_inside")).select(
        key, "_poly", "cell_i", "cell_j",
        (~F.col("_outline")).alias("fully_inside"),
        F.when(F.col("_outline") | F.lit(edges_everywhere), near).alias("edges"),
    )


# --- point in polygon -----------------------------------------------------------------------------------------

def _by_cell(cover: DataFrame, *keys: str) -> DataFrame:
    """The polygons of a boundary in one cell: whether one covers all of it, and those that have an edge in it."""
    partly = F.when(F.col("edges").isNotNull(), F.struct("corner_inside", "edges"))
    return cover.groupBy(*keys, "cell_i", "cell_j").agg(F.max(F.col("edges").isNull()).alias("fully_inside"), F.collect_list(partly).alias("polygons"))


def assign_to_boundary(
    features: DataFrame, boundaries: DataFrame, size: float = 0.25, key: str = "boundary_id", x: str = "rep_x", y: str = "rep_y"
) -> DataFrame:
    """Features whose representative point a boundary covers, outline included; features are never cut.

    One row per feature and boundary. A boundary may consist of several polygons: rows with the same key, or ``parts`` of one row, which
    may overlap.
    """
    located = features.withColumns(
        {
            "cell_i": grid.join_cell(F.col(x), WORLD_MIN_X, size),
            "cell_j": grid.join_cell(F.col(y), WORLD_MIN_Y, size),
        }
    )
    # polygons of one boundary that share a cell are tested together, so overlaps do not repeat a feature
    cover = _by_cell(cover_cells(boundaries, size, key), key)
    inside = F.col("fully_inside") | _covers(F.col("polygons"), F.col(x), F.col(y), size)
    joined = lookup_join(located, stage(cover), ["cell_i", "cell_j"], condition=inside)
    return joined.drop("cell_i", "cell_j", "fully_inside", "polygons")


def assign_with_buffer(
    features: DataFrame, boundaries: DataFrame, buffer_m: float, size: float = 0.25, key: str = "boundary_id",
    x: str = "rep_x", y: str = "rep_y",
) -> DataFrame:
    """As ``assign_to_boundary`` with the boundary grown by metres, measured in its UTM zone.

    The distance is taken to the straight edges; a polygonal buffer differs by its segment approximation of
    round corners (below 0.5 % of the distance there).
    """
    if buffer_m < 0:
        raise ValueError("buffer_m must not be negative")
    if buffer_m == 0:
        return assign_to_boundary(features, boundaries, size, key, x, y)
    boundaries = multi.polygon_rows(boundaries, [key])
    measured = with_bounds(boundaries.filter(geo.has_geometry(F.col("rings"))).select(key, "rings"))
    zones = measured.groupBy(key).agg(
        geo.utm_zone((F.min("minx") + F.max("maxx")) / 2).alias("_zone"),
        F.max(F.greatest(F.abs("miny"), F.abs("maxy"))).alias("_far"),
    )
    # upper bound of the buffer in degrees: a degree of longitude at the far end, one per cent of slack
    degrees = F.lit(buffer_m * 1.01 / 110_500.0) / F.greatest(F.cos(F.radians(F.least(F.col("_far") + 1, F.lit(89.0)))), F.lit(0.01))
    grown = boundaries.join(zones, key).withColumn("_grow", degrees)
    cover = cover_cells(grown.select(key, "rings", "_grow"), size, key, grow=F.col("_grow"))
    cover = lookup_join(cover, zones.select(key, "_zone"), [key])
    cover = _by_cell(cover, key, "_zone")
    located = features.withColumns(
        {
            "cell_i": grid.join_cell(F.col(x), WORLD_MIN_X, size),
            "cell_j": grid.join_cell(F.col(y), WORLD_MIN_Y, size),
        }
    )

    def projected(edge: Column) -> Column:
        def ends(start: Column) -> Column:
            return geo.let(
                geo.utm_point(edge["x2"], edge["y2"], F.col("_zone")),
                lambda end: F.struct(start["x"].alias("x1"), start["y"].alias("y1"), end["x"].alias("x2"), end["y"].alias("y2")),
            )

        return geo.let(geo.utm_point(edge["x1"], edge["y1"], F.col("_zone")), ends)

    cover = stage(cover.withColumn("_metric", F.flatten(F.transform("polygons", lambda p: F.transform(p["edges"], projected)))))
    joined = lookup_join(located, cover, ["cell_i", "cell_j"])
    inside = _covers(F.col("polygons"), F.col(x), F.col(y), size)
    near = geo.let(
        geo.utm_point(F.col(x), F.col(y), F.col("_zone")),
        lambda p: F.exists("_metric", lambda e: geo.edge_distance(e, p["x"], p["y"]) <= F.lit(float(buffer_m))),
    )
    kept = joined.filter(F.col("fully_inside") | inside | near)
    return kept.drop("cell_i", "cell_j", "fully_inside", "polygons", "_metric", "_zone")


# --- polygon against polygon ----------------------------------------------------------------------------------

def _needed(edges: Column) -> Column:
    """Edges of a cell that matter for one feature: they reach its rows and do not end left of it."""
    return F.filter(
        edges,
        lambda e: (F.greatest(e["x1"], e["x2"]) >= F.col("minx") - SLACK)
        & (F.least(e["y1"], e["y2"]) <= F.col("maxy") + SLACK)
        & (F.greatest(e["y1"], e["y2"]) >= F.col("miny") - SLACK),
    )


def _with_mask_parts(features: DataFrame, masks: DataFrame, size: float, feature_key: str) -> DataFrame:
    """Features near the mask with ``_parts``: the mask edges around them, one array per mask polygon, and ``part_rows``.

    ``part_rows`` holds the rows of cells whose edges each part knows; in all other rows of the feature the polygon
    covers nothing, whatever edges reach there from the known ones.

    Nearly all features lie in one cell and get the parts of that cell by a plain join; where no outline comes into the cell they are whole
    (``_whole``) and get none. Only those that span several cells are copied per cell and grouped again by their key.
    """
    cover = _row_cover(multi.polygon_rows(masks).withColumn("_mask", F.lit(0)), size, "_mask", edges_everywhere=True)
    by_cell = stage(
        cover.groupBy("cell_i", "cell_j").agg(F.every("fully_inside").alias("_whole"), F.collect_list(F.struct("_poly", "edges")).alias("_found"))
    )
    spans = features.withColumns(
        {
            "cell_i": grid.join_cell(F.col("minx"), WORLD_MIN_X, size), "_i1": grid.join_cell(F.col("maxx"), WORLD_MIN_X, size),
            "cell_j": grid.join_cell(F.col("miny"), WORLD_MIN_Y, size), "_j1": grid.join_cell(F.col("maxy"), WORLD_MIN_Y, size),
        }
    )
    one_cell = (F.col("cell_i") == F.col("_i1")) & (F.col("cell_j") == F.col("_j1"))
    helpers = ["cell_i", "cell_j", "_i1", "_j1", "_found"]
    single = lookup_join(spans.filter(one_cell), by_cell.withColumn("_found", F.when(~F.col("_whole"), F.col("_found"))), ["cell_i", "cell_j"])
    own_row = F.transform("_found", lambda p: F.array("cell_j"))
    single = single.withColumns({"_parts": F.transform("_found", lambda p: p["edges"]), "part_rows": own_row}).drop(*helpers)
    spread = spans.filter(~one_cell).withColumn("cell_j", F.explode(F.sequence("cell_j", "_j1")))
    spread = spread.withColumn("cell_i", F.explode(F.sequence("cell_i", "_i1")))
    hit = lookup_join(spread, by_cell.drop("_whole"), ["cell_i", "cell_j"])
    hit = hit.withColumn("_found", F.transform("_found", lambda p: p.withField("row", F.col("cell_j"))))
    others = [c for c in features.columns if c != feature_key]
    gathered = hit.groupBy(feature_key).agg(
        F.first(F.struct(*others)).alias("_row"), F.flatten(F.collect_list("_found")).alias("_found")
    )

    def edges_of_polygon(polygon: Column) -> Column:
        pieces = F.filter("_found", lambda p: p["_poly"] == polygon)
        return F.array_distinct(F.flatten(F.transform(pieces, lambda p: p["edges"])))

    def rows_of_polygon(polygon: Column) -> Column:
        return F.array_distinct(F.transform(F.filter("_found", lambda p: p["_poly"] == polygon), lambda p: p["row"]))

    polygons = F.array_distinct(F.transform("_found", lambda p: p["_poly"]))
    found = {"_whole": F.lit(False), "_parts": F.transform(polygons, edges_of_polygon), "part_rows": F.transform(polygons, rows_of_polygon)}
    several = gathered.select(feature_key, "_row.*", *[c.alias(n) for n, c in found.items()])
    return single.unionByName(several)


def clip(features: DataFrame, masks: DataFrame, size: float = 0.25, feature_key: str = "feature_id") -> DataFrame:
    """Features that meet the dissolved mask, with their geometry cut down to the common part.

    ``features``: unique ``feature_key``, ``rings`` and attributes; ``masks``: ``rings``, one row per polygon, or
    ``parts``, in the same reference system. Every feature comes out at most once; pure line or point contacts are kept, with
    ``geom_type`` saying so. The overlay kernel works on features that a mask edge really reaches; the others are
    wholly inside or wholly outside, which one point decides, and do not go there.
    """
    bounded = with_bounds(features.drop("parts").filter(geo.has_geometry(F.col("rings"))))
    near = _with_mask_parts(bounded, masks, size, feature_key)
    box = [F.col("minx") - SLACK, F.col("miny") - SLACK, F.col("maxx") + SLACK, F.col("maxy") + SLACK]
    first = F.get(F.get("rings", F.lit(0)), F.lit(0))

    def examine(parts: Column) -> Column:
        reached = F.exists(parts, lambda edges: F.exists(edges, lambda e: geo.edge_meets_box(e, *box)))
        known = F.zip_with(parts, "part_rows", lambda edges, rows: F.struct(edges.alias("edges"), rows.alias("rows")))
        row = grid.join_cell(first["y"], WORLD_MIN_Y, size)
        inside = F.exists(known, lambda p: F.array_contains(p["rows"], row) & geo.odd_crossings(p["edges"], first["x"], first["y"]))
        return F.struct(parts.alias("_parts"), F.coalesce(reached, F.lit(False)).alias("_reached"), F.coalesce(inside, F.lit(False)).alias("_inside"))

    examined = once(near, geo.let(F.transform("_parts", _needed), examine), drop=["_parts"])
    # stored once, so that features which no edge reaches never go to Python and nothing is examined twice
    kept = stage(examined.filter("_whole or _reached or _inside"))
    helpers = ["_parts", "part_rows", "_whole", "_reached", "_inside"]
    untouched = kept.filter("not _reached").drop(*helpers).withColumn("geom_type", F.lit("POLYGON"))
    spans = F.transform("part_rows", lambda rows: F.transform(rows, lambda j: F.struct((j * size + WORLD_MIN_Y).alias("low"), ((j + 1) * size + WORLD_MIN_Y).alias("high"))))
    cut = kept.filter("_reached").withColumn("_cut", kernels.common_part("rings", "_parts", spans)).filter("_cut.geom_type is not null")
    cut = cut.withColumns({"rings": F.col("_cut.rings"), "geom_type": F.col("_cut.geom_type")}).drop(*helpers, "_cut")
    return untouched.unionByName(with_bounds(cut))


def clip_boxes(features: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Axis-aligned features cut to a rectangle, by plain expressions; zero-width contacts are kept."""
    corner = {"minx": F.greatest("minx", F.lit(minx)), "miny": F.greatest("miny", F.lit(miny)),
              "maxx": F.least("maxx", F.lit(maxx)), "maxy": F.least("maxy", F.lit(maxy))}
    kept = scan_bbox(features, minx, miny, maxx, maxy).withColumns(corner)
    return kept.withColumn("rings", geo.box_rings(*box_columns().values())) if "rings" in features.columns else kept


def polygons_only(df: DataFrame, kind: str = "geom_type") -> DataFrame:
    """Polygon and MultiPolygon rows; an input without any is an error."""
    kept = df.filter(F.upper(kind).isin("POLYGON", "MULTIPOLYGON"))
    if has_at_most(kept, 0):
        raise ValueError("the layer holds no polygon")
    return kept


def shared_cells(grid_rows: DataFrame, first: object, second: object, key: str = "boundary_id") -> DataFrame:
    """Grid cells that two boundaries have in common."""
    a = grid_rows.filter(F.col(key) == F.lit(first)).select("grid_id")
    return a.intersect(grid_rows.filter(F.col(key) == F.lit(second)).select("grid_id"))


__all__ = [
    "assign_to_boundary", "assign_with_buffer", "boundary_to_grid", "box_columns", "clip", "clip_boxes",
    "cover_cells", "filter_rectangle", "polygons_only", "scan_bbox", "shared_cells", "with_bounds",
]
