"""The constrained nearest join: for every point the nearest line within a radius whose attributes agree.

Attribute agreement is an equi-key. Points with equal keys and coordinates are searched once.
Each combination of keys has a grid whose cells hold a few of its segments; a segment lies
in the cell of its middle (a long one in those of its parts), so it is shuffled about once.
A point meets the segments of nine cells; what is found within half a cell is the nearest.
Points that find nothing so near look once more in cells four times as wide. In evenly
dense tables these two rounds settle every point.

What is left, points far from lines that crowd elsewhere, goes through a quadtree over the
segments near it. Its roots are as wide as the radius. Where no more than LEAF segments
are counted in any root, the roots do. A root with more is cut, and into how many levels at
once follows from the count, so that a leaf holds about LEAF of them; cells that are still
overfull, where lines crowd in a part of a root, are cut again in the same way. Cells are
never much smaller than the lines in them.

1. Segments are filed in the leaves that they touch. Each cell, leaf or above, knows the
   place of one segment in it.
2. Every point meets these places in the leaves around it. The nearest bounds its search:
   some agreeing line is that near. Points with nothing around them, or in a cell that was
   cut again, find their bound from coarse cells to fine ones, so that a dense place at
   some distance costs them no more than a sparse one.
3. A point then meets the segments of the leaves that its bound reaches: a few times LEAF,
   however dense the lines are, so pairs grow with the rows and not with their square. The
   nearest of them, by the tie break if several are, is a keyed minimum.

Of segments with the same ends in an overfull leaf the first by the tie break stands for
all, so a pile of copies costs a point one candidate. All steps are keyed joins and
aggregates that Spark partitions, spills and splits when skewed; the driver sees whether
cells are left to be cut, and the number of levels.

Defined results: points with null keys or coordinates and segments with null keys or ends
match nothing; ties in distance go by the order columns; a point in several rows (one for
each layer to be searched) gets one result; empty sides give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.geometry import crosses_box, distance, nearest_on_segment
from wayside.sources.pages import stored

LEAF = 256
#: Leaves of up to so many times LEAF segments are left as they are.
CROWDED = 4
DEEPEST = 16
#: Cells are at least this share of the mean extent of the lines in them.
FINEST = 0.25
#: Bounds and boxes are widened by this share of the radius, so that rounding loses nothing.
SLACK = 1e-9
ENDS = ("ax", "ay", "bx", "b_y")
#: Segments that a cell of the first round holds, about.
FEW = 8
#: Up to so many places are sent to the segments of the second round.
SENT = 1 << 15


def _span(lo: Column, hi: Column, size: Column | float) -> Column:
    return F.sequence(F.floor(lo / size).cast("long"), F.floor(hi / size).cast("long"))


def _to_box(px: Column, py: Column, cx: Column, cy: Column, size: Column) -> Column:
    """Distance of a point to a cell."""
    gap = lambda p, c: F.greatest(F.lit(0.0), c * size - p, p - (c + 1) * size)
    dx, dy = gap(px, cx), gap(py, cy)
    return F.sqrt(dx * dx + dy * dy)


def _size(level: Column, radius: float) -> Column:
    return F.lit(radius) / F.pow(F.lit(2.0), level)


def _cells(xs: Column, ys: Column, level: Column) -> Column:
    """An array of cells of a level from arrays of their places."""
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(level.alias("level"), x.alias("cx"), y.alias("cy")))))


def _parent(c: Column, up: Column) -> Column:
    return F.floor(c / F.pow(F.lit(2.0), up)).cast("long")


class Quadtree:
    """files: segments in the leaves they touch (keys, level, cx, cy, ends, other columns);
    splits: for each round the cells that were cut and to which level (keys, level, cx, cy, into);
    places: one row a cell of every level down to its leaf (keys, level, cx, cy, rx, ry)."""

    def __init__(self, segments: DataFrame, keys: list[str], radius: float, order: list[str], leaf: int = LEAF, deepest: int = DEEPEST):
        self.keys, self.radius, self.leaf, self.deepest = keys, radius, leaf, deepest
        self.place = place = [*keys, "level", "cx", "cy"]
        s = segments.dropna(subset=[*keys, *ENDS])
        rooted = s.withColumn("cx", F.explode(_span(F.least("ax", "bx"), F.greatest("ax", "bx"), radius)))
        rooted = rooted.withColumn("cy", F.explode(_span(F.least("ay", "b_y"), F.greatest("ay", "b_y"), radius)))
        files, self.splits, self.levels = [], [], 1
        middle = [F.floor((F.col(a) + F.col(b)) / (2 * radius)).alias(c) for a, b, c in (("ax", "bx", "cx"), ("ay", "b_y", "cy"))]
        if s.groupBy(*keys, *middle).count().filter(F.col("count") > leaf).isEmpty():  # nowhere dense
            self.dense, self.files = False, rooted
            return
        self.dense = True
        s = rooted.withColumn("level", F.lit(0))
        while True:
            cut = stored(self._counted(s).filter("into > level").select(*place, "into"))
            if cut.isEmpty():
                files.append(s)
                break
            self.splits.append(cut)
            files.append(s.join(cut, place, "left_anti"))
            s = stored(self._cut(s.join(cut, place)).select(*segments.columns, "level", "cx", "cy"))
        leaves = files[0]
        for f in files[1:]:
            leaves = leaves.unionByName(f)
        piled = stored(self._counted(leaves).filter(F.col("n") > CROWDED * leaf).select(*place))
        self.files = leaves if piled.isEmpty() else self._thinned(leaves, piled, order)
        self.places = self._places(leaves)
        self.levels = 1 + max([0, *[c.agg(F.max("into")).first()[0] for c in self.splits]])

    def _counted(self, s: DataFrame) -> DataFrame:
        """Cells with the number of segments n and the level into which to cut them (or their own)."""
        extent = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("b_y") - F.col("ay")))
        cells = s.groupBy(*self.place).agg(F.count("*").alias("n"), F.avg(extent).alias("extent"))
        by_count = F.ceil(F.log2(F.col("n") / self.leaf) / 2)
        by_extent = F.when(F.col("extent") > 0, F.floor(F.log2(self.radius / (FINEST * F.col("extent"))))).otherwise(self.deepest)
        into = F.least(F.col("level") + by_count, by_extent, F.lit(self.deepest)).cast("int")
        full = (F.col("level") == 0) & (F.col("n") > self.leaf) | (F.col("n") > CROWDED * self.leaf)
        return cells.select(*self.place, "n", F.when(full, F.greatest(into, "level")).otherwise(F.col("level")).alias("into"))

    def _cut(self, s: DataFrame) -> DataFrame:
        """Segments of cells, filed in the cells of level `into` that they touch within."""
        size, n = _size(F.col("into"), self.radius), F.pow(F.lit(2.0), F.col("into") - F.col("level")).cast("long")
        slack = SLACK * self.radius

        def within(lo: Column, hi: Column, cell: str) -> Column:
            first, last = F.col(cell) * n, F.col(cell) * n + n - 1
            place = lambda v: F.least(F.greatest(F.floor(v / size).cast("long"), first), last)
            return F.sequence(place(lo - slack), place(hi + slack))

        cells = _cells(within(F.least("ax", "bx"), F.greatest("ax", "bx"), "cx"), within(F.least("ay", "b_y"), F.greatest("ay", "b_y"), "cy"), F.col("into"))
        s = s.withColumn("c", F.explode(cells)).drop("level", "cx", "cy").select("*", "c.*")
        size = _size(F.col("level"), self.radius)
        return s.filter(crosses_box(*(F.col(c) for c in ENDS), *[(F.col(c) + side) * size + grow for side, grow in ((0, -slack), (1, slack)) for c in ("cx", "cy")]))

    def _thinned(self, leaves: DataFrame, piled: DataFrame, order: list[str]) -> DataFrame:
        """Of segments with the same ends in an overfull leaf the first by the tie break."""
        group = [*self.place, *ENDS]
        first = leaves.join(piled, self.place, "left_semi").groupBy(*group).agg(F.min(F.struct(*order, *[c for c in leaves.columns if c not in group and c not in order])).alias("f"))
        return leaves.join(piled, self.place, "left_anti").unionByName(first.select(*group, "f.*"))

    def _places(self, leaves: DataFrame) -> DataFrame:
        """Of every leaf, and of every cell above one, the place of one segment nearest its leaf's middle."""
        size = _size(F.col("level"), self.radius)
        rx, ry = nearest_on_segment((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, *(F.col(c) for c in ENDS))
        # both coordinates of a cell come from the same row
        one = [F.first("rx").alias("rx"), F.first("ry").alias("ry")]
        own = stored(leaves.select(*self.place, rx.alias("rx"), ry.alias("ry")).groupBy(*self.place).agg(*one))
        ups = F.transform(F.sequence(F.lit(1), F.col("level")), lambda u: F.struct((F.col("level") - u).cast("int").alias("level"), _parent(F.col("cx"), u).alias("cx"), _parent(F.col("cy"), u).alias("cy")))
        above = own.filter("level > 0").select(*self.keys, F.explode(ups).alias("c"), "rx", "ry").select(*self.keys, "c.*", "rx", "ry")
        return stored(own.unionByName(above).groupBy(*self.place).agg(*one))

    def near(self, looked: DataFrame, key: str) -> DataFrame:
        """(key, near) of points that look into cells: the least distance to their places."""
        met = looked.join(self.places, self.place)
        return met.groupBy(key).agg(F.min(distance(F.col("px"), F.col("py"), F.col("rx"), F.col("ry"))).alias("near"))

    def bound(self, near: Column) -> Column:
        return F.least(F.lit(self.radius), near) * (1 + SLACK) + SLACK * self.radius


def _own(tree: Quadtree, level: Column) -> tuple[Column, Column]:
    return tuple(F.floor(F.col(c) / _size(level, tree.radius)).cast("long") for c in ("px", "py"))


def _reached(tree: Quadtree, level: Column) -> Column:
    """Cells of a level within a point's bound."""
    size = _size(level, tree.radius)
    span = lambda c: _span(F.col(c) - F.col("bound"), F.col(c) + F.col("bound"), size)
    return F.filter(_cells(span("px"), span("py"), level), lambda c: _to_box(F.col("px"), F.col("py"), c["cx"], c["cy"], size) <= F.col("bound"))


def bounded(points: DataFrame, tree: Quadtree, key: str) -> DataFrame:
    """points with `bound`: how far the nearest agreeing segment of any of a point's rows is at most, up to the radius.
    Points without one within the radius may go."""
    if not tree.splits:  # dense, but no cell can be cut
        return points.withColumn("bound", tree.bound(F.lit(tree.radius)))
    keyed = points.withColumns(dict(zip(("cx", "cy"), _own(tree, F.lit(0)), strict=True))).withColumn("level", F.lit(0))
    at = keyed.join(tree.splits[0], tree.place, "left").drop("level", "cx", "cy").withColumn("into", F.coalesce("into", F.lit(0)))
    x, y = _own(tree, F.col("into"))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    cells = _cells(F.transform(around, lambda i: x + i), F.transform(around, lambda i: y + i), F.col("into"))
    near = tree.near(at.withColumn("c", F.explode(cells)).select(key, *tree.keys, "px", "py", "c.*"), key)
    known = points.join(near, key, "left").withColumn("bound", tree.bound(F.coalesce("near", F.lit(tree.radius))))
    again = F.col("near").isNull()
    if len(tree.splits) > 1:
        cut = tree.splits[1].select(*tree.place, F.lit(True).alias("cut"))
        own = at.withColumns({"cx": x, "cy": y, "level": F.col("into")}).join(cut, tree.place, "left_semi").select(key).distinct()
        known = known.join(own.withColumn("cut", F.lit(True)), key, "left")
        again = again | F.col("cut").isNotNull()
    known = stored(known.withColumn("again", again).drop("near", "cut"))
    rest = _descended(known.filter("again").drop("again"), tree, key)
    return known.filter("not again").drop("again").unionByName(rest)


def _descended(points: DataFrame, tree: Quadtree, key: str) -> DataFrame:
    """points with their bound made tight from coarse cells to fine ones: on each level only the
    cells that are no farther than the nearest place known so far are looked into."""
    rows = [key, *tree.keys, "px", "py"]
    front = points.withColumn("c", F.explode(_reached(tree, F.lit(0)))).select(*rows, "c.*")
    for level in range(tree.levels):
        met = front.join(tree.places, tree.place)
        near = met.groupBy(key).agg(F.min(distance(F.col("px"), F.col("py"), F.col("rx"), F.col("ry"))).alias("near"))
        joined = points.join(near, key, "left" if level else "inner")
        points = stored(joined.withColumn("bound", F.least("bound", tree.bound(F.coalesce("near", "bound")))).drop("near"))
        if level + 1 == tree.levels:
            break
        size = tree.radius / (1 << (level + 1))
        two = F.array(F.lit(0), F.lit(1))
        inner = _cells(F.transform(two, lambda i: F.col("cx") * 2 + i), F.transform(two, lambda i: F.col("cy") * 2 + i), F.lit(level + 1))
        within = F.filter(inner, lambda c: _to_box(F.col("px"), F.col("py"), c["cx"], c["cy"], F.lit(size)) <= F.col("bound"))  # noqa: B023
        held = met.select(*rows, "cx", "cy").join(points.select(key, "bound").distinct(), key)
        front = stored(held.withColumn("c", F.explode(within)).select(*rows, "c.*").join(tree.places.select(*tree.place), tree.place, "left_semi"))
        if front.isEmpty():
            break
    return points


def candidates(points: DataFrame, tree: Quadtree, key: str) -> DataFrame:
    """Points with the segments of the leaves that their bound reaches; a pair may meet more than once."""
    rows = [key, *tree.keys, "px", "py", "bound"]
    met = points.withColumn("c", F.explode(_reached(tree, F.lit(0)))).select(*rows, "c.*")
    for cut in tree.splits:
        at = met.join(cut, tree.place, "left")
        size = _size(F.col("into"), tree.radius)
        n = F.pow(F.lit(2.0), F.col("into") - F.col("level")).cast("long")

        def within(p: str, c: str, size=size, n=n) -> Column:
            """Places of the finer cells in this one that the bound reaches."""
            place = lambda v: F.least(F.greatest(F.floor(v / size).cast("long"), F.col(c) * n), F.col(c) * n + n - 1)
            return F.sequence(place(F.col(p) - F.col("bound")), place(F.col(p) + F.col("bound")))

        inner = F.filter(_cells(within("px", "cx"), within("py", "cy"), F.col("into")), lambda c: _to_box(F.col("px"), F.col("py"), c["cx"], c["cy"], size) <= F.col("bound"))  # noqa: B023
        own = F.array(F.struct("level", "cx", "cy"))
        met = at.withColumn("c", F.explode(F.when(F.col("into").isNull(), own).otherwise(inner))).select(*rows, "c.*")
    return met.join(tree.files, tree.place)


def around(points: DataFrame, tree: Quadtree, key: str) -> DataFrame:
    """Points with the segments of the nine roots around them: all there is to do where no root was cut."""
    r = tree.radius
    beside = F.array(F.lit(-1), F.lit(0), F.lit(1))
    p = points.withColumn("bound", F.lit(r))
    p = p.withColumn("cx", F.explode(F.transform(beside, lambda d: F.floor(F.col("px") / r).cast("long") + d)))
    p = p.withColumn("cy", F.explode(F.transform(beside, lambda d: F.floor(F.col("py") / r).cast("long") + d)))
    return p.join(tree.files, [*tree.keys, "cx", "cy"])


def _by_tree(points: DataFrame, segments: DataFrame, key: str, keys: list[str], radius: float, carry: list[str], order: list[str], leaf: int, deepest: int) -> DataFrame:
    """(key, best) of points (key, keys, px, py) by the quadtree; best: distance, order columns, carried ones, new_x, new_y."""
    tree = Quadtree(segments, keys, radius, order, leaf, deepest)
    both = candidates(bounded(points, tree, key), tree, key) if tree.dense else around(points, tree, key)
    return _best(_measured(both, F.least(F.col("bound"), F.lit(radius))), [key], order, carry)


def _measured(pairs: DataFrame, within: Column) -> DataFrame:
    """Pairs of a point and a segment with the nearest place and its distance, up to a limit."""
    nx, ny = nearest_on_segment(*(F.col(c) for c in ("px", "py", *ENDS)))
    near = pairs.withColumns({"new_x": nx, "new_y": ny})
    return near.withColumn("distance", distance(F.col("px"), F.col("py"), F.col("new_x"), F.col("new_y"))).filter(F.col("distance") <= within)


def _best(near: DataFrame, by: list[str], order: list[str], carry: list[str]) -> DataFrame:
    rest = [c for c in dict.fromkeys([*carry, "new_x", "new_y"]) if c not in order]
    return near.groupBy(*by).agg(F.min(F.struct("distance", *order, *rest)).alias("best"))


# -- rounds over a grid as wide as the lines are dense --


def _key_table(segments: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """One row for each combination of keys: kid, and the width of cells that hold about FEW segments
    where segments are (a segment's mean company in its root says how dense that is), but are twice as wide
    as the mean segment is long and need be no wider than to hold the whole radius."""
    middle = [F.floor((F.col(a) + F.col(b)) / (2 * radius)).alias(c) for a, b, c in (("ax", "bx", "cx"), ("ay", "b_y", "cy"))]
    roots = segments.groupBy(*keys, *middle).agg(F.count("*").cast("double").alias("n"), F.sum(_extent()).alias("extent"))
    by_count = radius * F.sqrt(FEW * F.sum("n") / F.sum(F.col("n") * F.col("n")))
    width = F.least(F.greatest(by_count, 2 * F.sum("extent") / F.sum("n")), F.lit(_whole(radius)))
    return stored(roots.groupBy(*keys).agg(width.alias("width")).withColumn("kid", F.monotonically_increasing_id()))


def _extent() -> Column:
    return F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("b_y") - F.col("ay")))


def _whole(radius: float) -> float:
    """The width of cells with which one round finds everything within the radius."""
    return 2 * radius * (1 + 1e-6)


def _filed(segments: DataFrame) -> DataFrame:
    """Segments in the cell of their middle; longer ones than a cell is wide in the cells of the middles of equal parts."""
    parts = F.greatest(F.ceil(_extent() / F.col("width")), F.lit(1)).cast("long")
    s = segments.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).withColumn("__at", (F.col("__part") + 0.5) / parts)
    cell = lambda a, b: F.floor((F.col(a) + F.col("__at") * (F.col(b) - F.col(a))) / F.col("width")).cast("long")
    return s.withColumns({"cx": cell("ax", "bx"), "cy": cell("ay", "b_y")}).drop("__part", "__at", "width")


def _nine(places: DataFrame) -> DataFrame:
    """Places with each of the nine cells around them."""
    beside = F.array(F.lit(-1), F.lit(0), F.lit(1))
    for c, p in (("cx", "px"), ("cy", "py")):
        places = places.withColumn("__by", F.explode(beside)).withColumn(c, F.floor(F.col(p) / F.col("width")).cast("long") + F.col("__by")).drop("__by")
    return places


def _celled(rows: DataFrame) -> DataFrame:
    """The cell's two numbers in one, as the shuffle writes it for every row. Far apart cells may share one: that
    adds candidates of the same keys, whose distance is measured like any other's."""
    return rows.withColumn("cell", F.shiftleft("cx", 32).bitwiseXOR(F.col("cy").bitwiseAND(F.lit(0xFFFFFFFF)))).drop("cx", "cy")


def _settled(radius: float) -> Column:
    """What is nearest within this distance in the nine cells is nearest of all: a segment's part is no longer than
    a cell is wide, so its middle is at most half of that away from its nearest place."""
    return F.least(F.col("width") / 2 * (1 - SLACK), F.lit(radius))


def _round(places: DataFrame, segments: DataFrame, radius: float, order: list[str], carry: list[str], few: bool) -> DataFrame:
    """(kid, px, py, best) of the places whose nearest segment the nine cells settle. Both sides have
    their width; a few places are sent to the segments, which then stay where they are."""
    at = _celled(_nine(places))
    near = _measured((F.broadcast(at) if few else at).join(_celled(_filed(segments)), ["kid", "cell"]), _settled(radius))
    return _best(near, ["kid", "px", "py"], order, carry)


def nearest_within(points: DataFrame, segments: DataFrame, key: str, keys: list[str], radius: float, carry: list[str], order: list[str], leaf: int = LEAF, deepest: int = DEEPEST) -> DataFrame:
    """One row per point that has a match: key, distance, the order columns, keys, carried
    columns and the nearest place. Ties go by the order columns. Points may occur in
    several rows (one for each layer to be searched).

    Points with the same keys and coordinates are searched once. A first round over cells of
    few segments settles nearly all of them, a second one over cells four times as wide the
    most of the rest; what neither settles goes through the quadtree, with the segments near it."""
    named = list(dict.fromkeys([*keys, *ENDS, *order, *carry]))
    finite = lambda *names: " and ".join(f"abs({n}) < double('Infinity')" for n in names)
    s = segments.select(*named).dropna(subset=[*keys, *ENDS]).filter(finite(*ENDS))
    table = _key_table(s, keys, radius)
    # what the keys tell is not shuffled with every segment but comes from their table
    ranks = [c for c in order if c in keys] if set(order) - set(keys) else []
    ranked, order, carry = order, [c for c in order if c not in ranks], [c for c in carry if c not in keys]
    s = s.join(table, keys).select("kid", "width", *dict.fromkeys([*ENDS, *order, *carry]))
    p = points.select(key, *keys, F.col("x").alias("px"), F.col("y").alias("py")).dropna(subset=[*keys, "px", "py"]).filter(finite("px", "py"))
    p = stored(p.join(table, keys).select(key, "kid", "px", "py"))
    places = stored(p.select("kid", "px", "py").distinct()).join(table.select("kid", "width"), "kid")
    found = stored(_round(places, s, radius, order, carry, False))
    place = ["kid", "px", "py"]
    rest = stored(places.filter(_settled(radius) < radius).join(found, place, "left_anti"))
    if not rest.isEmpty():
        wider = F.when(F.col("width") * 4 < radius, F.col("width") * 4).otherwise(F.lit(_whole(radius)))
        more = stored(_round(rest.withColumn("width", wider), s.withColumn("width", wider), radius, order, carry, rest.count() <= SENT))
        found = found.unionByName(more)
        last = rest.withColumn("width", wider).filter(_settled(radius) < radius).join(more, place, "left_anti")
        last = stored(last.select(*place).withColumn("__place", F.monotonically_increasing_id()))
        if not last.isEmpty():
            whole = F.lit(_whole(radius))
            cells = _nine(last.withColumn("width", whole)).select("kid", "cx", "cy").distinct()
            near = _filed(s.withColumn("width", whole)).join(cells, ["kid", "cx", "cy"], "left_semi").drop("cx", "cy")
            far = _by_tree(last, near, "__place", ["kid"], radius, carry, order, leaf, deepest)
            found = found.unionByName(last.join(far, "__place").select(*place, "best"))
    # the kid tells which keys were searched; the order columns decide between a point's rows
    met = p.join(found, place)
    if ranks:
        rest = [c for c in dict.fromkeys([*carry, "new_x", "new_y"]) if c not in order]
        best = F.struct("best.distance", *[F.col(c if c in ranks else f"best.{c}") for c in ranked], *[f"best.{c}" for c in rest])
        met = met.join(table.select("kid", *ranks), "kid").withColumn("best", best)
    best = met.groupBy(key).agg(F.min(F.struct("best", "kid")).alias("b")).select(key, "b.best.*", "b.kid")
    return best.join(table.select("kid", *[c for c in keys if c not in ranked]), "kid").drop("kid")
